"""Keys of a stream that share groups of the engine."""

from helpers import log_of, safe_add, two_logs
from pyspark.sql import functions as F
from test_streaming import streamed

from tidelog.streaming.processors import BUNDLE, BUNDLES, ID, bundled


def test_a_table_join_keeps_one_state(spark, tmp_path):
    left, right = two_logs(spark, [("L", 1, 5), ("R", 1, 7), ("L", 2, 1)])
    sides = [streamed(spark, log, tmp_path / name).to_table() for log, name in ((left, "l"), (right, "r"))]
    plan = sides[0].outer_join(sides[1], safe_add).updates().df._jdf.queryExecution().analyzed().toString()
    assert plan.count("TransformWithState") == 1


def test_groups_do_not_grow_with_the_keys(spark, tmp_path):
    log = log_of(spark, [(1, 1)])
    plan = streamed(spark, log, tmp_path).group_by_key().count().updates().df._jdf.queryExecution().analyzed().toString()
    assert BUNDLE in plan
    many = bundled(spark.range(20_000).withColumn("key", F.col("id")), ("key",))
    assert many.select(BUNDLE).distinct().count() <= BUNDLES
    assert many.select(ID).distinct().count() == 20_000


def test_names_of_keys_tell_equal_keys_only(spark):
    rows = spark.sql("SELECT * FROM VALUES (0.0D, timestamp'2024-01-01 00:00:00.000001'), "
                     "(-0.0D, timestamp'2024-01-01 00:00:00.000001'), (0.0D, timestamp'2024-01-01 00:00:00.000002'), "
                     "(null, null), (null, null), (double('NaN'), null) AS t(a, b)")
    assert bundled(rows, ("a", "b")).select(ID).distinct().count() == 4
