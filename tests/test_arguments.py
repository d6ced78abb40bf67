"""Arguments either take effect or are refused."""

import pytest
from helpers import keyvals, log_of
from pyspark.sql import functions as F

from tidelog.functions import json_schema
from tidelog.operators.log import Log
from tidelog.operators.reducers import Fold, total
from tidelog.operators.windows import TimeWindows


def stream_of(spark, tmp_path):
    place = str(tmp_path / "events")
    log = log_of(spark, [(1, 1), (1, 6)])
    df = log.df.withColumn("ts", F.timestamp_seconds(F.lit(1)))
    df.write.parquet(place)
    return Log(spark.readStream.schema(df.schema).parquet(place), log.order)


def test_a_fold_starts_with_init(spark):
    log = log_of(spark, [(1, 3), (1, 4), (2, 5)])
    fold = Fold(0, lambda acc, key, value: acc + value, "long")
    table = log.group_by_key().aggregate(-10, fold)
    assert sorted((r["key"], r["value"]) for r in table.snapshot().collect()) == [(1, -3), (2, -5)]
    with pytest.raises(ValueError):
        log.group_by_key().aggregate(-10, Fold(0, fold.step, "long", merge=lambda key, a, b: a + b))


def test_limits_on_streams_need_a_watermark(spark, tmp_path):
    log = stream_of(spark, tmp_path)
    table = log.group_by_key().window_by_time(TimeWindows(60_000)).reduce(total())
    for limits in ({"max_records": 1}, {"max_bytes": 1}):
        with pytest.raises(ValueError):
            table.suppress(**limits)


def test_for_each_finds_a_checkpoint(spark, tmp_path):
    query = stream_of(spark, tmp_path).for_each(lambda row: None)
    query.awaitTermination()
    assert query.exception() is None


def test_unknown_schema_keywords_are_refused():
    for keyword in ("enum", "pattern", "maximum", "maxLength"):
        with pytest.raises(ValueError, match=keyword):
            json_schema.errors(F.lit("{}"), {"type": "object", "properties": {"a": {keyword: 1}}})


def test_windowed_folds_need_batch_input(spark, tmp_path):
    fold = Fold(0, lambda acc, key, value: acc + value, "long")
    windowed = stream_of(spark, tmp_path).group_by_key().window_by_time(TimeWindows(60_000))
    with pytest.raises(ValueError):
        windowed.fold(fold)
