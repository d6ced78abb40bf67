"""State that waits for the watermark, and extremes of groups whose rows leave."""

import random
from decimal import Decimal

import numpy as np
import pytest
from helpers import keyvals, log_of
from pyspark.sql import functions as F
from test_streaming import rows, streamed

from tidelog.operators import extremes
from tidelog.operators.extremes import Multiset
from tidelog.operators.log import Log
from tidelog.operators.reducers import Fold, largest, smallest, total
from tidelog.operators.windows import SuppressBufferFull, TimeWindows
from tidelog.streaming.drain import drain
from tidelog.streaming.held import delay_of

LAST = Fold(0, lambda acc, key, value: acc * 3 % 101 + value, "long")
MINUTE = TimeWindows(60_000, grace_ms=30_000)
HOUR = 3_600_000  # a stream's watermark begins at nought, and takes nothing of that time
# records far behind the others move the time of every partition on
RECORDS = [(HOUR + i * 2_000, i % 3, (i * 7) % 11) for i in range(120)] + [(9 * HOUR, k, 1) for k in range(3)]


def test_multiset_against_a_list():
    rng, held, plain = random.Random(4), Multiset(), []
    for _ in range(2000):
        if plain and rng.random() < 0.5:
            x = plain.pop(rng.randrange(len(plain)))
            held.add(x, -1)
        else:
            x = rng.choice([None, *range(30)])
            plain += [] if x is None else [x]
            held.add(x)
        assert (held.least, held.most) == ((min(plain), max(plain)) if plain else (None, None))


# -- regrouped tables ------------------------------------------------------------------


def upserts(n, seed, keys=6):
    """(time, key, value or None) with many moves, ties and deletes."""
    rng = random.Random(seed)
    return [(i // 2, rng.randrange(keys), None if rng.random() < 0.2 else rng.randrange(40)) for i in range(n)]


def brute(records, pick):
    """(group, extreme) after each change: a row leaves its old group before it enters the new one."""
    now, out = {}, []
    for _, key, value in records:
        old = now.pop(key, None)
        group = lambda g: [v for v in now.values() if v // 10 == g]
        if old is not None:
            out.append((old // 10, pick(group(old // 10), default=None)))
        if value is not None:
            now[key] = value
            out.append((value // 10, pick(group(value // 10))))
    return out


def banded(log, reducer):
    return log.to_table().group_by(lambda k, v: (F.floor(v / 10).cast("long"), v)).reduce(reducer)


@pytest.mark.parametrize("slice_events", [2, 7, 65_536])
def test_extremes_of_groups(spark, monkeypatch, slice_events):
    monkeypatch.setattr(extremes, "SLICE_EVENTS", slice_events)
    records = upserts(150, slice_events)
    log = log_of(spark, records)
    for reducer, pick in ((largest(), max), (smallest(), min)):
        changes = banded(log, reducer).updates()
        assert keyvals(changes) == brute(records, pick)
        last = {k: v for k, v in keyvals(changes) if v is not None}
        alive = {k for k, v in dict(keyvals(changes)).items() if v is not None}
        state = {r["key"]: r["value"] for r in banded(log, reducer).snapshot().collect()}
        assert {k: last[k] for k in alive} == state


def test_tree_nodes_cover_each_slice_once(spark):
    spans = [(a, b) for a in range(12) for b in range(a, 13)]
    df = spark.createDataFrame(spans, "a long, b long").select("a", "b", extremes._nodes(F.col("a"), F.col("b")).alias("n"))
    for a, b, nodes in df.collect():
        met = [s for level, node in nodes for s in range(node << level, (node + 1) << level)]
        assert sorted(met) == list(range(a, b)) and len(nodes) <= 8


def test_extremes_on_a_stream(spark, tmp_path):
    log = log_of(spark, upserts(90, 5))
    for i, reducer in enumerate((largest(), smallest())):
        got = banded(streamed(spark, log, tmp_path / str(i), 3), reducer).updates()
        want = banded(log, reducer).updates()
        assert rows(drain(got.df.select("key", "value", "offset"))) == rows(want.df.select("key", "value", "offset"))


def test_extremes_of_decimals_and_nulls(spark):
    log = log_of(spark, [(0, 1, 5), (1, 2, None), (2, 1, 7), (3, 1, None)])
    table = log.map_values(lambda v: F.when(v.isNotNull(), F.struct(F.when(v > 5, v.cast("decimal(5,1)")).alias("d"))))
    grouped = table.to_table().group_by(lambda k, v: (k, v["d"])).reduce(largest())
    assert keyvals(grouped.updates()) == [(1, None), (1, None), (1, Decimal("7.0")), (1, None)]


def states(df):
    """The stateful steps of a stream, last first: how they take records, and the columns they take."""
    node, out = df._jdf.queryExecution().analyzed(), []
    while node.children().nonEmpty():
        if node.nodeName().startswith("TransformWithState"):
            taken = [part.rsplit("#", 1)[0] for part in node.child().output().mkString(";").split(";")]
            out.append((", pandas," in node.toString().split("\n")[0], taken))
        node = node.children().head()
    return out


def test_a_group_on_a_stream_is_taken_in_frames(spark, tmp_path):
    log = streamed(spark, log_of(spark, upserts(20, 3)), tmp_path)
    (frames, _), (_, moved) = states(banded(log, largest()).updates().df)
    # record by record, one group of some million changes takes minutes of one task
    assert frames
    # what the grouping does not need stays outside of state, what it needs goes there once
    assert not {"topic", "partition", "value", "__x0"} & set(moved)


TYPED = {"long": lambda v: F.lit(1 << 60) + v, "double": lambda v: v / 8, "string": lambda v: (v + 10).cast("string"),
         "decimal(20,3)": lambda v: v / 8, "timestamp": lambda v: F.timestamp_micros(v + 1_700_000_000_123_456)}


def test_extremes_on_a_stream_keep_types_and_nulls(spark, tmp_path):
    log = log_of(spark, [(HOUR + ms, key, value) for ms, key, value in upserts(60, 9)])
    for i, (kind, make) in enumerate(TYPED.items()):
        value = lambda v: F.when(v % 5 != 0, make(v).cast(kind))  # noqa: E731,B023
        group = lambda k, v: (F.concat(F.lit('"\u00e9'), F.floor(v / 10).cast("string")), value(v))  # noqa: E731,B023
        got, want = (it.to_table().group_by(group).reduce(largest()).updates().df.select("key", "value", "ts", "offset")
                     for it in (streamed(spark, log, tmp_path / str(i)).with_watermark(1_000), log))
        assert delay_of(got) == 1_000 and got.dtypes == want.dtypes
        assert rows(drain(got)) == rows(want)


# -- folds over windows on streams ----------------------------------------------------------


def folded(log):
    return log.group_by_key().window_by_time(MINUTE).fold(LAST)


def test_window_fold_closes_like_batch(spark, tmp_path):
    log = log_of(spark, RECORDS)
    got = drain(folded(streamed(spark, log, tmp_path, 4).with_watermark(30_000)).suppress().df)
    want = folded(log).suppress().df
    assert rows(got.select("key", "window", "value")) == rows(want.select("key", "window", "value"))
    assert got.count() > 10


def test_window_fold_changelog(spark, tmp_path):
    log = log_of(spark, RECORDS)
    stream = streamed(spark, log, tmp_path, 4)
    for i, one in enumerate((stream, stream.with_watermark(30_000))):
        got = drain(folded(one).updates().df.select("key", "window", "value", "offset"))
        assert rows(got) == rows(folded(log).updates().df.select("key", "window", "value", "offset")), i


def test_late_records_leave_closed_windows(spark, tmp_path):
    records = [(HOUR + ms, k, v) for ms, k, v in (
        (0, 1, 1), (59_000, 1, 2), (1_000_000, 2, 1), (30_000, 1, 50), (2_000_000, 2, 1), (3_000_000, 2, 1))]
    log = streamed(spark, log_of(spark, records), tmp_path, 6).with_watermark(30_000)
    got = {(r.key, r.value) for r in drain(folded(log).suppress().df.select("key", "value")).collect()}
    assert (1, 5) in got and not any(k == 1 and v > 5 for k, v in got)


def test_final_rows_need_a_watermark(spark, tmp_path):
    with pytest.raises(ValueError, match="watermark"):
        folded(streamed(spark, log_of(spark, RECORDS), tmp_path)).suppress()


# -- a record meets the table of its own time -------------------------------------------------


def shuffled(spark, log, folder, seed):
    """Like ``streamed``, with files in another order than their records' times; only the last stays last."""
    order, n = list(range(6)), 200
    random.Random(seed).shuffle(order)
    for place, i in enumerate([*order, 6]):
        part = log.df.where((F.col("offset") >= i * n // 6) & (F.col("offset") < (i + 1) * n // 6))
        part.coalesce(1).write.parquet(f"{folder}/{place}")
    df = (spark.readStream.schema(log.df.schema).option("maxFilesPerTrigger", 1)
          .option("recursiveFileLookup", "true").parquet(str(folder)))
    return Log(df, log.order)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_late_records_meet_their_own_time(spark, tmp_path, how):
    rng = random.Random(8)
    records = [(HOUR + i * 100, rng.randrange(4), None if rng.random() < 0.1 else i) for i in range(200)]
    log = log_of(spark, records + [(9 * HOUR, 0, 7), (9 * HOUR, 1, 8)])

    def joined(one):
        table = Log(one.df.where("offset % 2 = 0"), one.order).to_table()
        clicks = Log(one.df.where("offset % 2 = 1"), one.order)
        add = lambda a, b: a * 1000 + F.coalesce(b, F.lit(0))
        return clicks.join(table, add) if how == "inner" else clicks.left_join(table, add)

    stream = shuffled(spark, log, tmp_path, 3).with_watermark(60_000)
    got = drain(joined(stream).df.select("key", "value", "offset"))
    want = joined(log).df.where("offset < 200").select("key", "value", "offset")
    assert rows(got.where("offset < 200")) == rows(want)
    assert got.count() > 50


def test_records_of_one_position_all_meet_the_table(spark, tmp_path):
    log = log_of(spark, [(HOUR, 0, 5), (HOUR + 1, 0, 7), (9 * HOUR, 0, 1), (9 * HOUR, 0, 1)])
    twice = log._with(log.df.unionByName(log.df.where("offset = 1")))

    def joined(one):
        table = Log(one.df.where("offset % 2 = 0"), one.order).to_table()
        return Log(one.df.where("offset % 2 = 1"), one.order).join(table, lambda a, b: a * 10 + b)

    got = drain(joined(streamed(spark, twice, tmp_path).with_watermark(60_000)).df.select("key", "value"))
    assert rows(got.where("value = 75")) == rows(joined(twice).df.select("key", "value").where("value = 75"))
    assert got.where("value = 75").count() == 2


def test_pieces_hold_every_event_once_and_are_late_by_ten_days_at_most(spark, tmp_path, monkeypatch):
    from tidelog.plans import streams
    monkeypatch.setattr(streams, "ROWS_AT_ONCE", 20)
    days = [i * 37 % 90 for i in range(150)]
    (spark.createDataFrame([(i, i % 7, "view", 1.0, "{}", d) for i, d in enumerate(days)],
                           "event_id long, user_id long, event_type string, value double, props string, d int")
     .selectExpr("*", "timestamp'2024-01-01' + make_dt_interval(d) AS ts").write.parquet(f"{tmp_path}/events.parquet"))
    for mixed in (False, True):
        taken = []
        query = (streams.arriving(spark, str(tmp_path), mixed).df.select("ts", "offset").writeStream.foreachBatch(
            lambda df, n: taken.append([(r.ts, r.offset) for r in df.collect()]))
            .trigger(availableNow=True).start())
        query.awaitTermination()
        taken = [b for b in taken if b]
        assert sorted(o for b in taken for _, o in b) == list(range(150)) and max(map(len, taken)) <= 30
        seen, late = None, 0
        for batch in taken:
            if seen is not None:
                late = max(late, (seen - min(batch)[0]).total_seconds())
            seen = max(batch)[0] if seen is None else max(seen, max(batch)[0])
        assert 0 < late <= 10 * 86_400 if mixed else late <= 0


def test_a_buffer_reads_only_what_closes(spark, tmp_path, monkeypatch):
    # each window is held under the time it closes, so a timer never walks the other ones
    from tidelog.streaming import held
    monkeypatch.setattr(held, "PARTS", 2)
    log = log_of(spark, [(HOUR + i * 7_000, i % 40, i % 11) for i in range(400)] + [(9 * HOUR, k, 1) for k in range(40)])
    stream = streamed(spark, log, tmp_path, 2).with_watermark(30_000)
    got = drain(sums(stream).suppress(max_records=10_000).df)
    assert rows(got.select("key", "window", "value")) == rows(sums(log).suppress().df.select("key", "window", "value"))


# -- bounded buffers --------------------------------------------------------------------------


def sums(log):
    return log.group_by_key().window_by_time(MINUTE).reduce(total())


def test_buffer_within_its_limits(spark, tmp_path):
    log = log_of(spark, RECORDS)
    stream = streamed(spark, log, tmp_path, 4).with_watermark(30_000)
    got = drain(sums(stream).suppress(max_records=50, max_bytes=100_000).df)
    assert rows(got.select("key", "window", "value")) == rows(sums(log).suppress().df.select("key", "window", "value"))


@pytest.mark.parametrize("limits", [{"max_records": 2}, {"max_bytes": 100}])
def test_buffer_beyond_its_limits_fails_the_query(spark, tmp_path, limits):
    stream = streamed(spark, log_of(spark, RECORDS), tmp_path, 4).with_watermark(30_000)
    with pytest.raises(Exception, match=SuppressBufferFull.__name__):
        drain(sums(stream).suppress(**limits).df)


def test_buffers_are_kept_per_log_partition(spark, tmp_path):
    log = log_of(spark, RECORDS)
    log = log._with(log.df.withColumn("partition", (F.col("key") % 3).cast("int")))
    stream = streamed(spark, log, tmp_path, 4).with_watermark(30_000)
    # four windows of one key are open at once at most, of all keys more
    got = drain(sums(stream).suppress(max_records=4).df)
    assert rows(got.select("key", "window", "value")) == rows(sums(log).suppress().df.select("key", "window", "value"))


def test_bounded_buffer_needs_partition_and_watermark(spark, tmp_path):
    log = streamed(spark, log_of(spark, RECORDS), tmp_path)
    with pytest.raises(ValueError, match="watermark"):
        sums(log).suppress(max_records=5)
    with pytest.raises(ValueError, match="partition"):
        sums(log._with(log.df.drop("partition")).with_watermark(0)).suppress(max_records=5)


def test_a_bounded_buffer_takes_packs_and_its_windows_frames(spark, tmp_path):
    stream = streamed(spark, log_of(spark, RECORDS), tmp_path).with_watermark(30_000)
    (_, taken), (frames, _) = states(sums(stream).suppress(max_records=50).df)
    # a partition is one task, so its updates may not come one by one
    assert "pack" in taken and "value" not in taken
    assert frames


def test_closed_windows_leave_the_running_state(spark, tmp_path, monkeypatch):
    from tidelog.streaming import processors
    monkeypatch.setattr(processors, "FRAMES", 2, raising=False)
    log = log_of(spark, [(HOUR + i * 60_000, 1, 1) for i in range(200)])
    stream, place = streamed(spark, log, tmp_path / "in", 10).with_watermark(0), f"{tmp_path}/checkpoint"
    df = sums(stream).updates().df.select("key", "window", "value")
    (df.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", place)
     .trigger(availableNow=True).start().awaitTermination())
    state = spark.read.format("statestore").option("operatorId", 0).option("stateVarName", "bundle").load(place)
    held = b"".join(bytes(r.held) for r in state.select("value.held").collect())
    # the names of windows; a micro-batch opens twenty
    assert 0 < held.count(b'"key"') <= 80
    assert spark.read.parquet(f"{tmp_path}/out").count() == 200


def test_a_buffer_keeps_values_of_any_type(spark, tmp_path):
    log = log_of(spark, [(HOUR + i * 2_000, i % 3, (i * 7) % 11) for i in range(60)] + [(9 * HOUR, k, 1) for k in range(3)])
    made = lambda v: F.struct(
        F.when(v > 20, v.cast("decimal(20,3)")).alias("d"), F.array(v, F.lit(None)).alias("l"),
        F.create_map(F.lit("\u00e9"), v / 8).alias("m"), F.timestamp_micros(v + 1_700_000_000_123_456).alias("t"))
    held = lambda one, **limits: sums(one).map_values(made).suppress(**limits).df.select(
        "key", "window", F.to_json("value").alias("value"))
    got = drain(held(streamed(spark, log, tmp_path, 3).with_watermark(30_000), max_records=100))
    assert rows(got) == rows(held(log)) and got.count() > 5


def test_a_buffer_fails_at_the_first_update_beyond_a_limit():
    from tidelog.streaming.held import BufferProcessor
    check = lambda new, more, **limits: BufferProcessor((), (), {"records": None, "bytes": None, **limits}).check(
        {"records": 1, "bytes": 10}, np.array(new), np.array(more))
    check([True, False], [5, -5], records=2, bytes=15)
    # what an update adds counts even where a later one takes it back
    with pytest.raises(SuppressBufferFull, match="15 bytes, limit is 14"):
        check([True, False], [5, -5], records=2, bytes=14)
    with pytest.raises(SuppressBufferFull, match="3 records, limit is 2"):
        check([True, True, False], [1, 1, 9], records=2, bytes=14)
