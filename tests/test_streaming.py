"""Every streaming form gives what its batch form gives."""

import pytest
from helpers import keyvals, log_of, safe_add, two_logs
from pyspark.sql import functions as F

from tidelog.operators.log import Log
from tidelog.operators.reducers import Fold, largest, total
from tidelog.operators.stateful import Store
from tidelog.operators.windows import (JoinWindows, SessionWindows, SuppressBufferFull,
                                       TimeWindows)
from tidelog.streaming.drain import BufferGuard, drain, newest, read_stream

RECORDS = [(1 + i * 700, i % 3, (i * 7) % 11) for i in range(60)]


def streamed(spark, log, folder, files=2):
    """The log as a stream of several files, in order, one per micro-batch."""
    n = log.df.agg(F.max("offset")).first()[0] + 1
    for i in range(files):
        part = log.df.where((F.col("offset") >= i * n // files)
                            & (F.col("offset") < (i + 1) * n // files))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/{i}")
    df = (spark.readStream.schema(log.df.schema).option("maxFilesPerTrigger", 1)
          .option("recursiveFileLookup", "true").parquet(str(folder)))
    return Log(df, log.order)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def log(spark):
    return log_of(spark, RECORDS)


def test_stateless(spark, log, tmp_path):
    chain = lambda x: x.filter(lambda k, v: v > 3).flat_map_values(lambda v: [v, v * 2]).df
    assert rows(drain(chain(streamed(spark, log, tmp_path)))) == rows(chain(log))


def test_count_update_mode(spark, log, tmp_path):
    table = streamed(spark, log, tmp_path).group_by_key().count()
    got = newest(drain(table.snapshot(), "update"), ["key"])
    assert rows(got) == rows(log.group_by_key().count().snapshot())


def test_table_snapshot_update_mode(spark, log, tmp_path):
    got = newest(drain(streamed(spark, log, tmp_path).to_table().snapshot(), "update"), ["key"])
    assert rows(got) == rows(log.to_table().snapshot())


def test_changelog(spark, log, tmp_path):
    table = lambda x: x.group_by_key().aggregate(-10, total()).updates().df.select(
        "key", "value", "ts", "offset")
    assert rows(drain(table(streamed(spark, log, tmp_path)))) == rows(table(log))


DELETES = [(1 + i * 700, i % 3, None if i % 5 == 4 else (i * 7) % 11) for i in range(40)]


@pytest.mark.parametrize("name,change", [
    ("filter", lambda t: t.filter(lambda k, v: v > 4)),
    ("regrouped", lambda t: t.group_by(lambda k, v: (v % 2, v)).reduce(total())),
    ("largest", lambda t: t.to_stream().group_by_key().reduce(largest())),
    ("self join", lambda t: t.join(t.map_values(lambda v: v * 10), lambda a, b: a + b))])
def test_table_changelogs(spark, tmp_path, name, change):
    log = log_of(spark, DELETES)
    updates = lambda x: change(x.to_table()).updates().df.select("key", "value", "ts")
    assert rows(drain(updates(streamed(spark, log, tmp_path)))) == rows(updates(log))


def test_session_changelog(spark, tmp_path):
    log = log_of(spark, [(100, 1, 4), (1000, 1, 3), (1200, 1, 3), (5000, 1, 2), (5100, 2, 1)])
    sessions = lambda x: x.group_by_key().window_by_session(SessionWindows(1000, 0))
    updates = lambda x: sessions(x).reduce(total()).updates().df
    assert rows(drain(updates(streamed(spark, log, tmp_path)))) == rows(updates(log))


def arriving(spark, records, folder):
    """A stream with one record in each micro-batch, in the order given."""
    return streamed(spark, log_of(spark, records), folder, files=len(records))


def spans(df):
    """(start, end, value) in milliseconds, as the records arrived."""
    ms = lambda c: F.unix_millis(f"window.{c}")
    out = df.select(ms("start"), ms("end"), "value", "offset", "pos2").collect()
    return [tuple(r)[:3] for r in sorted(out, key=lambda r: (r["offset"], r["pos2"]))]


def test_session_changelog_out_of_order(spark, tmp_path):
    """A late record grows the session it belongs to; one between two sessions makes them one."""
    log = arriving(spark, [(1000, 1, 1), (9000, 1, 2), (1500, 1, 4), (3000, 1, 8), (2200, 1, 16)], tmp_path)
    table = log.group_by_key().window_by_session(SessionWindows(1000, 0)).reduce(total())
    assert spans(drain(table.updates().df)) == [
        (1000, 1000, 1), (9000, 9000, 2), (1000, 1000, None), (1000, 1500, 5), (3000, 3000, 8),
        (1000, 1500, None), (3000, 3000, None), (1000, 3000, 29)]


def test_suppressed_count(spark, tmp_path):
    log = log_of(spark, [(1, 1, 3), (2, 1, 4), (12, 1, 4), (201, 1, 1), (202, 1, 2), (222, 1, 3)])
    stream = streamed(spark, log, tmp_path, files=6).with_watermark(0)
    held = stream.group_by_key().count().suppress(until_time_limit_ms=10)
    assert keyvals(Log(drain(held.df), held.order)) == [(1, 3), (1, 6)]


def test_suppress_until_windows_close(spark, log, tmp_path):
    windows = TimeWindows(5000, grace_ms=1000)
    final = lambda x: x.group_by_key().window_by_time(windows).reduce(total()).suppress().df
    stream = streamed(spark, log, tmp_path).with_watermark(1000)
    assert rows(drain(final(stream))) == rows(final(log))


def test_sessions(spark, tmp_path):
    log = log_of(spark, [(1, 1, 1), (500, 1, 2), (5000, 1, 3), (5900, 2, 4), (60000, 3, 1)])
    windows = SessionWindows(1000, 0)
    stream = streamed(spark, log, tmp_path).with_watermark(0)
    got = drain(stream.group_by_key().window_by_session(windows).reduce(total()).snapshot())
    want = log.group_by_key().window_by_session(windows).reduce(total()).snapshot()
    assert rows(got) == rows(want.where("key < 3"))


def test_windowed_join(spark, log, tmp_path):
    near = JoinWindows(1500, 2500)
    pair = lambda x, y: x.join_windowed(y, lambda a, b: a * 100 + b, near).df
    other = log.filter(lambda k, v: v % 2 == 0)
    s = [streamed(spark, x, tmp_path / n).with_watermark(0)
         for n, x in (("a", log), ("b", other))]
    assert rows(drain(pair(*s))) == rows(pair(log, other))


@pytest.mark.parametrize("how", ["left", "outer"])
def test_windowed_outer_joins(spark, tmp_path, how):
    """Rows whose window the watermark has passed; the batch form also gives the open ones."""
    left, right = two_logs(spark, [("L", 1000, 1, 1), ("R", 1100, 1, 2), ("L", 4000, 1, 3),
                                   ("R", 9000, 2, 5), ("L", 30000, 3, 0), ("R", 30000, 3, 0)])
    near = JoinWindows.of(1000)

    def pair(x, y):
        joined = x.left_join_windowed if how == "left" else x.outer_join_windowed
        return joined(y, safe_add, near).df

    s = [streamed(spark, x, tmp_path / n, files=2).with_watermark(0)
         for n, x in (("l", left), ("r", right))]
    assert rows(drain(pair(*s))) == rows(pair(left, right))


def test_buffer_guard_stops_the_query(spark, log, tmp_path):
    windows = TimeWindows(1000, grace_ms=60_000)
    stream = streamed(spark, log, tmp_path / "in").with_watermark(60_000)
    out = stream.group_by_key().window_by_time(windows).count().snapshot()
    query = (out.writeStream.format("noop").outputMode("append")
             .option("checkpointLocation", str(tmp_path / "c"))
             .trigger(processingTime="100 milliseconds").start())
    guard = BufferGuard(spark, query, max_records=5)
    spark.streams.addListener(guard)
    try:
        query.awaitTermination(60)
    finally:
        spark.streams.removeListener(guard)
        query.stop()
    assert isinstance(guard.failed, SuppressBufferFull)


def test_stream_table_join(spark, tmp_path):
    left, right = two_logs(spark, [("L", 1, 2), ("R", 1, 1), ("L", 1, 2), ("R", 1, None),
                                   ("L", 1, 7)])
    joined = lambda l, r: l.left_join(r.to_table(), safe_add).df
    s = [streamed(spark, x, tmp_path / n, files=1) for n, x in (("l", left), ("r", right))]
    assert rows(drain(joined(*s))) == rows(joined(left, right))


def test_state_store(spark, log, tmp_path):
    def step(ctx, key, value):
        store = ctx.store("sums")
        now = (store.get() or {"value": 0})["value"] + value
        store.put({"value": now})
        return key, {"value": now, "topic": ctx.topic}

    run = lambda x: x.transform(step, "long", "struct<value:long,topic:string>",
                                [Store("sums", "struct<value:long>")]).df
    assert rows(drain(run(streamed(spark, log, tmp_path)))) == rows(run(log))


FLOORED = Fold({"v": 0}, lambda acc, key, value: {"v": max(acc["v"] + value - 5, 0)}, "struct<v:long>")


def test_fold(spark, log, tmp_path):
    folded = lambda x: x.group_by_key().fold(FLOORED).updates().df
    assert rows(drain(folded(streamed(spark, log, tmp_path, files=4)))) == rows(folded(log))


def test_fold_update_mode(spark, log, tmp_path):
    table = streamed(spark, log, tmp_path, files=4).group_by_key().fold(FLOORED)
    got = newest(drain(table.snapshot(), "update"), ["key"])
    assert rows(got) == rows(log.group_by_key().fold(FLOORED).snapshot())


def test_foreign_key_join(spark, tmp_path):
    """Rows move between foreign keys, are deleted and come back; right rows come and go."""
    moves = [("LRL"[i % 3], i % 4 if i % 3 != 1 else i % 5,
              None if i % 7 == 6 else (i * 5) % 9) for i in range(90)]
    left, right = two_logs(spark, moves)

    def joined(l, r):
        return l.to_table().join(r.to_table(), lambda v: v % 5, lambda a, b: a * 100 + b).updates()

    want = joined(left, right)
    assert rows(want.df)
    # in step: a micro-batch holds the same stretch of time of both logs
    both = streamed(spark, left.map_values(lambda v: F.struct(v.alias("v"), F.lit(0).alias("s"))).merge(
        right.map_values(lambda v: F.struct(v.alias("v"), F.lit(1).alias("s")))), tmp_path, files=5)
    side = lambda n: Log(both.df.where(F.col("value.s") == n).withColumn(
        "value", F.col("value.v")), left.order)
    got = joined(side(0), side(1))
    assert rows(drain(got.df.select(want.df.columns))) == rows(want.df)


def test_rate_limit(spark, tmp_path):
    log = log_of(spark, [(1, 1, 3), (2, 1, 4), (12, 1, 4), (201, 1, 1), (202, 1, 2), (222, 1, 3)])
    stream = streamed(spark, log, tmp_path, files=6).with_watermark(0)
    held = stream.to_table().suppress(until_time_limit_ms=10)
    out = drain(held.df)
    assert keyvals(Log(out, held.order)) == [(1, 4), (1, 3)]


def test_read_stream_of_a_table(spark):
    folder = "/root/testdata/sf0.001"
    got = drain(read_stream(spark, folder, "events").select("event_id"))
    assert got.count() == spark.read.parquet(f"{folder}/events.parquet").count()
