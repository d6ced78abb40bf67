"""Tables kept on storage by key."""

import pytest
from helpers import log_of

from tidelog.sources import sinks
from tidelog.sources.named import NamedTable, TableChanged
from tidelog.sources.topics import Topic, read_log


def held(df):
    return {r["key"]: r["value"] for r in df.collect()}


def test_upserts_deletes_and_compaction(spark, tmp_path):
    t = NamedTable(str(tmp_path / "t"), "bigint", "bigint", buckets=4)
    assert held(t.snapshot(spark)) == {} and held(t.lookup(spark, [1])) == {}
    t.upsert(log_of(spark, [(1, 1), (1, 2), (2, 5), (3, 7), (None, 9)]))
    t.upsert(log_of(spark, [(2, None), (4, 8)]))
    t.upsert(log_of(spark, [(3, 1)]))  # earlier in time than before, but taken in later
    want = {1: 2, 3: 1, 4: 8}
    for _ in range(2):
        assert held(t.snapshot(spark)) == want
        assert held(t.lookup(spark, [1, 2, 9])) == {1: 2} and held(t.lookup(spark, [])) == {}
        t.compact(spark)
    t.upsert(log_of(spark, [(2, 6), (1, None)]))
    assert held(t.snapshot(spark)) == {2: 6, 3: 1, 4: 8}


def test_a_lookup_reads_its_bucket(spark, tmp_path):
    t = NamedTable(str(tmp_path / "t"), "bigint", "bigint", buckets=8)
    t.upsert(log_of(spark, [(k, k) for k in range(200)]))
    t.compact(spark)
    found = t.lookup(spark, [17])
    assert held(found) == {17: 17}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "(bucket" in plan
    scan = found._jdf.queryExecution().optimizedPlan().collectLeaves().size()
    assert scan == 1


def test_a_batch_counts_once_and_a_step_is_taken_once(spark, tmp_path, monkeypatch):
    t = NamedTable(str(tmp_path / "t"), "bigint", "bigint", buckets=2)
    assert t.upsert(log_of(spark, [(1, 1)]), batch=0) and t.upsert(log_of(spark, [(1, 2)]), batch=1)
    assert not t.upsert(log_of(spark, [(1, 1)]), batch=0)
    assert held(t.snapshot(spark)) == {1: 2}
    old = t._state(spark)
    t.upsert(log_of(spark, [(2, 2)]))
    monkeypatch.setattr(NamedTable, "_state", lambda self, spark: old)
    with pytest.raises(TableChanged):
        t.upsert(log_of(spark, [(1, 9)]))
    monkeypatch.undo()
    assert held(t.snapshot(spark)) == {1: 2, 2: 2}


def test_a_stream_is_taken_in(spark, tmp_path):
    topic = Topic("s", "bigint", "bigint", path=str(tmp_path / "s"))
    t = NamedTable(str(tmp_path / "t"), "bigint", "bigint", buckets=2)
    for lot in range(3):
        sinks.write_log(log_of(spark, [(lot, lot), (9, lot)], first_offset=lot * 10), topic)
    stream = read_log(spark, topic, streaming=True, maxFilesPerTrigger="1")
    t.keep_up(stream, str(tmp_path / "c"), compact_after=1).awaitTermination()
    assert held(t.snapshot(spark)).keys() == {0, 1, 2, 9}
    before = t._state(spark)
    t.keep_up(read_log(spark, topic, streaming=True), str(tmp_path / "c")).awaitTermination()
    assert t._state(spark) == before
