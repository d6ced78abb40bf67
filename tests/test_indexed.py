"""Topics with a manifest of offsets and times."""

import os
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

import pytest
from helpers import at, keyvals, log_of

from tidelog.sources import indexed
from tidelog.sources.sinks import ReadOnlyTopic
from tidelog.sources.topics import Topic


def topic(path, **kwargs):
    return Topic("t", "bigint", "bigint", path=str(path), **{
        "partitions": 2, "partition_fn": lambda k, v, n: k % n, **kwargs})


def held(log):
    return {(r["partition"], r["offset"]): r["value"] for r in log.df.collect()}


def test_appends_go_on_where_the_last_ended(spark, tmp_path, layout):
    t = topic(tmp_path / "t")
    one = indexed.append_indexed(log_of(spark, [(0, 1), (1, 2), (0, 3)]), t)
    assert sorted((r["partition"], r["offset"]) for r in one.collect()) == [(0, 0), (0, 1), (1, 0)]
    indexed.append_indexed(log_of(spark, [(1, 4)]), t)
    two = indexed.append_indexed(log_of(spark, [(0, 5), (1, 6)]), t)
    assert sorted((r["partition"], r["offset"]) for r in two.collect()) == [(0, 2), (1, 2)]
    assert held(indexed.read_indexed(spark, t)) == {
        (0, 0): 1, (0, 1): 3, (1, 0): 2, (1, 1): 4, (0, 2): 5, (1, 2): 6}
    assert {tuple(r) for r in indexed.indexed_offsets(spark, t).collect()} == {("t", 0, 0, 3), ("t", 1, 0, 3)}


def test_reads_open_only_what_they_need(spark, tmp_path):
    t = topic(tmp_path / "t", partitions=1, partition_fn=None)
    for lot in range(4):
        indexed.append_indexed(log_of(spark, [(lot * 100 + i, 1, lot * 10 + i) for i in range(5)]), t)
    everything = indexed.read_indexed(spark, t)
    assert sorted(held(everything).values()) == [lot * 10 + i for lot in range(4) for i in range(5)]
    files = len(everything.df.inputFiles())
    late = indexed.read_indexed(spark, t, since=at(203))
    assert keyvals(late) == [(1, 23), (1, 24), *[(1, 30 + i) for i in range(5)]]
    assert len(late.df.inputFiles()) == files // 2
    tail = indexed.read_indexed(spark, t, starts={0: 17})
    assert keyvals(tail) == [(1, 32), (1, 33), (1, 34)] and len(tail.df.inputFiles()) == files // 4
    assert held(indexed.read_indexed(spark, t, since=datetime(2040, 1, 1, tzinfo=timezone.utc))) == {}
    assert held(indexed.read_indexed(spark, t, starts={9: 0})) == {}


def test_a_seek_takes_earlier_times_behind_its_start(spark, tmp_path):
    t = topic(tmp_path / "t", partitions=1, partition_fn=None)
    for records in ([(5, 1, 0), (50, 1, 1)], [(10, 1, 2)], [(60, 1, 3)]):
        indexed.append_indexed(log_of(spark, records), t)
    assert sorted(held(indexed.read_indexed(spark, t, since=at(20))).values()) == [1, 2, 3]
    assert sorted(held(indexed.read_indexed(spark, t, since=at(55))).values()) == [3]


def test_writers_at_once(spark, tmp_path):
    t = topic(tmp_path / "t")
    logs = [log_of(spark, [(i % 2, w * 10 + i) for i in range(6)]) for w in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda log: indexed.append_indexed(log, t), logs))
    rows = indexed.read_indexed(spark, t).df.collect()
    assert sorted(r["value"] for r in rows) == sorted(w * 10 + i for w in range(4) for i in range(6))
    assert sorted((r["partition"], r["offset"]) for r in rows) == [(p, n) for p in (0, 1) for n in range(12)]


def test_a_commit_is_taken_once(spark, tmp_path, monkeypatch):
    """A writer that finds its commit taken goes on behind it, with the data it has written."""
    t = topic(tmp_path / "t")
    latest, calls = indexed._latest, []

    def late(spark, topic):
        found = latest(spark, topic)
        calls.append(found[0])
        if len(calls) == 1:
            indexed.append_indexed(log_of(spark, [(0, 7)]), topic)
        return found

    monkeypatch.setattr(indexed, "_latest", late)
    indexed.append_indexed(log_of(spark, [(0, 8)]), t)
    monkeypatch.undo()
    assert held(indexed.read_indexed(spark, t)) == {(0, 0): 7, (0, 1): 8}
    assert len(os.listdir(tmp_path / "t" / "data")) == 2


def test_uncommitted_data_is_invisible(spark, tmp_path, monkeypatch):
    t = topic(tmp_path / "t")
    assert held(indexed.read_indexed(spark, t)) == {} and indexed.manifest(spark, t).count() == 0
    indexed.append_indexed(log_of(spark, [(0, 1)]), t)

    def fails(self, name, text):
        raise OSError("gone")

    monkeypatch.setattr(indexed.Files, "create", fails)
    with pytest.raises(OSError):
        indexed.append_indexed(log_of(spark, [(0, 2)]), t)
    monkeypatch.undo()
    indexed.append_indexed(log_of(spark, [(0, 3)]), t)
    indexed.append_indexed(log_of(spark, []), t)
    assert held(indexed.read_indexed(spark, t)) == {(0, 0): 1, (0, 1): 3}
    with pytest.raises(ReadOnlyTopic):
        indexed.append_indexed(log_of(spark, [(0, 1)]), topic(tmp_path / "t", read_only=True))
    with pytest.raises(ValueError):
        indexed.read_indexed(spark, t, {0: 0}, at(0))
