"""Topics on storage, addressing, lookups, validation, whole applications."""

import os

import pytest
from helpers import at, keyvals, log_of
from oracle import compare
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidelog import session
from tidelog.operators import lookup
from tidelog.operators.log import Log
from tidelog.operators.validate import through_validated, to_validated, validate
from tidelog.plans import ORACLES, QUERIES, examples
from tidelog.plans.examples import ledger, word_count
from tidelog.sources import addressing as A
from tidelog.sources import sinks
from tidelog.sources.topics import (Catalog, Topic, assign, assign_all, read_log, read_logs,
                                    read_matching, read_pattern, read_table, subscribe)


def topic(path, name="t", **kwargs):
    return Topic(name, "bigint", "bigint", path=str(path), **kwargs)


def test_write_and_read(spark, tmp_path, layout):
    log = log_of(spark, [(1, 1), (2, 2), (None, 3)])
    t = topic(tmp_path / "t", partitions=3)
    sinks.write_log(log, t)
    assert keyvals(read_log(spark, t)) == keyvals(log)
    assert all(d.startswith("partition=") or d.startswith(("_", "."))
               for d in os.listdir(tmp_path / "t"))


def test_partition_function(spark, tmp_path):
    t = topic(tmp_path / "t", partitions=4, partition_fn=lambda k, v, n: v % n)
    back = log_of(spark, [(1, 1), (1, 6)]).through(t)
    assert sorted(r["partition"] for r in back.df.collect()) == [1, 2]


def test_read_only_topics_refuse_writes(spark, tmp_path):
    t = topic(tmp_path / "t", read_only=True)
    for write in (sinks.write_log, sinks.append_log):
        with pytest.raises(sinks.ReadOnlyTopic):
            write(log_of(spark, [(1, 1)]), t)


def test_append_gives_out_offsets(spark, tmp_path, layout):
    t = topic(tmp_path / "t", partitions=2, partition_fn=lambda k, v, n: k % n)
    one = sinks.append_log(log_of(spark, [(0, 1), (1, 2), (0, 3)]), t)
    assert sorted((r["partition"], r["offset"]) for r in one.collect()) == [(0, 0), (0, 1), (1, 0)]
    two = sinks.append_log(log_of(spark, [(1, 4), (0, 5)]), t)
    assert sorted((r["partition"], r["offset"]) for r in two.collect()) == [(0, 2), (1, 1)]
    got = {(r["partition"], r["offset"]): r["value"] for r in read_log(spark, t).df.collect()}
    assert got == {(0, 0): 1, (0, 1): 3, (1, 0): 2, (0, 2): 5, (1, 1): 4}


def test_several_topics(spark, tmp_path):
    catalog = Catalog(topic(tmp_path / n, n) for n in ("b1", "a1", "a2"))
    for i, n in enumerate(catalog.names()):
        sinks.write_log(log_of(spark, [(i, i)]), catalog[n])
    assert catalog.names() == ["a1", "a2", "b1"]
    assert catalog.exists("a1") and not catalog.exists("a")
    names = lambda log: sorted(r["topic"] for r in log.df.collect())
    assert names(read_pattern(spark, catalog, "a.")) == ["a1", "a2"]
    assert names(subscribe(spark, catalog, ["a1", "b1"])) == ["a1", "b1"]
    everything = subscribe(spark, catalog, catalog.names())
    assert names(assign(everything, ("a2", 0))) == ["a2"]
    assert names(assign_all(everything, ["a1", "a2"])) == ["a1", "a2"]
    with pytest.raises(KeyError):
        subscribe(spark, catalog, ["nope"])
    with pytest.raises(ValueError):
        read_pattern(spark, catalog, "z.*")
    with pytest.raises(ValueError):
        read_logs(spark, [catalog["a1"], Topic("s", path=str(tmp_path / "s"))])


def test_topic_configuration(tmp_path):
    for error, kwargs in ((TypeError, {"name": ""}), (ValueError, {"name": "t"}),
                          (ValueError, {"name": "t", "path": "p", "partitions": 0}),
                          (TypeError, {"name": "t", "path": "p", "partition_fn": 3}),
                          (TypeError, {"name": "t", "path": "p", "options": {"a": 1}})):
        with pytest.raises(error):
            Topic(**kwargs)


def test_table_view(spark, tmp_path):
    t = topic(tmp_path / "t")
    sinks.write_log(log_of(spark, [(1, 1), (1, 2), (2, 5), (2, None)]), t)
    read_table(spark, t, store="balances")
    assert [tuple(r) for r in spark.sql("SELECT key, value FROM balances").collect()] == [(1, 2)]


def test_streamed_write(spark, tmp_path):
    a, b = topic(tmp_path / "a", "a"), topic(tmp_path / "b", "b", partitions=2)
    log = log_of(spark, [(1, 1), (2, 2)])
    sinks.write_log(log, a)
    back = read_log(spark, a, streaming=True).through(b)
    assert keyvals(back) == [(1, 1), (2, 2)]


def test_branches_are_written_from_one_pass(spark, tmp_path):
    a = topic(tmp_path / "a", "a")
    sinks.write_log(log_of(spark, [(1, 1), (1, -1), (2, 5)]), a)
    routes = {0: topic(tmp_path / "pos", "pos"), 1: topic(tmp_path / "neg", "neg")}
    routed = read_log(spark, a, streaming=True).branch_ids(
        [lambda k, v: v >= 0, lambda k, v: F.lit(True)])
    sinks.write_branches(routed, routes)
    assert keyvals(read_log(spark, routes[0])) == [(1, 1), (2, 5)]
    assert keyvals(read_log(spark, routes[1])) == [(1, -1)]


def test_batch_branches_compute_their_past_once(spark, tmp_path):
    passes = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            passes.add(batch.num_rows)
            yield batch

    log = log_of(spark, [(1, 1), (1, -1), (2, 5), (3, None)])
    log = Log(log.df.mapInArrow(noted, log.df.schema), log.order)
    routes = {i: topic(tmp_path / n, n) for i, n in enumerate(("pos", "neg", "none"))}
    sinks.write_branches(log.branch_ids([lambda k, v: v >= 0, lambda k, v: v < 0, lambda k, v: v > 99]), routes)
    assert keyvals(read_log(spark, routes[0])) == [(1, 1), (2, 5)]
    assert keyvals(read_log(spark, routes[1])) == [(1, -1)]
    assert passes.value == 4


def test_effects(spark, tmp_path, capsys):
    log = log_of(spark, [(1, 1), (1, 2)])
    place = str(tmp_path / "seen")
    os.makedirs(place)

    def touch(row):
        open(f"{place}/{row['value']}", "w").close()

    log.for_each(touch)
    assert sorted(os.listdir(place)) == ["1", "2"]
    seen = Observation()
    passed = log.peek(seen, F.sum("value").alias("total")).df.collect()
    assert sorted(r["value"] for r in passed) == [1, 2]
    assert seen.get == {"total": 3}
    frames = []
    sinks.for_each_batch(log, frames.append)
    assert frames[0].count() == 2
    log.print()
    assert "value" in capsys.readouterr().out
    sinks.write_as_text(log, str(tmp_path / "text"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "text")).collect()) == [
        "1, 1", "1, 2"]


def test_process_runs_for_its_effects(spark, tmp_path):
    place = str(tmp_path / "seen")
    os.makedirs(place)

    def step(ctx, key, value):
        open(f"{place}/{key}-{value}", "w").close()

    log_of(spark, [(1, 1), (2, 2)]).process(step)
    assert sorted(os.listdir(place)) == ["1-1", "2-2"]


def test_validated_writes(spark, tmp_path):
    t = topic(tmp_path / "t")
    rules = {"positive": lambda k, v: v > 0, "small": lambda k, v: v < 100}
    good, bad = log_of(spark, [(1, 1)]), log_of(spark, [(1, 1), (1, -5)])
    assert keyvals(through_validated(good, t, rules)) == [(1, 1)]
    with pytest.raises(Exception, match="record breaks positive"):
        to_validated(bad, t, rules)
    valid, invalid = validate(bad, rules, "quarantine")
    assert keyvals(valid) == [(1, 1)] and keyvals(invalid) == [(1, -5)]
    assert invalid.df.first()["errors"] == ["positive"]
    with pytest.raises(ValueError):
        validate(good, rules, "ignore")


# -- addressing: ten records, timed 1 .. 10 -----------------------------------------------


@pytest.fixture()
def seek_log(spark):
    return log_of(spark, [(i, i, i) for i in range(1, 11)]).select_key(
        lambda k, v: k.cast("string"))


def test_offsets(seek_log):
    row = A.offsets(seek_log).first()
    assert (row["begin_offset"], row["end_offset"]) == (0, 10)
    assert A.seek_to_end(seek_log).first()["offset"] == 10
    assert A.seek_to_beginning(seek_log).first()["offset"] == 0
    assert A.count_messages(seek_log).first()["messages"] == 10
    assert A.count_messages(seek_log, dense=True).first()["messages"] == 10
    assert A.partitions_of(seek_log).first()["partitions"] == [0]


@pytest.mark.parametrize("ms,past_end,want", [
    (10, "end", 9), (1, "end", 0), (1000, "end", 10), (1000, "end_plus_one", 11)])
def test_start_offsets(seek_log, ms, past_end, want):
    assert A.start_offsets(seek_log, F.lit(at(ms)), past_end).first()["offset"] == want


def test_offsets_for_times_and_seek(spark, seek_log, layout):
    times = spark.createDataFrame([("in", 0, 4), ("in", 0, 99)], "topic string, partition int, ms int")
    times = times.withColumn("at", F.timestamp_millis("ms")).drop("ms")
    got = {r["at"].second * 1000 + r["at"].microsecond // 1000: r["offset"]
           for r in A.offsets_for_times(seek_log, times).collect()}
    assert got == {4: 3, 99: None}
    assert [k for k, _ in keyvals(A.seek_to_timestamp(seek_log, F.lit(at(9))))] == ["9", "10"]
    assert len(keyvals(A.until(seek_log, F.lit(at(4))))) == 3
    with pytest.raises(ValueError):
        A.start_offsets(seek_log, F.lit(at(1)), "sometime")


def test_lookups(spark):
    df = spark.createDataFrame([(0, 1, (1, 99)), (1, 2, (2, 88)), (2, 1, (1, 77))],
                               "offset long, key long, value struct<id:long,v:long>")
    log = Log(df.withColumns({"ts": F.col("offset"), "topic": F.lit("t")}))
    assert [r["value"]["v"] for r in lookup.messages(log, "t").collect()] == [99, 88, 77]
    assert lookup.by_id(log, 1).first()["value"]["v"] == 99
    assert lookup.by_key(log, "v", 88).first()["value"]["id"] == 2
    assert lookup.by_key(log, "v", 5).collect() == []
    assert lookup.by_keys(log, "id", [1, 2]).df.count() == 3
    ids = lambda *xs: spark.createDataFrame([(x,) for x in xs], "id long")
    assert lookup.by_keys(log, "id", ids(2, 2, 9)).df.count() == 1
    assert lookup.all_keys_present(log, "id", ids(1, 2))
    assert not lookup.all_keys_present(log, "id", ids(1, 2, 4))
    assert [r[0] for r in lookup.missing_ids(log, "id", ids(1, 4, 4)).collect()] == [4]


# -- whole applications -----------------------------------------------------------------------

LINES = ["Tide in, tide out", "a log keeps what the tide brings", "the log, the whole log", "nothing but a LOG"]


def test_word_count(spark, layout):
    lines = Log(spark.createDataFrame([(i, i, None, t) for i, t in enumerate(LINES)],
                                      "ts int, offset int, key int, value string"))
    table = word_count(lines)
    last = dict(keyvals(table.updates()))
    assert (last["nothing"], last["tide"], last["log"]) == (1, 3, 4)
    assert last == {r["key"]: r["value"] for r in table.snapshot().collect()}


def test_ledger(spark, layout):
    entry = "struct<debit_account_name:string,credit_account_name:string,amount:long>"
    ids = ["00000000-0000-4000-8000-000000000001", "00000000-0000-4000-8000-000000000002"]
    requests = [(ids[0], [("foo", "bar", 2), ("foo", "qux", 3)]),
                (ids[1], [("foo", "bar", 5), ("foo", "qux", 7)]),
                (ids[0], [("foo", "foo", 1)]), (ids[0], []), (ids[0], [("a", "b", 0)])]
    log = Log(spark.createDataFrame([(i, i, None, r) for i, r in enumerate(requests)],
                                    f"ts int, offset int, key int, "
                                    f"value struct<id:string,entries:array<{entry}>>"))
    rows = [v for k, v in keyvals(ledger(log))]
    pick = lambda name, c: [r[c] for r in rows if r["account_name"] == name]
    assert pick("foo", "amount") == [-2, -3, -5, -7]
    assert pick("foo", "starting_balance") == [0, -2, -5, -10]
    assert pick("foo", "current_balance") == [-2, -5, -10, -17]
    assert pick("bar", "amount") == [2, 5]
    assert pick("bar", "starting_balance") == [0, 2]
    assert pick("bar", "current_balance") == [2, 7]
    assert len({r["id"] for r in rows}) == 8 and {r["causation_id"] for r in rows} == set(ids)


def test_accounts_of_a_ledger_are_cut_before_other_keys(spark, monkeypatch):
    """A task's memory is bounded by the rows of a part of an account, and by what a row holds."""
    folder, query = "/root/testdata/sf0.001", QUERIES["ledger_balances"]
    monkeypatch.setattr(examples, "ACCOUNT_ROWS", 40)
    node, sorted_together = [query(spark, folder)._jdf.queryExecution().optimizedPlan()], []
    while node:
        at = node.pop()
        if at.nodeName() == "Window" and "__part" not in at.toString().split("\n")[0]:
            sorted_together.append({c.split("#")[0] for c in at.child().output().mkString(";").split(";")})
        node += [at.children().apply(i) for i in range(at.children().size())]
    assert any("__slice" in columns for columns in sorted_together)
    assert all(columns <= {"key", "value", "amount", "ts", "offset", "pos2", "causation_id", "__slice"}
               for columns in sorted_together)
    assert compare(spark, folder, "ledger_balances", query, ORACLES["ledger_balances"]) is None


def test_shared_folders_lie_where_the_cluster_says(spark):
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    one, two = (session.shared_folder(spark, "x") for _ in range(2))
    assert one != two
    assert base is None or one.startswith(base)


def test_topics_below_a_folder_by_pattern(spark, tmp_path):
    like = topic(tmp_path, partitions=2, partition_fn=lambda k, v, n: k % n)
    for n, name in enumerate(("a1", "a 2+b", "b1")):
        sinks.write_log(log_of(spark, [(n, n), (n + 1, n)]), topic(
            tmp_path / name, name, partitions=2, partition_fn=lambda k, v, n: k % n))
    # a file of a topic that is not asked for is not opened
    (tmp_path / "b1" / "partition=0" / "broken.parquet").write_text("no parquet")
    (tmp_path / "xa1").mkdir()
    (tmp_path / "xa1" / "broken.parquet").write_text("no parquet")

    def rows(log):
        return sorted((r.topic, r.partition, r.key, r.value) for r in log.df.collect())

    found = read_matching(spark, str(tmp_path), "a.*", like)
    assert rows(found) == [("a 2+b", 0, 2, 1), ("a 2+b", 1, 1, 1), ("a1", 0, 0, 0), ("a1", 1, 1, 0)]
    assert rows(assign(found, ("a1", 1))) == [("a1", 1, 1, 0)]
    assert rows(read_matching(spark, str(tmp_path), "a1|zz", like)) == [("a1", 0, 0, 0), ("a1", 1, 1, 0)]
    assert rows(read_matching(spark, str(tmp_path), "zz", like)) == []
    with pytest.raises(TypeError):
        read_matching(spark, str(tmp_path), "a.*", "a1")


def test_a_running_stream_takes_in_new_topics(spark, tmp_path):
    root, like = tmp_path / "topics", topic(tmp_path)
    write = lambda name, pairs: sinks.write_log(log_of(spark, pairs), topic(root / name, name))
    write("a1", [(1, 1)])
    seen = []
    log = read_matching(spark, str(root), "a.*", like, streaming=True)
    query = (log.df.writeStream.option("checkpointLocation", str(tmp_path / "place"))
             .foreachBatch(lambda df, n: seen.append(sorted((r.topic, r.key) for r in df.collect()))).start())
    try:
        query.processAllAvailable()
        write("b1", [(9, 9)])
        write("a2", [(2, 2), (3, 3)])
        query.processAllAvailable()
        write("a1", [(4, 4)])
        query.processAllAvailable()
    finally:
        query.stop()
    assert [s for s in seen if s] == [[("a1", 1)], [("a2", 2), ("a2", 3)], [("a1", 4)]]
