"""Golden traces: a few records in, the whole changelog out, in order."""

import pytest
from helpers import keyvals, last_of, log_of, safe_add, state, two_logs
from pyspark.sql import functions as F

from tidelog.operators.reducers import Fold, largest, newest, total
from tidelog.operators.stateful import Store
from tidelog.operators.table import GlobalTable
from tidelog.operators.windows import (JoinWindows, SessionWindows, SuppressBufferFull,
                                       TimeWindows, split_late)

ADD = lambda a, b: a + b
TENS = lambda k, v: F.floor(k / 10).cast("long")


def test_filters(spark):
    log = log_of(spark, [(1, 1), (1, 2), (1, None)])
    assert keyvals(log.filter(lambda k, v: v > 1)) == [(1, 2)]
    assert keyvals(log.filter_not(lambda k, v: v > 1)) == [(1, 1), (1, None)]


def test_maps(spark):
    log = log_of(spark, [(1, 1)])
    assert keyvals(log.map(lambda k, v: (k + 1, v + 1))) == [(2, 2)]
    assert keyvals(log.select_key(lambda k, v: k + 1)) == [(2, 1)]
    assert keyvals(log_of(spark, [(1, 1), (1, 2)]).map_values(lambda v: v + 1)) == [(1, 2), (1, 3)]
    assert keyvals(log.flat_map(lambda k, v: [(k, v), (k, F.lit(0))])) == [(1, 1), (1, 0)]
    assert keyvals(log.flat_map_values(lambda v: [v, v + 1])) == [(1, 1), (1, 2)]


def test_branch_takes_the_first_match(spark):
    pos, neg = log_of(spark, [(1, 1), (1, -1)]).branch(
        [lambda k, v: v >= 0, lambda k, v: F.lit(True)])
    assert keyvals(pos) == [(1, 1)]
    assert keyvals(neg) == [(1, -1)]


def test_merge(spark):
    a, b = log_of(spark, [(1, 1, 1)]), log_of(spark, [(100, 2, 2)])
    assert keyvals(a.merge(b)) == [(1, 1), (2, 2)]


def test_table_filter(spark, layout):
    table = log_of(spark, [(1, 2), (1, 0)]).to_table().filter(lambda k, v: v != 0)
    assert keyvals(table.updates()) == [(1, 2), (1, None)]
    assert state(table.snapshot()) == {}
    table = log_of(spark, [(1, 0), (1, 2)]).to_table().filter_not(lambda k, v: v != 0)
    assert keyvals(table.updates()) == [(1, 0), (1, None)]


def test_table_filter_drops_idle_tombstones(spark, layout):
    table = log_of(spark, [(1, 0), (1, 2), (1, 0), (1, 0)]).to_table().filter(lambda k, v: v != 0)
    assert keyvals(table.updates()) == [(1, 2), (1, None)]


def test_table_map_values(spark):
    table = log_of(spark, [(1, 0), (1, 2), (2, 0), (2, None)]).to_table()
    out = table.map_values(lambda v: v + 1)
    assert keyvals(out.updates()) == [(1, 1), (1, 3), (2, 1), (2, None)]
    assert state(out.snapshot()) == {1: 3}


def test_table_to_stream_with_key(spark):
    table = log_of(spark, [(1, 5), (2, 6)]).to_table()
    assert keyvals(table.to_stream(lambda k, v: v * 10)) == [(50, 5), (60, 6)]


def test_count(spark, layout):
    table = log_of(spark, [(1, 1), (1, 2)]).group_by_key().count()
    assert keyvals(table.updates()) == [(1, 1), (1, 2)]
    assert state(table.snapshot()) == {1: 2}


def test_groups_skip_null_keys_and_values(spark, layout):
    log = log_of(spark, [(1, 1), (None, 2), (1, None), (1, 4)])
    table = log.group_by_key().reduce(total())
    assert keyvals(table.updates()) == [(1, 1), (1, 5)]
    assert state(table.snapshot()) == {1: 5}


def test_reduce_and_aggregate(spark, layout):
    grouped = log_of(spark, [(1, 1), (1, 2), (10, 2)]).group_by(TENS)
    assert keyvals(grouped.reduce(total()).updates()) == [(0, 1), (0, 3), (1, 2)]
    table = grouped.aggregate(-10, total())
    assert keyvals(table.updates()) == [(0, -9), (0, -7), (1, -8)]
    assert state(table.snapshot()) == {0: -7, 1: -8}


def test_diff(spark, layout):
    log = log_of(spark, [(1, 5), (1, 8)]).group_by_key().diff()
    assert keyvals(log) == [(1, None), (1, 3)]


def test_tumbling(spark, layout):
    log = log_of(spark, [(1000, 1, 1), (1500, 1, 2), (5000, 1, 4)])
    windowed = log.group_by(TENS).window_by_time(TimeWindows(1000, grace_ms=0))
    table = windowed.reduce(total())
    assert keyvals(table.updates()) == [(0, 1), (0, 3), (0, 4)]
    assert sorted(r["value"] for r in table.snapshot().collect()) == [3, 4]


def test_hopping_puts_a_record_in_several_windows(spark):
    log = log_of(spark, [(1000, 1, 1), (1500, 1, 2)])
    table = log.group_by_key().window_by_time(TimeWindows(1000, 500, 0)).reduce(total())
    got = {r["window"]["start"].timestamp(): r["value"] for r in table.snapshot().collect()}
    assert got == {0.5: 1, 1.0: 3, 1.5: 2}


def test_session_reduce(spark, layout):
    log = log_of(spark, [(1000, 1, 1), (1500, 1, 2), (5000, 1, 3), (5100, 12, 3)])
    table = log.group_by(TENS).window_by_session(SessionWindows(1000, 0)).reduce(total())
    assert keyvals(table.updates()) == [(0, 1), (0, None), (0, 3), (0, 3), (1, 3)]
    assert sorted((r["key"], r["value"]) for r in table.snapshot().collect()) == [
        (0, 3), (0, 3), (1, 3)]


@pytest.mark.parametrize("reducer", ["algebraic", "fold"])
def test_session_aggregate(spark, layout, reducer):
    log = log_of(spark, [(100, 1, 4), (1000, 1, 3), (1200, 1, 3), (5000, 1, 2), (5100, 2, 1)])
    grouped = log.group_by_key().window_by_session(SessionWindows(1000, 0))
    if reducer == "fold":
        fold = Fold(0, lambda acc, k, v: acc + v, "long", lambda k, a, b: a + b)
        got = grouped.reduce(fold).snapshot().collect()
        assert sorted((r["key"], r["value"]) for r in got) == [(1, 2), (1, 10), (2, 1)]
        return
    table = grouped.aggregate(0, total())
    assert keyvals(table.updates()) == [
        (1, 4), (1, None), (1, 7), (1, None), (1, 10), (1, 2), (2, 1)]


def test_session_gap_is_inclusive(spark):
    log = log_of(spark, [(0, 1, 1), (1000, 1, 1), (2001, 1, 1)])
    table = log.group_by_key().window_by_session(SessionWindows(1000, 0)).count()
    assert sorted(r["value"] for r in table.snapshot().collect()) == [1, 2]


def test_grouped_table(spark, layout):
    table = log_of(spark, [(1, 1), (2, 2), (2, None), (10, 3)]).to_table()
    grouped = table.group_by(lambda k, v: (F.floor(k / 10).cast("long"), v))
    for out in (grouped.reduce(total()), grouped.aggregate(0, total())):
        assert keyvals(out.updates()) == [(0, 1), (0, 3), (0, 1), (1, 3)]
        assert state(out.snapshot()) == {0: 1, 1: 3}
    table = log_of(spark, [(1, 0), (2, 0)]).to_table()
    count = table.group_by(lambda k, v: (F.when(k % 2 == 0, k).otherwise(k + 1), v)).count()
    assert keyvals(count.updates()) == [(2, 1), (2, 2)]


def test_grouped_table_row_changes_group(spark, layout):
    rows = [("x", ("a", 1)), ("y", ("a", 3)), ("y", ("b", 5)), ("x", None)]
    df = spark.createDataFrame([(i, i, k, v) for i, (k, v) in enumerate(rows)],
                               "ms long, offset long, key string, value struct<g:string,i:long>")
    from tidelog.operators.log import Log
    log = Log(df.withColumn("ts", F.timestamp_millis("ms")))
    out = log.to_table().group_by(lambda k, v: (v["g"], v["i"])).aggregate(0, total())
    assert keyvals(out.updates()) == [("a", 1), ("a", 4), ("a", 1), ("b", 5), ("a", 0)]
    assert state(out.snapshot()) == {"a": 0, "b": 5}


def test_stream_table_join(spark, layout):
    left, right = two_logs(spark, [("L", 1, 1), ("R", 1, 10), ("L", 1, 100), ("R", 1, 1000),
                                   ("L", 1, 10000), ("R", 2, 1), ("L", 2, 10)])
    assert keyvals(left.join(right.to_table(), ADD)) == [(1, 110), (1, 11000), (2, 11)]
    left, right = two_logs(spark, [("L", 1, 2), ("R", 1, 1), ("L", 1, 2), ("R", 1, None),
                                   ("L", 1, 7)])
    assert keyvals(left.left_join(right.to_table(), safe_add)) == [(1, 2), (1, 3), (1, 7)]
    assert keyvals(left.join(right.to_table(), ADD)) == [(1, 3)]


def test_global_join(spark):
    left, right = two_logs(spark, [("L", 1, 1), ("R", 1, 2), ("L", 1, 4)])
    table = GlobalTable.of(right.to_table())
    by_key = lambda k, v: k
    assert keyvals(left.join_global(table, by_key, ADD, as_of=True)) == [(1, 6)]
    assert keyvals(left.left_join_global(table, by_key, safe_add, as_of=True)) == [(1, 1), (1, 6)]
    assert keyvals(left.join_global(table, by_key, ADD)) == [(1, 3), (1, 6)]


TABLES = [("L", 1, 1), ("R", 1, 2), ("L", 1, 4), ("L", 2, 42)]


def test_table_joins(spark, layout):
    left, right = (x.to_table() for x in two_logs(spark, TABLES))
    assert keyvals(left.join(right, ADD).updates()) == [(1, 3), (1, 6)]
    assert keyvals(left.outer_join(right, safe_add).updates()) == [
        (1, 1), (1, 3), (1, 6), (2, 42)]
    assert state(left.outer_join(right, safe_add).snapshot()) == {1: 6, 2: 42}
    assert state(left.join(right, ADD).snapshot()) == {1: 6}
    left, right = (x.to_table() for x in two_logs(spark, TABLES[:3] + [("R", 2, 42)]))
    assert keyvals(left.left_join(right, safe_add).updates()) == [(1, 1), (1, 3), (1, 6)]


def test_table_join_emits_one_tombstone_when_a_pair_breaks(spark, layout):
    left, right = (x.to_table() for x in two_logs(
        spark, [("L", 1, 1), ("R", 1, 2), ("R", 1, None), ("R", 1, None), ("L", 1, 5)]))
    assert keyvals(left.join(right, ADD).updates()) == [(1, 3), (1, None)]


def test_foreign_key_join(spark, layout):
    left, right = (x.to_table() for x in two_logs(
        spark, [("L", 1, 1), ("R", 1, 2), ("L", 2, 2), ("R", 2, 2)]))
    joined = left.join(right, lambda v: v, ADD)
    assert keyvals(joined.updates()) == [(1, 3), (2, 4)]
    assert state(joined.snapshot()) == {1: 3, 2: 4}


def test_foreign_key_join_right_update_reaches_all_left_rows(spark, layout):
    left, right = (x.to_table() for x in two_logs(
        spark, [("R", 7, 100), ("L", 1, 7), ("L", 2, 7), ("R", 7, 200), ("L", 1, 8), ("R", 7, None),
                ("R", 8, 1)]))
    joined = left.join(right, lambda v: v, ADD)
    got = joined.updates()
    by_key = {k: [v for key, v in keyvals(got) if key == k] for k in (1, 2)}
    assert by_key == {1: [107, 207, None, 9], 2: [107, 207, None]}
    assert last_of(got) == state(joined.snapshot()) == {1: 9}


def walked(records, fk):
    """A foreign-key join by hand: (place, left key, value) of every change."""
    left, right, out = {}, {}, []
    for i, (side, key, value) in enumerate(records):
        met = lambda k: (left.get(k) is not None and right.get(fk(left[k])) is not None
                         and left[k] + right[fk(left[k])]) or None
        touched = [key] if side == "L" else [k for k, v in left.items() if v is not None and fk(v) == key]
        before = {k: met(k) for k in touched}
        (left if side == "L" else right)[key] = value
        out += [(i, k, met(k)) for k in touched if before[k] is not None or met(k) is not None]
    return sorted(out, key=str)


def joined_by_hand_and_by_spark(spark, records, fk):
    left, right = (x.to_table() for x in two_logs(spark, records))
    got = left.join(right, fk, ADD).updates().df.select("offset", "key", "value").collect()
    return walked(records, fk), sorted(map(tuple, got), key=str)


def test_foreign_key_join_against_a_walk(spark, layout):
    records = [("LRL"[i % 3], i % 4 if i % 3 != 1 else i * 7 % 5, None if i % 7 == 6 else 1 + i * 5 % 9)
               for i in range(80)]
    hand, spark_rows = joined_by_hand_and_by_spark(spark, records, lambda v: v % 5)
    assert hand == spark_rows and any(v is None for _, _, v in hand)


def test_foreign_key_join_of_one_busy_key_makes_no_pairs_in_vain(spark):
    """Ten thousand versions on each side: 10**8 pairs of them, 2 * 10**4 changes."""
    records = [("LR"[i % 2], i % 2, 1 + 2 * (i // 2)) for i in range(20_000)]
    hand, spark_rows = joined_by_hand_and_by_spark(spark, records, lambda v: v % 2)
    assert hand == spark_rows and len(hand) == 19_999


WINDOWED = [("L", 1, 1, 1), ("R", 100, 1, 2), ("R", 10000, 1, 4)]


def test_windowed_joins(spark):
    left, right = two_logs(spark, WINDOWED)
    near = JoinWindows.of(1000)
    assert keyvals(left.join_windowed(right, ADD, near)) == [(1, 3)]
    assert keyvals(left.outer_join_windowed(right, safe_add, near)) == [(1, 3), (1, 4)]
    assert keyvals(left.outer_join_windowed(right, safe_add, near, eager=True)) == [
        (1, 1), (1, 3), (1, 4)]
    assert keyvals(left.left_join_windowed(right, safe_add, JoinWindows.of(10))) == [(1, 1)]


def test_windowed_join_bounds_are_inclusive_and_may_differ(spark):
    left, right = two_logs(spark, [("R", 0, 1, 1), ("L", 100, 1, 10), ("R", 300, 1, 2),
                                   ("R", 301, 1, 3)])
    assert keyvals(left.join_windowed(right, ADD, JoinWindows(100, 200))) == [(1, 11), (1, 12)]
    assert keyvals(left.join_windowed(right, ADD, JoinWindows(99, 201))) == [(1, 12), (1, 13)]


HELD = [(1, 1, 3), (2, 1, 4), (201, 1, 1), (202, 1, 2)]


def suppressed(spark, records, **limits):
    log = log_of(spark, records)
    return log.group_by_key().window_by_time(TimeWindows(100, grace_ms=1)).reduce(
        total()).suppress(**limits)


def test_suppress_until_windows_close(spark):
    assert keyvals(suppressed(spark, HELD + [(303, 1, 1)])) == [(1, 7), (1, 3)]


def test_suppress_with_a_bounded_buffer(spark, layout):
    records = HELD + [(210, 1, 3), (303, 1, 1)]
    assert keyvals(suppressed(spark, records, max_records=2)) == [(1, 7), (1, 6)]
    with pytest.raises(SuppressBufferFull):
        suppressed(spark, [(1, 1, 3), (2, 2, 4), (2, 3, 4)], max_records=2)
    with pytest.raises(SuppressBufferFull):
        suppressed(spark, records, max_bytes=8)


def test_suppress_until_time_limit(spark, layout):
    log = log_of(spark, [(1, 1, 3), (2, 1, 4), (12, 1, 4), (201, 1, 1), (202, 1, 2), (222, 1, 3)])
    held = log.group_by_key().count().suppress(until_time_limit_ms=10)
    assert keyvals(held) == [(1, 3), (1, 6)]


def test_suppress_between_joined_tables(spark, layout):
    left, right = two_logs(spark, [("L", 10, 1, 1), ("R", 11, 1, 2), ("R", 20, 1, 3),
                                   ("R", 25, 1, 4), ("R", 35, 1, 5)])
    joined = left.to_table().left_join(right.to_table(), safe_add)
    assert keyvals(joined.suppress(until_time_limit_ms=10)) == [(1, 4), (1, 6)]


def test_another_key_lets_a_held_update_out(spark, layout):
    log = log_of(spark, [(0, 1, 1), (5, 1, 2), (10, 2, 9), (11, 1, 3), (40, 2, 8)])
    held = log.to_table().suppress(until_time_limit_ms=10)
    assert sorted(keyvals(held)) == [(1, 2), (1, 3), (2, 8)]
    with pytest.raises(SuppressBufferFull):
        log.to_table().suppress(until_time_limit_ms=50, max_records=1)


def test_split_late(spark, layout):
    log = log_of(spark, [(0, 1, 1), (100, 1, 2), (90, 1, 3), (120, 1, 4), (95, 1, 5)])
    kept, late = split_late(log, TimeWindows(100, grace_ms=20))
    assert [v for _, v in keyvals(late)] == [5]
    assert sorted(v for _, v in keyvals(kept)) == [1, 2, 3, 4]


def test_fold_in_order(spark, layout):
    log = log_of(spark, [(1, 1), (2, 7), (1, 2), (1, 4)])
    spell = Fold("", lambda acc, k, v: acc + str(v), "string", lambda k, a, b: a + b)
    table = log.group_by_key().fold(spell)
    assert state(table.snapshot()) == {1: "124", 2: "7"}
    assert keyvals(table.updates()) == [(1, "1"), (2, "7"), (1, "12"), (1, "124")]


def added(ctx, value):
    cell = ctx.store("total")
    cell.put((cell.get() or 0) + value)
    return cell.get()


def merged(a, b):
    return b if a is None else a if b is None else a + b


@pytest.mark.parametrize("merge", [None, merged])
def test_stateful_transforms(spark, layout, merge):
    log, store = log_of(spark, [(1, 1), (1, 2), (1, 4)]), [Store("total", "long", merge)]
    assert keyvals(log.transform(lambda c, k, v: (k * 2, added(c, v)), "long", "long", store)) == [
        (2, 1), (2, 3), (2, 7)]
    flat = log.flat_transform(lambda c, k, v: [(k * n, added(c, v)) for n in (10, 20)],
                              "long", "long", store)
    assert keyvals(flat) == [(10, 1), (20, 2), (10, 4), (20, 6), (10, 10), (20, 14)]
    assert keyvals(log.transform_values(added, "long", store)) == [(1, 1), (1, 3), (1, 7)]
    flat = log.flat_transform_values(lambda c, v: [added(c, v) + n for n in (100, 200)],
                                     "long", store)
    assert keyvals(flat) == [(1, 101), (1, 202), (1, 104), (1, 206), (1, 110), (1, 214)]


def test_step_reads_metadata_and_nested_values(spark):
    log = log_of(spark, [(100, 10)]).map_values(lambda v: F.struct(v.alias("val")))
    out = log.transform_values(lambda c, v: {"new_val": v["val"] + 1, "topic": c.topic},
                               "struct<new_val:long,topic:string>")
    assert keyvals(out) == [(100, {"new_val": 11, "topic": "in"})]


def test_state_store(spark, layout):
    def step(ctx, key, value):
        store = ctx.store("sums")
        now = store.get()
        store.put({"value": value if now is None else now["value"] + value})
        return key, store.get()

    log = log_of(spark, [(1, 1), (1, 2), (1, 3), (2, 10), (2, 20), (2, 30)])
    out = log.transform(step, "long", "struct<value:long>", [Store("sums", "struct<value:long>")])
    assert dict(keyvals(out)) == {1: {"value": 6}, 2: {"value": 60}}


def test_other_reducers(spark, layout):
    grouped = log_of(spark, [(1, 5), (1, 2), (1, 9), (1, 3)]).group_by_key()
    assert [v for _, v in keyvals(grouped.reduce(largest()).updates())] == [5, 5, 9, 9]
    assert state(grouped.reduce(newest()).snapshot()) == {1: 3}


def test_arguments_are_checked(spark):
    log = log_of(spark, [(1, 1)])
    for bad in (lambda: log.filter(1), lambda: log.map_values("x"), lambda: log.merge(3),
                lambda: log.join("t", ADD), lambda: log.group_by_key().window_by_time(5)):
        with pytest.raises(TypeError):
            bad()
    for bad in (lambda: TimeWindows(0), lambda: JoinWindows(-1, 2), lambda: log.branch([]),
                lambda: TimeWindows(10, 20), lambda: log.to_table().suppress(),
                lambda: log.group_by_key().aggregate(1, largest())):
        with pytest.raises(ValueError):
            bad()
