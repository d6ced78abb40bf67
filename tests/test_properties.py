"""Laws that hold for any log, with whole and with split histories."""

import pytest
from helpers import keyvals, last_of, log_of, state
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog import session
from tidelog.operators.reducers import (counted, earliest, largest, newest, smallest, total)

# One key in three holds most of the records; deletes are frequent.
records = st.lists(st.tuples(st.sampled_from([1, 1, 1, 2, 3]),
                             st.one_of(st.none(), st.integers(-50, 50))), min_size=1, max_size=25)
law = settings(max_examples=2, deadline=None, derandomize=True,
               suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture(params=["plain", "mixed"])
def cut(request, monkeypatch):
    """Whole histories, or only those of more than three records cut into slices."""
    if request.param == "mixed":
        monkeypatch.setattr(session, "ROWS_PER_TASK", 3)
        monkeypatch.setattr(session, "ROWS_PER_SLICE", 2)
    return request.param


@law
@given(records)
def test_snapshot_is_the_last_update_of_each_key(spark, cut, rows):
    log = log_of(spark, rows)
    tables = [log.to_table().filter(lambda k, v: v > 0)]
    tables += [log.group_by_key().reduce(r) for r in (total(), smallest(), largest(), earliest(),
                                                      newest(), counted())]
    for table in tables:
        assert last_of(table.updates()) == state(table.snapshot())


@law
@given(records)
def test_regrouping_with_retraction_equals_grouping_the_state(spark, cut, rows):
    table = log_of(spark, rows).to_table()
    groups = table.group_by(lambda k, v: (v % 3, v))
    live = {}
    for k, v in rows:
        live[k] = v
    want, counts = {}, {}
    for v in live.values():
        if v is not None:
            want[v % 3] = want.get(v % 3, 0) + v
            counts[v % 3] = counts.get(v % 3, 0) + 1
    # a group that lost all its rows stays, with nothing in it
    drop_empty = lambda d: {k: v for k, v in d.items() if counts.get(k)}
    # Spark's % takes the sign of the dividend, Python's of the divisor
    if all(v is None or v >= 0 for _, v in rows):
        assert drop_empty(state(groups.reduce(total()).snapshot())) == want
        assert drop_empty(state(groups.count().snapshot())) == counts
    for out in (groups.reduce(total()), groups.count()):
        assert last_of(out.updates()) == state(out.snapshot())


@law
@given(records)
def test_filters_and_branches_partition_a_log(spark, rows):
    log = log_of(spark, rows)
    big = lambda k, v: v > 10
    both = keyvals(log.filter(big)) + keyvals(log.filter_not(big))
    assert sorted(both, key=str) == sorted(rows, key=str)
    parts = log.branch([big, lambda k, v: k == 1, lambda k, v: F.lit(True)])
    assert sorted((r for p in parts for r in keyvals(p)), key=str) == sorted(rows, key=str)


@law
@given(records, records)
def test_table_join_state_is_its_last_update(spark, cut, left, right):
    a = log_of(spark, left).to_table()
    b = log_of(spark, right, first_offset=100).to_table()
    add = lambda x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0))
    for joined in (a.join(b, add), a.left_join(b, add), a.outer_join(b, add),
                   a.join(b, lambda v: F.abs(v) % 3 + 1, add)):
        assert last_of(joined.updates()) == state(joined.snapshot())
