"""TABLE: keyed rows that later records replace; a null value deletes the row.

Every table has two faces.  ``updates`` is the changelog: one record for every
change, tombstones included.  ``snapshot`` is the final state: one row per live
key, computed by partial aggregation without going through the changelog.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.log import KEY, VALUE, Log, Pairwise, holds, need_callable
from tidelog.operators.timeline import Timeline


class Table:
    def __init__(self, updates: Callable[[], Log], snapshot: Callable[[], DataFrame],
                 keys: tuple[str, ...] = (KEY,), windows=None, source: Log | None = None):
        self._updates, self._snapshot = updates, snapshot
        self.keys, self.windows, self.source = keys, windows, source

    @classmethod
    def from_log(cls, log: Log) -> Table:
        """Read a log as upserts: the last value per key counts."""
        named = log._with(log.df.where(F.col(KEY).isNotNull()))

        def snapshot() -> DataFrame:
            # boxed, so that a latest null (a delete) beats an older value
            newest = F.max_by(F.struct(VALUE), named.position).alias("row")
            return (named.df.groupBy(KEY).agg(newest)
                    .select(KEY, F.col("row.value").alias(VALUE)).where(F.col(VALUE).isNotNull()))

        return cls(lambda: named, snapshot, source=named)

    def updates(self) -> Log:
        return self._updates()

    def snapshot(self) -> DataFrame:
        return self._snapshot()

    def to_stream(self, key: Pairwise | None = None) -> Log:
        """The table's update stream, optionally under a new key."""
        log = self.updates()
        return log.select_key(key) if key else log

    def as_view(self, name: str) -> Table:
        """Name the materialised state, for later lookups with SQL."""
        self.snapshot().createOrReplaceTempView(name)
        return self

    def _derived(self, updates, snapshot) -> Table:
        return Table(updates, snapshot, self.keys, self.windows, self.source)

    # -- filters and projections -------------------------------------------

    def filter(self, pred: Pairwise) -> Table:
        need_callable(pred, "predicate")
        return self._filtered(lambda: holds(pred(F.col(KEY), F.col(VALUE))))

    def filter_not(self, pred: Pairwise) -> Table:
        need_callable(pred, "predicate")
        return self._filtered(lambda: ~holds(pred(F.col(KEY), F.col(VALUE))))

    def _filtered(self, kept: Callable[[], Column]) -> Table:
        def updates() -> Log:
            log = self.updates()
            out = F.when(F.col(VALUE).isNotNull() & kept(), F.col(VALUE))
            return without_idle_tombstones(log, log.df.withColumn(VALUE, out), self.keys)

        return self._derived(updates, lambda: self.snapshot().where(kept()))

    def map_values(self, fn: Callable[[Column], Column]) -> Table:
        need_callable(fn, "value mapper")
        mapped = lambda: F.when(F.col(VALUE).isNotNull(), fn(F.col(VALUE)))

        def updates() -> Log:
            log = self.updates()
            return log._with(log.df.withColumn(VALUE, mapped()))

        return self._derived(updates, lambda: self.snapshot().withColumn(VALUE, mapped()))

    # -- grouping ------------------------------------------------------------

    def group_by(self, fn: Callable[[Column, Column], tuple[Column, Column]]):
        from tidelog.operators.grouped import GroupedTable
        need_callable(fn, "grouping")
        return GroupedTable(self, fn)

    # -- joins ---------------------------------------------------------------

    def join(self, other: Table, *args) -> Table:
        """``join(other, joiner)`` on the key, ``join(other, foreign_key, joiner)`` on a value."""
        from tidelog.operators.joins import foreign_key_join, table_join
        if len(args) == 2:
            return foreign_key_join(self, other, *args)
        return table_join(self, other, *args, how="inner")

    def left_join(self, other: Table, joiner: Pairwise) -> Table:
        from tidelog.operators.joins import table_join
        return table_join(self, other, joiner, how="left")

    def outer_join(self, other: Table, joiner: Pairwise) -> Table:
        from tidelog.operators.joins import table_join
        return table_join(self, other, joiner, how="full")

    # -- suppression ----------------------------------------------------------

    def suppress(self, until_time_limit_ms: int | None = None, max_records: int | None = None,
                 max_bytes: int | None = None) -> Log:
        from tidelog.operators.windows import suppress
        return suppress(self, until_time_limit_ms, max_records, max_bytes)


class GlobalTable(Table):
    """A table every task may look up whole; only ever the right side of a join."""

    @classmethod
    def of(cls, table: Table) -> GlobalTable:
        return cls(table._updates, table._snapshot, table.keys, source=table.source)


def without_idle_tombstones(log: Log, df: DataFrame, keys: tuple[str, ...]) -> Log:
    """Drop a tombstone whose key had no output before it."""
    line = Timeline.of(df, keys, log.order, log.derived).previous("__before", F.col(VALUE))
    kept = line.frame.where(F.col(VALUE).isNotNull() | F.col("__before").isNotNull())
    return Log(kept.drop("__before"), log.order, derived=True)
