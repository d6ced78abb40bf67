"""Grouped logs and grouped tables: count, reduce and aggregate."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.extremes import extreme_changes
from tidelog.operators.log import KEY, VALUE, Log, need_type
from tidelog.operators.reducers import Fold, Reducer, counted
from tidelog.operators.table import Table
from tidelog.operators.timeline import Timeline


def _seeded(result: Column, init) -> Column:
    """An additive result with its initial value."""
    return result if init is None else F.lit(init) + F.coalesce(result, F.lit(0))


def _check_init(reducer, init) -> None:
    need_type(reducer, Reducer, "reducer")
    if init is not None and not reducer.invertible:
        raise ValueError(f"an initial value has no meaning for {reducer.kind!r}; use a Fold")


@dataclass(frozen=True)
class GroupedLog:
    """Records under a key, and under a window when ``windows`` is set.

    Records with a null key or a null value take no part.
    """

    log: Log
    keys: tuple[str, ...] = (KEY,)
    windows: object = None
    arrived: Log | None = None  # what was put into windows, late records included
    most: int | None = None  # rows of a key that a task may hold, if fewer than the session says

    @property
    def rows(self) -> DataFrame:
        return self.log.df.where(F.col(KEY).isNotNull() & F.col(VALUE).isNotNull())

    def count(self) -> Table:
        return self._table(counted(), None)

    def reduce(self, reducer: Reducer | Fold) -> Table:
        return self._table(reducer, None)

    def aggregate(self, init, reducer: Reducer) -> Table:
        return self._table(reducer, init)

    def fold(self, fold: Fold) -> Table:
        return self._table(fold, None)

    def _table(self, reducer, init) -> Table:
        if isinstance(reducer, Fold):
            from tidelog.operators.stateful import folded
            return folded(self, reducer.starting(init))
        _check_init(reducer, init)
        log = self.log

        def snapshot() -> DataFrame:
            return (self.rows.groupBy(*self.keys).agg(reducer.grouped(log.order).alias(VALUE))
                    .withColumn(VALUE, _seeded(F.col(VALUE), init)))

        def updates() -> Log:
            line = Timeline.of(self.rows, self.keys, log.order, log.derived, self.most)
            # state on a stream takes a column by its name once
            line = line.running("__run", reducer.kind, VALUE if log.streaming and reducer.plain else reducer.input())
            out = line.frame.withColumn(VALUE, _seeded(F.col("__run"), init)).drop("__run")
            return Log(out, log.order, derived=True)

        return Table(updates, snapshot, self.keys, self.windows, self.arrived or log)

    def diff(self) -> Log:
        """Each value less the one before it under the same key; null for the first."""
        line = Timeline.of(self.rows, self.keys, self.log.order, self.log.derived)
        line = line.previous("__before", F.col(VALUE))
        return Log(line.frame.withColumn(VALUE, F.col(VALUE) - F.col("__before"))
                   .drop("__before"), self.log.order, derived=True)

    def window_by_time(self, windows) -> GroupedLog:
        """Put every record into the tumbling or hopping windows it falls in.

        A window that closed, grace included, before a record came does not take it:
        on batch input by the stream time of the record's partition, where the log
        still has ``partition`` and ``offset``; on a stream by its watermark.
        """
        from tidelog.operators.windows import ARRIVAL, TimeWindows, split_late
        need_type(windows, TimeWindows, "windows")
        if self.log.streaming or not ARRIVAL <= set(self.log.df.columns):
            kept = self.log._with(windows.assign(self.log.df))
        else:
            kept = split_late(self.log._with(self.rows), windows)[0]
            kept = kept._with(kept.df.drop("stream_time"))
        return GroupedLog(kept, (KEY, "window"), windows, self.log)

    def window_by_session(self, windows):
        from tidelog.operators.windows import SessionGrouped, SessionWindows
        need_type(windows, SessionWindows, "windows")
        return SessionGrouped(self, windows)


@dataclass(frozen=True)
class GroupedTable:
    """A table regrouped: an update leaves its old group and enters its new one."""

    table: Table
    mapper: Callable[[Column, Column], tuple[Column, Column]]

    def signed(self) -> Log:
        """The changelog as removals (sign -1) and additions (sign +1), old before new."""
        log = self.table.updates()
        line = Timeline.of(log.df, self.table.keys, log.order, log.derived)
        live = lambda key, value: F.when(value.isNotNull(), self._mapped(key, value))
        line = line.with_columns(__new=live(F.col(KEY), F.col(VALUE)))
        # state on a stream takes and gives every column it is handed
        line = line.keeping(*self.table.keys, *log.order, "ts", "__new")
        line = line.previous("__old", "__new")
        change = lambda c, sign: F.when(F.col(c).isNotNull(), F.struct(
            F.col(c)[KEY].alias(KEY), F.col(c)[VALUE].alias(VALUE), F.lit(sign).alias("sign")))
        both = F.filter(F.array(change("__old", -1), change("__new", 1)), lambda x: x.isNotNull())
        pos = f"pos{len(log.order)}"
        flat = line.frame.select(*log.order, F.posexplode(both).alias(pos, "__c"))
        out = flat.select("__c.key", "__c.value", "__c.sign", *log.order, pos)
        return Log(out.where(F.col(KEY).isNotNull()), log.order + (pos,), derived=True)

    def _mapped(self, key: Column, value: Column) -> Column:
        k, v = self.mapper(key, value)
        return F.struct(k.alias(KEY), v.alias(VALUE))

    def count(self) -> Table:
        return self._table(counted(), None)

    def reduce(self, reducer: Reducer) -> Table:
        return self._table(reducer, None)

    def aggregate(self, init, reducer: Reducer) -> Table:
        return self._table(reducer, init)

    def _table(self, reducer: Reducer, init) -> Table:
        _check_init(reducer, init)
        if not reducer.invertible:
            return self._without_removals(reducer)

        def updates() -> Log:
            signed = self.signed()
            line = Timeline.of(signed.df, (KEY,), signed.order, signed.derived)
            line = line.running("__run", "sum", F.col("sign") * reducer.input())
            out = line.frame.withColumn(VALUE, _seeded(F.col("__run"), init))
            return Log(out.drop("__run", "sign"), signed.order, derived=True)

        def snapshot() -> DataFrame:
            # a group that has lost all its rows stays in the table with its empty value
            log = self.table.updates()
            seen = (log.df.where(F.col(VALUE).isNotNull())
                    .select(self._mapped(F.col(KEY), F.col(VALUE)).alias("m"))
                    .select("m.key", F.lit(None).alias("x")))
            live = (self.table.snapshot().select(self._mapped(F.col(KEY), F.col(VALUE)).alias("m"))
                    .select("m.*").select(KEY, reducer.input().alias("x")))
            total = F.coalesce(F.sum("x"), F.lit(0))
            return (seen.unionByName(live).where(F.col(KEY).isNotNull())
                    .groupBy(KEY).agg(total.alias(VALUE))
                    .withColumn(VALUE, _seeded(F.col(VALUE), init)))

        return Table(updates, snapshot, source=self.table.source)

    def _without_removals(self, reducer: Reducer) -> Table:
        if reducer.kind not in ("min", "max"):
            raise ValueError(f"{reducer.kind!r} has no meaning over an unordered group of rows")

        def updates() -> Log:
            log = self.table.updates()
            if not log.streaming:
                mapped = self._mapped(F.col(KEY), F.col(VALUE))
                return extreme_changes(log, self.table.keys, mapped, reducer)
            from tidelog.streaming.held import keyed_extremes
            signed = self.signed()
            return Log(keyed_extremes(signed.df, signed.order, reducer), signed.order, derived=True)

        def snapshot() -> DataFrame:
            rows = self.table.snapshot().select(self._mapped(F.col(KEY), F.col(VALUE)).alias("m"))
            return (rows.select("m.*").where(F.col(KEY).isNotNull())
                    .groupBy(KEY).agg(reducer.grouped(()).alias(VALUE)))

        return Table(updates, snapshot, source=self.table.source)
