"""Time windows, session windows, late records and suppression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog import session
from tidelog.operators.log import KEY, VALUE, Log, need_type
from tidelog.operators.reducers import Fold, Reducer, counted
from tidelog.operators.timeline import Timeline

# The columns that tell how records arrived; without them no record counts as late.
ARRIVAL = {"partition", "offset"}
DAY_MS = 24 * 60 * 60 * 1000


def span(ms: int) -> Column:
    """A length of time as an interval."""
    return F.make_dt_interval(secs=F.lit(ms).cast("decimal(18,3)") / 1000)


def _positive(value, what: str) -> None:
    if not isinstance(value, int) or value <= 0:
        raise ValueError(f"{what} must be a positive number of milliseconds, got {value!r}")


def _not_negative(value, what: str) -> None:
    if not isinstance(value, int) or value < 0:
        raise ValueError(f"{what} must be a number of milliseconds, got {value!r}")


@dataclass(frozen=True)
class TimeWindows:
    """Windows [start, start + size), aligned to the epoch, one every ``advance_ms``."""

    size_ms: int
    advance_ms: int | None = None
    grace_ms: int | None = None

    def __post_init__(self):
        _positive(self.size_ms, "size_ms")
        if self.advance_ms is not None:
            _positive(self.advance_ms, "advance_ms")
            if self.advance_ms > self.size_ms:
                raise ValueError("advance_ms may not exceed size_ms")
        if self.grace_ms is None:
            object.__setattr__(self, "grace_ms", max(0, DAY_MS - self.size_ms))
        _not_negative(self.grace_ms, "grace_ms")

    def assign(self, df: DataFrame) -> DataFrame:
        step = f"{self.advance_ms or self.size_ms} milliseconds"
        return df.withColumn("window", F.window("ts", f"{self.size_ms} milliseconds", step))

    @property
    def closing_delay_ms(self) -> int:
        return self.grace_ms


@dataclass(frozen=True)
class SessionWindows:
    """Sessions end once nothing came for longer than ``gap_ms``."""

    gap_ms: int
    grace_ms: int | None = None

    def __post_init__(self):
        _positive(self.gap_ms, "gap_ms")
        if self.grace_ms is None:
            object.__setattr__(self, "grace_ms", max(0, DAY_MS - self.gap_ms))
        _not_negative(self.grace_ms, "grace_ms")

    @property
    def closing_delay_ms(self) -> int:
        return self.gap_ms + self.grace_ms


@dataclass(frozen=True)
class JoinWindows:
    """The other record may be up to ``before_ms`` earlier or ``after_ms`` later, inclusive."""

    before_ms: int
    after_ms: int
    grace_ms: int = 0

    def __post_init__(self):
        _not_negative(self.before_ms, "before_ms")
        _not_negative(self.after_ms, "after_ms")
        _not_negative(self.grace_ms, "grace_ms")

    @classmethod
    def of(cls, difference_ms: int, grace_ms: int = 0) -> JoinWindows:
        return cls(difference_ms, difference_ms, grace_ms)


@dataclass(frozen=True)
class SessionGrouped:
    """Records grouped by key and by session.  A session runs from its first to its last event."""

    group: object  # GroupedLog
    windows: SessionWindows

    def count(self):
        return self._table(counted(), None)

    def reduce(self, reducer: Reducer | Fold):
        return self._table(reducer, None)

    def aggregate(self, init, reducer: Reducer | Fold):
        """``init`` may be given for additive reducers; two sessions merge by the reducer itself."""
        return self._table(reducer, init)

    def _numbered(self) -> Timeline:
        """Each record with the number of its session under the key."""
        log = self.group.log
        line = Timeline.of(self.group.rows, self.group.keys, log.order, log.derived)
        line = line.previous("__last_ts", F.col("ts"))
        new = F.col("__last_ts").isNull() | (
            F.col("ts") - F.col("__last_ts") > span(self.windows.gap_ms))
        line = line.with_columns(__new=new.cast("int"))
        return line.running("__session", "sum", F.col("__new"))

    def _table(self, reducer, init):
        from tidelog.operators.grouped import _check_init, _seeded
        from tidelog.operators.table import Table
        log, keys = self.group.log, self.group.keys
        if isinstance(reducer, Fold):
            return self._folded(reducer.starting(init))
        _check_init(reducer, init)

        def snapshot() -> DataFrame:
            if log.streaming:
                return self._streamed(reducer, init)
            # numbering is skew-safe, and the aggregation is partial before its shuffle
            out = self._numbered().frame.groupBy(*keys, "__session").agg(
                F.struct(F.min("ts").alias("start"), F.max("ts").alias("end")).alias("window"),
                reducer.grouped(log.order).alias(VALUE))
            return out.select(*keys, "window", _seeded(F.col(VALUE), init).alias(VALUE))

        def updates() -> Log:
            pos = f"pos{len(log.order)}"
            if log.streaming:
                from tidelog.streaming.processors import keyed_sessions
                changes = keyed_sessions(self.group.rows, keys, log.order, reducer,
                                         self.windows.gap_ms, self.windows.grace_ms)
                made = changes.select(
                    *keys, F.struct(F.timestamp_micros("__start").alias("start"),
                                    F.timestamp_micros("__end").alias("end")).alias("window"),
                    F.when(~F.col("__gone"), _seeded(F.col(VALUE), init)).alias(VALUE),
                    *log.order, F.col("__pos").alias(pos))
                return Log(made, log.order + (pos,), derived=True)
            line = self._numbered().refined("__session")
            line = line.all_running(__run=(reducer.kind, reducer.input()),
                                    __start=("min", F.col("ts")))
            window = lambda end: F.struct(F.col("__start").alias("start"), end.alias("end"))
            result = _seeded(F.col("__run"), init)
            row = lambda w, v: F.struct(w.alias("window"), v.alias(VALUE))
            # a session that does not grow in time is replaced without being deleted
            grown = (F.col("__new") == 0) & (F.col("__start") < F.col("ts"))
            gone = F.when(grown, row(window(F.col("__last_ts")), F.when(F.lit(False), result)))
            both = F.filter(F.array(gone, row(window(F.col("ts")), result)),
                            lambda x: x.isNotNull())
            flat = line.frame.select(*keys, *log.order, F.posexplode(both).alias(pos, "__r"))
            return Log(flat.select(*keys, "__r.window", "__r.value", *log.order, pos),
                       log.order + (pos,), derived=True)

        return Table(updates, snapshot, keys + ("window",), self.windows, log)

    def _streamed(self, reducer: Reducer, init) -> DataFrame:
        from tidelog.operators.grouped import _seeded
        gap = f"{self.windows.gap_ms} milliseconds"
        out = self.group.rows.groupBy(*self.group.keys, F.session_window("ts", gap).alias("w")).agg(
            reducer.grouped(self.group.log.order).alias(VALUE))
        # the engine's session ends a gap after the last event; ours ends with it
        return out.select(*self.group.keys, F.struct(
            F.col("w.start").alias("start"),
            (F.col("w.end") - span(self.windows.gap_ms)).alias("end")).alias("window"),
            _seeded(F.col(VALUE), init).alias(VALUE))

    def _folded(self, fold: Fold):
        from tidelog.operators.grouped import GroupedLog
        from tidelog.operators.stateful import folded
        frame = self._numbered().frame
        numbered = Log(frame.drop("__new", "__last_ts"), self.group.log.order, derived=True)
        return folded(GroupedLog(numbered, self.group.keys + ("__session",), self.windows), fold)


# -- late records -------------------------------------------------------------


def with_stream_time(log: Log, partition: tuple[str, ...] = ("partition",)) -> Log:
    """Adds ``stream_time``: the highest event time seen so far in the record's partition.

    A log has few partitions and any number of records in each, so the running
    maximum has to be a split one.
    """
    # equal offsets come from one record, whose outputs the rest of the order tells apart
    arrival = tuple(dict.fromkeys(("offset", *log.order)))
    line = Timeline.of(log.df, partition, arrival, log.derived)
    timed = line.running("stream_time", "max", F.col("ts")).frame
    return Log(timed, log.order, derived=True)


def with_lateness(log: Log, windows: TimeWindows,
                  partition: tuple[str, ...] = ("partition",)) -> Log:
    """Puts records into their windows and adds ``late``: the window closed before they came."""
    need_type(windows, TimeWindows, "windows")
    timed = with_stream_time(log, partition)
    late = F.col("window.end") + span(windows.grace_ms) <= F.col("stream_time")
    return timed._with(windows.assign(timed.df).withColumn("late", late))


def split_late(log: Log, windows: TimeWindows,
               partition: tuple[str, ...] = ("partition",)) -> tuple[Log, Log]:
    """(kept, late)."""
    marked = with_lateness(log, windows, partition)
    part = lambda late: marked._with(
        marked.df.where(F.col("late") == late).drop("late"))
    return part(False), part(True)


# -- suppression ----------------------------------------------------------------


class SuppressBufferFull(RuntimeError):
    """More windows were open at one time than the buffer may hold."""


def suppress(table, until_time_limit_ms: int | None = None, max_records: int | None = None,
             max_bytes: int | None = None) -> Log:
    """Hold updates back.

    By default one final record per (key, window), once the window has closed.
    With ``until_time_limit_ms`` at most one record per key in that time.  The
    limits fail the job when the updates held at one time outgrow them; on a stream
    each log partition has a buffer of its own, whose limits they are.
    """
    if until_time_limit_ms is not None:
        _positive(until_time_limit_ms, "until_time_limit_ms")
        if table.source is not None and table.source.streaming:
            _no_limits_on_streams(max_records, max_bytes)
            from tidelog.streaming.processors import keyed_rate_limit
            return keyed_rate_limit(table.updates(), table.keys, until_time_limit_ms)
        from tidelog.operators.stateful import rate_limited
        return rate_limited(table.updates(), table.keys, until_time_limit_ms,
                            max_records, max_bytes)
    if table.windows is None:
        raise ValueError("only a windowed table can be held until its windows close")
    if table.source.streaming:
        if max_records is not None or max_bytes is not None:
            from tidelog.streaming.held import bounded_final
            final = bounded_final(table.updates(), table.keys, table.windows.closing_delay_ms, max_records, max_bytes)
            return Log(final.withColumn("ts", F.col("window.end")), ("ts",))
        # append mode emits a window when the watermark passes its end: the same rows
        return Log(table.snapshot().withColumn("ts", F.col("window.end")), ("ts",))
    if max_records is not None or max_bytes is not None:
        _check_buffer(table, max_records, max_bytes)
    closed = F.col("window.end") + span(table.windows.closing_delay_ms) <= F.col("__now")
    final = table.snapshot()
    if ARRIVAL <= set(table.source.df.columns):
        final = final.join(_final_times(table.source), KEY)
    else:
        final = final.withColumn("__now", table.source.df.agg(F.max("ts")).scalar())
    return Log(final.where(closed).drop("__now").withColumn("ts", F.col("window.end")), ("ts",))


def _final_times(log: Log) -> DataFrame:
    """Each key with the last stream time of the log partitions its records came from."""
    rows = log.df.where(F.col(KEY).isNotNull() & F.col(VALUE).isNotNull())
    met = rows.groupBy(KEY, "partition").agg(F.max("ts").alias("__last"))
    # one row per log partition
    ends = met.groupBy("partition").agg(F.max("__last").alias("__now"))
    return met.join(F.broadcast(ends), "partition").groupBy(KEY).agg(F.max("__now").alias("__now"))


def _open_windows(table) -> DataFrame:
    """How many windows (and bytes) were open after each window opened.

    A window opens with its first record and closes when stream time reaches its
    end plus grace; closings are counted before openings of the same time.
    """
    order = table.source.order
    size = F.octet_length(F.to_json(F.struct(*table.keys, VALUE)))
    per_window = session.pinned(table.updates().df.groupBy(*table.keys).agg(
        F.min(F.struct(*order)).alias("first"), F.max(size).alias("bytes")))
    side = lambda at, n, sign: per_window.select(
        F.lit(0).alias("all"), at.alias("at"), F.lit(n).alias("phase"),
        F.col("first").alias("tie"), F.lit(sign).alias("windows"),
        (F.col("bytes") * sign).alias("bytes"))
    end = F.col("window.end") + span(table.windows.closing_delay_ms)
    moves = side(end, 0, -1).unionByName(side(F.col("first.ts"), 1, 1))
    # one sequence over all keys: no key column could split it, slices do
    line = Timeline.of(moves, ("all",), ("at", "phase", "tie"))
    line = line.all_running(open_windows=("sum", F.col("windows")),
                            open_bytes=("sum", F.col("bytes")))
    return line.frame.where("phase = 1").select("at", "open_windows", "open_bytes")


def _no_limits_on_streams(max_records: int | None, max_bytes: int | None) -> None:
    if max_records is not None or max_bytes is not None:
        raise ValueError("a stream's state cannot be limited by records or bytes; guard it with BufferGuard")


def _check_buffer(table, max_records: int | None, max_bytes: int | None) -> None:
    peak = _open_windows(table).agg(F.max("open_windows"), F.max("open_bytes")).first()
    for got, limit, what in ((peak[0], max_records, "records"), (peak[1], max_bytes, "bytes")):
        if limit is not None and got is not None and got > limit:
            raise SuppressBufferFull(f"buffer needs {got} {what}, limit is {limit}")
