"""State that waits for the watermark or keeps an order: windows that close, versions of a table,
ordered multisets and bounded buffers.

The watermark of a micro-batch is what earlier ones have seen, less the delay the log was given.
A window closes once stream time has reached its end plus grace, so a timer for it is set
``grace - delay`` after its end.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidelog.operators.extremes import Multiset
from tidelog.operators.log import KEY, VALUE
from tidelog.operators.windows import SuppressBufferFull
from tidelog.streaming.processors import (
    BUNDLE, ID, BundleState, StateCell, boxed, bundled, by_key, exact, given, in_order, key_named, plain)

DELAY = "spark.watermarkDelayMs"


def delay_of(df: DataFrame) -> int | None:
    """The delay of the frame's watermark in milliseconds; None without one."""
    return next((int(f.metadata[DELAY]) for f in df.schema if DELAY in f.metadata), None)


def needed_delay(df: DataFrame, what: str) -> int:
    delay = delay_of(df)
    if delay is None:
        raise ValueError(f"{what} needs a watermark: call with_watermark on the log")
    return delay


def _timed(df: DataFrame, keys: Sequence[str], processor: StatefulProcessor, schema: T.StructType,
           passes_on: bool = False) -> DataFrame:
    """``passes_on``: ``ts`` of the output carries the watermark on."""
    if delay_of(df) is None:
        mode = {"timeMode": "none"}
    else:
        mode = {"timeMode": "eventTime"} | ({"eventTimeColumnName": "ts"} if passes_on else {})
    return df.groupBy(*keys).transformWithState(processor, schema, "append", **mode)


def _row(schema: T.StructType):
    make = Row(*schema.names)
    return lambda d: make(*[d[n] for n in schema.names])


def timed_for(handle: StatefulProcessorHandle, due: int | None) -> None:
    """One timer for a group, at ``due``, in place of those it had."""
    known = False
    for timer in list(handle.listTimers()):
        if timer == due:
            known = True
        else:
            handle.deleteTimer(timer)
    if due is not None and not known:
        handle.registerTimer(due)


# -- folds over windows -----------------------------------------------------------------


class WindowFoldProcessor(StatefulProcessor):
    """One window of a key: folds its records, and ends with the timer that closes it.

    ``every`` gives the accumulator after each record, otherwise there is one row at the end.
    """

    def __init__(self, fold, order, schema, every: bool, keep_ms: int | None):
        self.zero, self.step, self.order, self.schema = fold.zero, fold.step, order, schema
        self.every, self.keep_ms = every, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, BundleState(handle)
        self.emit = _row(self.schema)

    def handleInputRows(self, key, rows, timerValues):
        # each window: key, start, end, accumulator
        held = self.state.load()
        passed = None if self.keep_ms is None else timerValues.getCurrentWatermarkInMs()
        for name, mine in by_key(rows).items():
            who = mine[0].asDict(recursive=True)
            window = (who[KEY], who["__start"], who["__end"])
            if passed is not None and self.closes(window) <= passed:
                continue
            acc = held[name][3] if name in held else self.zero
            for row in in_order(mine, self.order):
                row = row.asDict(recursive=True)
                acc = self.step(acc, row[KEY], row[VALUE])
                if self.every:
                    yield self.emit({**row, VALUE: acc})
            held[name] = (*window, acc)
        yield from self.let_out(held, passed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self.let_out(self.state.load(), timerValues.getCurrentWatermarkInMs())

    def closes(self, window: tuple) -> int:
        # an end is a whole number of milliseconds
        return window[2] // 1000 + self.keep_ms

    def let_out(self, held: dict, passed: int | None):
        """Ends the windows the watermark has passed; one timer waits for the next of the bundle."""
        if passed is not None:
            done = [name for name, window in held.items() if self.closes(window) <= passed]
            for name in done:
                window = held.pop(name)
                if not self.every:
                    yield self.emit({KEY: window[0], "__start": window[1], "__end": window[2], VALUE: window[3]})
            timed_for(self.handle, min(map(self.closes, held.values()), default=None))
        self.state.save(held)

    def close(self) -> None:
        pass


def keyed_window_fold(rows: DataFrame, fold, order: Sequence[str], grace_ms: int, every: bool) -> DataFrame:
    """A fold over (key, window): a row for each record, or one when the window closes.

    The windows of a key lie in bundles of their own, so a hot key is spread over its windows.
    """
    delay = delay_of(rows) if every else needed_delay(rows, "a fold's final rows over windows of a stream")
    sides = {f"__{side}": F.unix_micros(f"window.{side}") for side in ("start", "end")}
    flat = rows.withColumns(sides).drop("window")
    fields = [T.StructField(c, flat.schema[c].dataType) for c in
              dict.fromkeys((KEY, *sides, *(order if every else ())))]
    schema = T.StructType([*fields, T.StructField(VALUE, T.DataType.fromDDL(fold.schema))])
    keep = None if delay is None else grace_ms - delay
    out = _timed(bundled(flat, (KEY, *sides)), (BUNDLE,), WindowFoldProcessor(fold, tuple(order), schema, every, keep), schema, every)
    window = F.struct(*[F.timestamp_micros(c).alias(c[2:]) for c in sides]).alias("window")
    return out.select(KEY, window, *(order if every else ()), VALUE)


# -- a table as it was at a record's time -------------------------------------------------


class AsOfProcessor(StatefulProcessor):
    """Versions of one key's table value by time, and records that wait for them to be complete.

    A record is let out once the watermark has passed its time: no update that it should have
    seen can still come.  Of the versions the watermark has passed, only the last is kept.
    """

    def __init__(self, tail: Sequence[str], schema: T.StructType):
        self.tail, self.schema = tuple(tail), schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, BundleState(handle)
        self.emit = _row(self.schema)

    def handleInputRows(self, key, rows, timerValues):
        # each key: itself, versions and waiting records with their positions, which records may share
        held = self.state.load()
        for row in rows:
            at = (row["__t"], *[row[c] for c in self.tail])
            _, versions, waiting = held.setdefault(row[ID], (plain(row[KEY]), [], []))
            if row["__side"] == 0:
                versions.append((at, plain(row["__table"])))
            else:
                waiting.append((at, plain(row["__row"])))
        yield from self.let_out(held, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self.let_out(self.state.load(), timerValues.getCurrentWatermarkInMs())

    def let_out(self, held: dict, watermark_ms: int):
        passed, left, kept = watermark_ms * 1000, None, {}
        ordered = lambda entries: sorted(
            entries, key=lambda entry: tuple((x is not None, x) for x in entry[0]))
        for name, (who, versions, waiting) in held.items():
            versions, waiting, at, done = ordered(versions), ordered(waiting), 0, 0
            for place, row in waiting:
                if place[0] > passed:
                    left = place[0] if left is None else min(left, place[0])
                    break
                # at equal times the table's update comes first
                while at < len(versions) and versions[at][0][0] <= place[0]:
                    at += 1
                yield self.emit({KEY: who, "ts": row["ts"], "__row": row, "__now": versions[at - 1][1] if at else None})
                done += 1
            older = sum(place[0] <= passed for place, _ in versions)
            kept[name] = (who, versions[max(older - 1, 0):], waiting[done:])
        timed_for(self.handle, None if left is None else -(-left // 1000))
        self.state.save(kept)

    def close(self) -> None:
        pass


def keyed_as_of(both: DataFrame, order: Sequence[str]) -> DataFrame:
    """Tagged updates (side 0, ``__table``) and records (side 1, ``__row``): each record with the
    update of its own time, ``__now``."""
    tail = [c for c in order if c not in ("ts", "__side")]
    rows = both.withColumn("__t", F.unix_micros("ts"))
    kind = lambda name, c: T.StructField(name, rows.schema[c].dataType)
    schema = T.StructType([kind(KEY, KEY), kind("ts", "ts"), kind("__row", "__row"), kind("__now", "__table")])
    return _timed(bundled(rows, (KEY,)), (BUNDLE,), AsOfProcessor(tail, schema), schema, True)


# -- smallest and largest of a group whose rows may leave -----------------------------------


class ExtremeProcessor(StatefulProcessor):
    """The values of one group with how often each is there, kept in order while a batch is taken.

    Groups are few and large, so their records come and go as frames, not one by one.
    """

    def __init__(self, kind: str, order, schema: T.StructType):
        self.kind, self.order, self.schema = kind, order, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = BundleState(handle)

    def handleInputRows(self, key, rows, timerValues):
        frame = pd.concat(list(rows), ignore_index=True)
        places = range(len(self.order))
        # a missing position comes first
        frame = frame.sort_values([name for i in places for name in (f"known{i}", f"at{i}")], ignore_index=True)
        held, least = Multiset(self.state.load().items()), self.kind == "min"
        extremes = []
        for x, there, sign in zip(*(frame[c].tolist() for c in ("x", "known", "sign"))):
            held.add(x if there else None, sign)
            extremes.append(held.least if least else held.most)
        self.state.save(held.counts)
        out = [given(frame[f"at{i}"], ~frame[f"known{i}"].to_numpy(bool), self.schema[c].dataType)
               for i, c in enumerate(self.order)]
        out.append(given(pd.Series(extremes, dtype=object), np.array([x is None for x in extremes]),
                         self.schema[VALUE].dataType))
        yield pd.DataFrame(dict(zip(self.schema.names, [key[0], *out])))

    def close(self) -> None:
        pass


def keyed_extremes(signed: DataFrame, order: Sequence[str], reducer) -> DataFrame:
    rows = bundled(signed.withColumn("__x", reducer.input()), (KEY,))
    # no name begins with an underscore: the frames a processor gets would lose it
    forms = {("x", "known"): "__x", **{(f"at{i}", f"known{i}"): c for i, c in enumerate(order)}}
    sent = [c.alias(name) for names, of in forms.items() for name, c in zip(names, exact(rows, of))]
    # the time itself goes along only where a watermark has to be kept
    timed = delay_of(rows) is not None
    schema = T.StructType([T.StructField(ID, T.StringType()), *[T.StructField(c, rows.schema[c].dataType) for c in order],
                           T.StructField(VALUE, rows.schema["__x"].dataType)])
    mode = {"timeMode": "eventTime", "eventTimeColumnName": "ts"} if timed else {"timeMode": "none"}
    out = rows.select(ID, "sign", *sent, *(["ts"] if timed else [])).groupBy(ID).transformWithStateInPandas(
        ExtremeProcessor(reducer.kind, tuple(order), schema), schema, "append", **mode)
    return out.select(key_named(rows.schema[KEY].dataType), *order, VALUE)


# -- bounded suppression ----------------------------------------------------------------------


# Parts the windows of one closing time are held in: a part is read and written as one value.
PARTS = 16
# What a buffer knows of an update besides its key, window and value.
NOTES = ("name", "size", "part", "closes")


def packed(rows: pa.Table | pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write(rows)
    return sink.getvalue().to_pybytes()


def unpacked(pack: bytes) -> pa.Table:
    return pa.ipc.open_stream(pack).read_all()


def packing(place: str):
    """Batches of rows as one row for each ``place`` in them: a processor is handed rows one by one,
    with a cost for each value, and these as they are.  ``turn`` is their order within a task."""
    def pack(batches):
        for turn, batch in enumerate(batches):
            places = batch.column(place).dictionary_encode(null_encoding="encode")
            for i in range(len(places.dictionary)):
                rows = batch.filter(pc.equal(places.indices, i)).drop_columns([place])
                yield pa.RecordBatch.from_arrays([places.dictionary.slice(i, 1), pa.array([turn], pa.int64()),
                                                  pa.array([packed(rows)], pa.binary())], [place, "turn", "pack"])
    return pack


def unpacking(batches):
    for batch in batches:
        for pack in batch.column("pack"):
            yield from unpacked(pack.as_buffer()).to_batches()


class BufferProcessor(StatefulProcessor):
    """The buffer of one log partition: the last update of every open window, with an account of
    the records and bytes it holds; more than the limits fails the query.

    Windows are held by the time they close, so that a timer reads those that close with it only.
    Updates come, are held and leave in packs, as Arrow tables.
    """

    def __init__(self, order, kept, limits):
        self.order, self.kept, self.limits, self.parts = tuple(order), tuple(kept), limits, PARTS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        place = T.StructType([T.StructField("closes", T.LongType()), T.StructField("part", T.IntegerType())])
        self.held = handle.getMapState("held", place, T.StructType([T.StructField("windows", T.BinaryType())]))
        self.account = StateCell(handle.getValueState("account", boxed(T.StructType([
            T.StructField("records", T.LongType()), T.StructField("bytes", T.LongType())]))))
        self.emit = Row("pack")

    def read(self, place: tuple) -> pa.Table | None:
        """The windows of one part: name, size, key and window, value."""
        got = self.held.getValue(place)
        return None if got is None else unpacked(bytes(got[0]))

    def handleInputRows(self, key, rows, timerValues):
        self.account.load()
        now = self.account.get() or {"records": 0, "bytes": 0}
        # updates of one position and window come from one task, and stay as they came
        table = pa.concat_tables([unpacked(bytes(row["pack"])) for row in sorted(rows, key=lambda r: r["turn"])])
        table = table.filter(pc.greater(table["closes"], timerValues.getCurrentWatermarkInMs()))
        # a missing position comes first
        table = table.take(pc.sort_indices(table, [(c, "ascending") for c in self.order], null_placement="at_start"))
        table = table.select((*self.kept, *NOTES)).combine_chunks()
        spots, places = pd.factorize(pd.MultiIndex.from_arrays(
            [table[c].to_numpy() for c in ("closes", "part")]))
        places = [tuple(map(int, place)) for place in places]
        held = [self.read(place) for place in places]
        known = {}
        for windows in held:
            if windows is not None:
                known.update(zip(windows["name"].to_pylist(), windows["size"].to_pylist()))
        codes, names = pd.factorize(table["name"].to_numpy())
        size = table["size"].to_numpy()
        before = pd.Series(size).groupby(codes).shift(fill_value=-1).to_numpy("int64", copy=True)
        # names are numbered as they come, so the first updates of windows are in their order
        before[np.flatnonzero(before < 0)] = [known.get(name, -1) for name in names]
        new, more = before < 0, size - np.maximum(before, 0)
        self.check(now, new, more)
        last = np.zeros(len(names), "int64")
        last[codes] = np.arange(len(codes))
        newest, spots = table.take(last), spots[last]
        for place, old, at in zip(places, held, rows_of(spots, len(places))):
            windows = newest.take(at).drop_columns(["part", "closes"])
            if old is not None:
                stay = pc.invert(pc.is_in(old["name"], value_set=windows["name"].combine_chunks()))
                windows = pa.concat_tables([old.filter(stay), windows])
            self.held.updateValue(place, (packed(windows),))
        for closes in {closes for closes, _ in places}:
            self.handle.registerTimer(closes)
        self.account.put({"records": now["records"] + int(new.sum()), "bytes": now["bytes"] + int(more.sum())})
        self.account.save()
        return iter(())

    def check(self, now: dict, new: np.ndarray, more: np.ndarray) -> None:
        """Fails at the first update that takes the buffer beyond a limit."""
        over = []
        for rank, (what, moves) in enumerate((("records", new), ("bytes", more))):
            if self.limits[what] is not None:
                needed = now[what] + np.cumsum(moves, dtype="int64")
                over += [(int(i), rank, what, int(needed[i])) for i in np.flatnonzero(needed > self.limits[what])[:1]]
        if over:
            _, _, what, needed = min(over)
            raise SuppressBufferFull(f"buffer needs {needed} {what}, limit is {self.limits[what]}")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.account.load()
        now = self.account.get()
        for part in range(self.parts):
            place = (expiredTimerInfo.getExpiryTimeInMs(), part)
            windows = self.read(place)
            if windows is None:
                continue
            self.held.removeKey(place)
            now = {"records": now["records"] - windows.num_rows, "bytes": now["bytes"] - pc.sum(windows["size"]).as_py()}
            yield self.emit(packed(windows.select(self.kept)))
        self.account.put(now)
        self.account.save()

    def close(self) -> None:
        pass


def rows_of(codes: np.ndarray, n: int) -> list[np.ndarray]:
    """The rows of each code."""
    return np.split(np.argsort(codes, kind="stable"), np.cumsum(np.bincount(codes, minlength=n))[:-1])


def bounded_final(updates, keys: Sequence[str], closing_delay_ms: int, max_records: int | None,
                  max_bytes: int | None) -> DataFrame:
    """The last update of each window once it closes, from one bounded buffer per log partition."""
    df = updates.df
    if "partition" not in df.columns:
        raise ValueError("a bounded buffer is kept per log partition: the log needs its partition column")
    delay = needed_delay(df, "suppression until windows close")
    sides = {f"__{side}": F.unix_micros(f"window.{side}") for side in ("start", "end")}
    size = F.octet_length(F.to_json(F.struct(*keys, VALUE))).cast("long")
    rows = df.withColumns({**sides, "__bytes": size}).drop("window")
    names = tuple(c for c in (*keys, *sides) if c != "window")
    kept = tuple(dict.fromkeys((*names, VALUE)))
    rows = bundled(rows, names)
    # an end is a whole number of milliseconds
    notes = (F.col(ID), F.col("__bytes"), F.pmod(F.xxhash64(ID), F.lit(PARTS)).cast("int"),
             F.expr("__end div 1000") + F.lit(closing_delay_ms - delay))
    # positions have names of their own, since they may be among the keys
    order = {f"__at{i}": F.col(c) for i, c in enumerate(updates.order)}
    sent = rows.select(F.col("partition").alias("__place"), *kept, *[c.alias(n) for n, c in order.items()],
                       *[c.alias(n) for n, c in zip(NOTES, notes)])
    place = T.StructType([sent.schema["__place"], T.StructField("turn", T.LongType()), T.StructField("pack", T.BinaryType())])
    # no record is late here that was not where the updates were made
    out = sent.mapInArrow(packing("__place"), place).groupBy("__place").transformWithState(
        BufferProcessor(tuple(order), kept, {"records": max_records, "bytes": max_bytes}),
        T.StructType([T.StructField("pack", T.BinaryType())]), "append", "eventTime")
    out = out.mapInArrow(unpacking, T.StructType([T.StructField(c, rows.schema[c].dataType) for c in kept]))
    window = F.struct(*[F.timestamp_micros(c).alias(c[2:]) for c in sides]).alias("window")
    return out.select(*[c for c in keys if c != "window"], window, VALUE)


__all__ = ["bounded_final", "keyed_as_of", "keyed_extremes", "keyed_window_fold"]
