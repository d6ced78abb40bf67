"""Keyed state on streams, through ``transformWithState``.

A micro-batch hands a key's records over unordered, so each processor sorts what
it got of one key; ``maxBytesPerTrigger`` (or ``maxFilesPerTrigger``) of the
source bounds that.  State lives in the RocksDB store and survives lost executors.

Each group a processor is called with costs several calls from Python to the state
store, some milliseconds.  Where keys are many they share groups (``bundled``): the
state of all keys of a bundle is read once and written once in a micro-batch.  Windows
are more still, so theirs come as frames of few large bundles.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidelog.operators.log import KEY, VALUE, Log
from tidelog.operators.stateful import Context


def plain(x):
    """Rows as dictionaries, all the way down."""
    return x.asDict(recursive=True) if isinstance(x, Row) else x


class StateCell:
    """A ``ValueState`` with the interface of a batch store.

    It is read once for a key's records of a micro-batch and written once after them.
    """

    def __init__(self, state):
        self._state, self._value = state, None

    def load(self) -> None:
        self._value = plain(self._state.get()[0]) if self._state.exists() else None
        self._changed = False

    def save(self) -> None:
        if self._changed and self._value is None:
            self._state.clear()
        elif self._changed:
            self._state.update((self._value,))

    def get(self):
        return self._value

    def put(self, value) -> None:
        self._value, self._changed = value, True

    def delete(self) -> None:
        self.put(None)


def boxed(t: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("v", t)])


def in_order(rows: Iterator[Row], order: Sequence[str]) -> list[Row]:
    rows = list(rows)
    return rows if len(rows) < 2 else sorted(rows, key=lambda r: tuple((r[c] is not None, r[c]) for c in order))


# Bundles a stream's keys are dealt to.  It may not change while a query has a checkpoint.
BUNDLES = 4096
# Bundles whose records come as frames: fewer, since a frame costs more and a row in it less.
FRAMES = 256
BUNDLE, ID = "__bundle", "__id"
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
          "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def bundled(df: DataFrame, keys: Sequence[str], bundles: int = BUNDLES) -> DataFrame:
    """``df`` with the name ``__id`` of a row's key and the number of its bundle."""
    def part(k: str) -> Column:
        # the two zeros are one key
        real = isinstance(df.schema[k].dataType, (T.DoubleType, T.FloatType))
        return (F.col(k) + F.lit(0.0) if real else F.col(k)).alias(k)

    named = df.withColumn(ID, F.to_json(F.struct(*map(part, keys)), _EXACT))
    return named.withColumn(BUNDLE, F.pmod(F.xxhash64(ID), F.lit(bundles)).cast("int"))


def key_named(kind: T.DataType) -> Column:
    """The one key that ``__id`` names."""
    return F.from_json(ID, T.StructType([T.StructField(KEY, kind)]), _EXACT)[KEY].alias(KEY)


def by_key(rows: Iterator[Row]) -> dict[str, list[Row]]:
    out = {}
    for row in rows:
        out.setdefault(row[ID], []).append(row)
    return out


class BundleState:
    """What is kept for each key of a bundle, by the key's name: one value of the store."""

    def __init__(self, handle: StatefulProcessorHandle):
        self._state = handle.getValueState("bundle", T.StructType([T.StructField("held", T.BinaryType())]))

    def load(self) -> dict:
        got = self._state.get()
        return {} if got is None else pickle.loads(bytes(got[0]))

    def save(self, held: dict) -> None:
        if held:
            self._state.update((pickle.dumps(held, pickle.HIGHEST_PROTOCOL),))
        else:
            self._state.clear()


# -- records as frames ----------------------------------------------------------


def exact(df: DataFrame, name: str) -> tuple[Column, Column]:
    """A column in a form that pandas does not alter (instants as microseconds, numbers without
    nulls), and whether there is a value."""
    c, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        c = F.coalesce(F.unix_micros(c), F.lit(0))
    elif isinstance(kind, T.NumericType) and not isinstance(kind, T.DecimalType):
        c = F.coalesce(c, F.lit(0).cast(kind))
    return c, F.col(name).isNotNull()


def given(values: pd.Series, missing: np.ndarray, kind: T.DataType) -> pd.Series:
    """Values of the form ``exact`` makes in their own type."""
    kind = to_arrow_type(kind)
    if values.dtype == object:
        out = pa.array(values.to_numpy(), type=kind, mask=missing)
    else:
        out = pa.array(values.to_numpy(), mask=missing).cast(kind)
    return pd.Series(pd.arrays.ArrowExtensionArray(out))


def fits_frames(kinds: Iterator[T.DataType]) -> bool:
    """Whether a frame brings back all values of these types as they were."""
    return all(isinstance(k, (T.NumericType, T.StringType, T.BooleanType, T.TimestampType)) for k in kinds)


def bare(df: DataFrame, names: Sequence[str], filled: Sequence[str] = ()) -> set[str]:
    """Of these columns those whose values tell by themselves where there is none, ``filled`` ones and objects."""
    return {n for n in names if n in filled or isinstance(df.schema[n].dataType, (T.StringType, T.DecimalType))}


def framed(df: DataFrame, names: Sequence[str], alone: set[str]) -> list[Column]:
    """The columns as a frame takes them, each value costs; no name begins with an underscore, or frames would lose it."""
    return [c.alias(f"{side}{i}") for i, n in enumerate(names) for side, c in zip(("at", "known"), exact(df, n))
            if side == "at" or n not in alone]


class Frame:
    """The records of a group, in order, a missing position first."""

    def __init__(self, rows: Iterator[pd.DataFrame], names: Sequence[str], alone: set[str], order: Sequence[str]):
        self.names, frame = names, pd.concat(list(rows), ignore_index=True)
        for i, n in enumerate(names):
            if n in alone:
                frame[f"known{i}"] = frame[f"at{i}"].notna()
        places = [names.index(c) for c in order]
        by = [f"{side}{i}" for i in places for side in ("known", "at")]
        self.frame = frame.sort_values(by, ignore_index=True, kind="stable")

    def known(self, name: str) -> pd.Series:
        return self.frame[f"known{self.names.index(name)}"].astype(bool)

    def values(self, name: str) -> pd.Series:
        return self.frame[f"at{self.names.index(name)}"]

    def typed(self, schema: T.StructType, names: Sequence[str]) -> dict[str, pd.Series]:
        return {n: given(self.values(n), ~self.known(n).to_numpy(), schema[n].dataType) for n in names}


def _emitter(schema: T.StructType):
    make = Row(*schema.names)
    names = schema.names
    return lambda d: make(*[d[n] for n in names])


class StepProcessor(StatefulProcessor):
    """Runs a user's step on each record of a key, with its named stores."""

    def __init__(self, outputs, stores, order, schema):
        self.outputs, self.order, self.schema = outputs, order, schema
        # types are parsed here: a worker has no session to parse them with
        self.types = {s.name: boxed(T.DataType.fromDDL(s.schema)) for s in stores}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cells = {name: StateCell(handle.getValueState(name, t))
                      for name, t in self.types.items()}
        self.context = Context(self.cells)
        self.emit = _emitter(self.schema)

    def handleInputRows(self, key, rows, timerValues):
        for cell in self.cells.values():
            cell.load()
        for row in in_order(rows, self.order):
            for made in self.outputs(self.context, row.asDict(recursive=True)):
                yield self.emit(made)
        for cell in self.cells.values():
            cell.save()

    def close(self) -> None:
        pass


def keyed_process(log: Log, outputs, stores, schema: T.StructType) -> DataFrame:
    return log.df.groupBy(KEY).transformWithState(
        StepProcessor(outputs, tuple(stores), log.order, schema), schema, "append", "none")


# Merging a new input into a running value, by kind.
_ADVANCE = {"sum": lambda a, x: a + x, "count": lambda a, x: a + 1, "min": min, "max": max,
            "first": lambda a, x: a, "last": lambda a, x: x, "prior": lambda a, x: x}
# kinds whose value is one of the inputs
_PICKED = ("previous", "prior", "first", "last")


class ColumnProcessor(StatefulProcessor):
    """Adds to each record values computed from the records of its key so far.

    A ``kind`` is that of a running aggregate (nulls are skipped), ``prior`` for the last
    value before the record, or ``previous`` for the value of the record before.
    """

    def __init__(self, kinds: Sequence[str], inputs: Sequence[str], names: Sequence[str], order, schema):
        self.kinds, self.inputs, self.order, self.schema = tuple(kinds), tuple(inputs), order, schema
        self.kept = [c for c in schema.names if c not in names]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = BundleState(handle)
        self.make = Row(*self.schema.names)

    def handleInputRows(self, key, rows, timerValues):
        held, kept = self.state.load(), None
        for name, mine in by_key(rows).items():
            # places, since a row looks for a name along all of its names
            if kept is None:
                names = mine[0].__fields__
                kept, inputs = ([names.index(c) for c in cs] for cs in (self.kept, self.inputs))
            now = held.setdefault(name, [None] * len(self.kinds))
            for row in in_order(mine, self.order):
                row, out = tuple(row), []
                for i, kind in enumerate(self.kinds):
                    x, was = plain(row[inputs[i]]), now[i]
                    now[i] = x if kind == "previous" else self.advanced(kind, was, x)
                    out.append(was if kind in ("previous", "prior") else now[i])
                yield self.make(*[row[i] for i in kept], *out)
        self.state.save(held)

    def advanced(self, kind, now, x):
        if now is None and kind == "count":
            now = 0
        if x is None:
            return now
        return x if now is None else _ADVANCE[kind](now, x)

    def close(self) -> None:
        pass


class WindowColumnProcessor(ColumnProcessor):
    """The same for windows of a stream with a watermark, on frames of a bundle's records.

    A window is let go when the watermark has passed its end, since no record in it comes any more.
    """

    def __init__(self, kinds, inputs, names, order, schema, taken: Sequence[str], alone: set[str]):
        super().__init__(kinds, inputs, names, order, schema)
        self.added, self.taken, self.alone = tuple(names), list(taken), alone

    def handleInputRows(self, key, rows, timerValues):
        frame = Frame(rows, self.taken, self.alone, self.order)
        names = frame.frame["name"].tolist()
        held = self.state.load() or {"passed": None, "ends": {}, "values": [{} for _ in self.kinds]}
        # by the watermark of an earlier time: the engine drops records by that of the batch before
        if held["passed"] is not None:
            for name in [name for name, end in held["ends"].items() if end <= held["passed"] * 1000]:
                del held["ends"][name]
                for now in held["values"]:
                    del now[name]
        held["ends"].update(zip(names, frame.values("__end").tolist()))
        out = frame.typed(self.schema, self.kept)
        for added, kind, source, now in zip(self.added, self.kinds, self.inputs, held["values"]):
            made = []
            for name, x, there in zip(names, frame.values(source).tolist(), frame.known(source).tolist()):
                x, was = x if there else None, now.get(name)
                now[name] = x if kind == "previous" else self.advanced(kind, was, x)
                made.append(was if kind in ("previous", "prior") else now[name])
            out[added] = given(pd.Series(made, dtype=object), np.array([x is None for x in made]),
                               self.schema[added].dataType)
        held["passed"] = timerValues.getCurrentWatermarkInMs()
        self.state.save(held)
        yield pd.DataFrame(out)


def _window_columns(rows: DataFrame, keys, order, kinds, inputs, added: T.StructType, columns: Sequence[str]) -> DataFrame:
    sides = {f"__{side}": F.unix_micros(f"window.{side}") for side in ("start", "end")}
    flat = rows.withColumns(sides).drop("window")
    kept = [c for c in flat.columns if c in (*columns, *sides)]
    taken = list(dict.fromkeys((*kept, *inputs)))
    # a record without a time is in no window
    alone = bare(flat, taken, (*sides, "ts"))
    schema = T.StructType([T.StructField(c, flat.schema[c].dataType) for c in kept] + added.fields)
    sent = bundled(flat, [c for c in (*keys, *sides) if c != "window"], FRAMES)
    # the time itself goes along to keep the watermark
    sent = sent.select(BUNDLE, F.col(ID).alias("name"), "ts", *framed(sent, taken, alone))
    out = sent.groupBy(BUNDLE).transformWithStateInPandas(
        WindowColumnProcessor(kinds, inputs, added.names, order, schema, taken, alone), schema, "append", "eventTime",
        eventTimeColumnName="ts")
    window = F.struct(*[F.timestamp_micros(c).alias(c[2:]) for c in sides]).alias("window")
    return out.select(*[window if c == "window" else c for c in columns], *added.names)


def keyed_columns(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  columns: dict[str, tuple[str, Column | str]]) -> DataFrame:
    """``df`` with columns (name: kind, expression or column of ``df``) as ``Timeline`` adds them, on a stream."""
    if "window" in keys:
        # built anew, so that ``ts`` alone carries the watermark
        df = df.withColumn("window", F.struct(F.col("window.start").alias("start"), F.col("window.end").alias("end")))
    made = {f"__x{i}": expr for i, (_, expr) in enumerate(columns.values()) if not isinstance(expr, str)}
    inputs = [expr if isinstance(expr, str) else f"__x{i}" for i, (_, expr) in enumerate(columns.values())]
    rows = df.withColumns(made)
    # the batch plan's type, so that both forms give the same schema
    types = []
    for x, (name, (kind, _)) in zip(inputs, columns.items()):
        fn = F.max_by(x, F.lit(1)) if kind in _PICKED else getattr(F, kind)(x)
        types.append(T.StructField(name, rows.agg(fn.alias(name)).schema[name].dataType))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema] + types)
    timed = any("spark.watermarkDelayMs" in f.metadata for f in df.schema)
    mode = {"timeMode": "eventTime", "eventTimeColumnName": "ts"} if timed else {"timeMode": "none"}
    kinds = [kind for kind, _ in columns.values()]
    flat = [*(f.dataType for f in rows.schema if f.name != "window"), *(f.dataType for f in types)]
    if timed and "window" in keys and fits_frames([*flat, *(f.dataType for f in rows.schema["window"].dataType)]):
        return _window_columns(rows, keys, tuple(order), kinds, inputs, T.StructType(types), df.columns)
    return bundled(rows, keys).groupBy(BUNDLE).transformWithState(
        ColumnProcessor(kinds, inputs, tuple(columns), tuple(order), schema), schema, "append", **mode)


class FoldProcessor(StatefulProcessor):
    """Folds the records of a key in order: a row for each, or one for each micro-batch."""

    def __init__(self, fold, order, schema, every: bool):
        self.zero, self.step, self.order, self.schema = fold.zero, fold.step, order, schema
        self.every = every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = BundleState(handle)
        self.emit = _emitter(self.schema)

    def handleInputRows(self, key, rows, timerValues):
        held = self.state.load()
        for name, mine in by_key(rows).items():
            # boxed, since a fold may well arrive at null
            acc = held[name][0] if name in held else self.zero
            for row in in_order(mine, self.order):
                row = row.asDict(recursive=True)
                acc = self.step(acc, row[KEY], row[VALUE])
                if self.every:
                    yield self.emit({**row, VALUE: acc})
            held[name] = (acc,)
            if not self.every:
                yield self.emit({**row, VALUE: acc})
        self.state.save(held)

    def close(self) -> None:
        pass


def keyed_fold(rows: DataFrame, fold, order, schema: T.StructType, every: bool) -> DataFrame:
    mode = "append" if every else "update"
    return bundled(rows, (KEY,)).groupBy(BUNDLE).transformWithState(
        FoldProcessor(fold, order, schema, every), schema, mode, "none")


class ReferenceProcessor(StatefulProcessor):
    """One foreign key: its right value now, and the left rows that name it."""

    def __init__(self, order, schema):
        self.order, self.schema = order, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = BundleState(handle)
        self.emit = _emitter(self.schema)

    def handleInputRows(self, key, rows, timerValues):
        held = self.state.load()
        for name, mine in by_key(rows).items():
            right, left = held.get(name, (None, {}))
            for row in in_order(mine, self.order):
                row = row.asDict(recursive=True)
                if row["__side"] == 1:
                    before, right = right, row["__r"]
                    if before is not None or right is not None:
                        for who, value in left.values():
                            yield self.met(row, who, value, right)
                else:
                    who, value = row["__lk"], row["__l"]
                    if value is None:
                        left.pop(row["__lid"], None)
                    else:
                        left[row["__lid"]] = (who, value)
                    if right is not None:
                        yield self.met(row, who, value, right)
            if right is not None or left:
                held[name] = (right, left)
            else:
                held.pop(name, None)
        self.state.save(held)

    def met(self, row: dict, who, left, right):
        return self.emit({**row, KEY: who, "__l": left, "__r": right,
                          "__live": left is not None and right is not None})

    def close(self) -> None:
        pass


def keyed_references(both: DataFrame, order: Sequence[str]) -> DataFrame:
    """Under each ``__fk``: left rows (``__lk``, ``__l``) that enter or leave, with the ``__r`` of the time."""
    fields = [T.StructField(name, both.schema[c].dataType) for name, c in (
        (KEY, "__lk"), ("__l", "__l"), ("__r", "__r"))]
    schema = T.StructType([*fields, T.StructField("__live", T.BooleanType()),
                           *[both.schema[c] for c in order]])
    # left keys by name, too: a key may be of a type that Python cannot look up
    both = bundled(both, ("__lk",)).withColumnRenamed(ID, "__lid").drop(BUNDLE)
    return bundled(both, ("__fk",)).groupBy(BUNDLE).transformWithState(
        ReferenceProcessor(tuple(order), schema), schema, "append", "none")


class PositionProcessor(StatefulProcessor):
    """Of a key's changes at one position, the live one.  All of them come in one micro-batch."""

    def __init__(self, order, schema):
        self.order, self.schema = order, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.emit = _emitter(self.schema)

    def handleInputRows(self, key, rows, timerValues):
        for mine in by_key(rows).values():
            changes = in_order(mine, (*self.order, "__live"))
            for _, same in groupby(changes, key=lambda r: tuple(r[c] for c in self.order)):
                yield self.emit(list(same)[-1].asDict())

    def close(self) -> None:
        pass


def one_per_position(changes: DataFrame, order: Sequence[str]) -> DataFrame:
    schema = T.StructType([f for f in changes.schema if f.name != "__live"])
    return bundled(changes, (KEY,)).groupBy(BUNDLE).transformWithState(
        PositionProcessor(tuple(order), schema), schema, "append", "none")


class SessionProcessor(StatefulProcessor):
    """The sessions of a key: a record joins those within the gap, in whatever order it came.

    Sessions it joins are deleted, unless all lie at its own time, and the joint one is given
    with its new value.  Sessions the watermark has passed, gap and grace included, are let go.
    """

    def __init__(self, kind: str, gap: int, keep_ms: int | None, order, schema):
        self.kind, self.gap, self.keep_ms, self.order, self.schema = kind, gap, keep_ms, order, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = BundleState(handle)
        self.emit = _emitter(self.schema)

    def handleInputRows(self, key, rows, timerValues):
        held = self.state.load()
        if self.keep_ms is not None:
            passed = (timerValues.getCurrentWatermarkInMs() - self.keep_ms) * 1000
            held = {name: {start: s for start, s in sessions.items() if s[0] >= passed}
                    for name, sessions in held.items()}
        for name, mine in by_key(rows).items():
            yield from self.extended(held.setdefault(name, {}), mine)
        self.state.save({name: sessions for name, sessions in held.items() if sessions})

    def extended(self, held: dict, rows):
        """Takes a key's records into its sessions (start: end, time of the value, value)."""
        for row in in_order(rows, self.order):
            row = row.asDict(recursive=True)
            now = row["__t"]
            met = sorted(start for start, s in held.items()
                         if start - self.gap <= now <= s[0] + self.gap)
            start, end = min([now, *met]), max([now, *(held[m][0] for m in met)])
            at, value = self.reduced([*((held[m][1], held[m][2]) for m in met), (now, self.entered(row["__x"]))])
            gone = [] if start == end else [(m, held[m][0]) for m in met]
            for m in met:
                del held[m]
            held[start] = (end, at, value)
            for pos, (lo, hi) in enumerate(gone):
                yield self.emit({**row, "__start": lo, "__end": hi, "__pos": pos, "__gone": True, VALUE: None})
            yield self.emit({**row, "__start": start, "__end": end, "__pos": len(gone), "__gone": False,
                             VALUE: value})

    def entered(self, x):
        return (0 if x is None else 1) if self.kind == "count" else x

    def reduced(self, parts: list[tuple]) -> tuple:
        """(time of the value, value) of sessions put together; nulls are skipped."""
        full = [p for p in parts if p[1] is not None]
        if not full:
            return parts[-1]
        if self.kind in ("first", "last"):
            # of equal times the record that came first, or last
            return min(full, key=lambda p: p[0]) if self.kind == "first" else max(
                reversed(full), key=lambda p: p[0])
        values = [v for _, v in full]
        return full[-1][0], {"min": min, "max": max}.get(self.kind, sum)(values)

    def close(self) -> None:
        pass


def keyed_sessions(rows: DataFrame, keys: Sequence[str], order: Sequence[str], reducer, gap_ms: int,
                   grace_ms: int) -> DataFrame:
    """Session changes on a stream: keys, ``__start`` and ``__end`` in microseconds, ``__gone``, value."""
    rows = rows.select(*keys, *[c for c in order if c not in keys], F.unix_micros("ts").alias("__t"),
                       reducer.input().alias("__x"))
    fn = F.max_by("__x", F.lit(1)) if reducer.kind in ("first", "last") else getattr(F, reducer.kind)("__x")
    value = T.StructField(VALUE, rows.agg(fn.alias(VALUE)).schema[VALUE].dataType)
    schema = T.StructType([
        *[T.StructField(c, rows.schema[c].dataType) for c in dict.fromkeys((*keys, *order))], value,
        *[T.StructField(c, T.LongType()) for c in ("__start", "__end")],
        T.StructField("__pos", T.IntegerType()), T.StructField("__gone", T.BooleanType())])
    timed = any("spark.watermarkDelayMs" in f.metadata for f in rows.schema)
    mode = {"timeMode": "eventTime", "eventTimeColumnName": "ts"} if timed else {"timeMode": "none"}
    keep = gap_ms + grace_ms if timed else None
    return bundled(rows, keys).groupBy(BUNDLE).transformWithState(
        SessionProcessor(reducer.kind, gap_ms * 1000, keep, tuple(order), schema), schema, "append", **mode)


class HoldProcessor(StatefulProcessor):
    """At most one record per key and time limit; a timer lets the held one out."""

    def __init__(self, limit_ms: int, order, schema):
        self.limit_ms, self.order, self.schema = limit_ms, order, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        row = T.StructType([T.StructField("due", T.LongType()), *self.schema.fields])
        self.held = handle.getValueState("held", row)
        self.names = self.schema.names
        self.make = Row(*self.names)

    def handleInputRows(self, key, rows, timerValues):
        held = self.held.get() if self.held.exists() else None
        for row in in_order(rows, self.order):
            now = int(row["ts"].timestamp() * 1000)
            due = held[0] if held is not None else now + self.limit_ms
            held = (due, *[row[n] for n in self.names])
            if held[0] <= now:
                yield self.make(*held[1:])
                held = None
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if held is None:
            self.held.clear()
        else:
            self.held.update(held)
            self.handle.registerTimer(held[0])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.held.exists():
            yield self.make(*self.held.get()[1:])
            self.held.clear()

    def close(self) -> None:
        pass


def keyed_rate_limit(log: Log, keys: Sequence[str], limit_ms: int) -> Log:
    """Suppression by time on a stream; the log needs a watermark.

    A key's own records let its value out exactly; other keys' records do so
    through the watermark, that is once per micro-batch.
    """
    rows = log.df.select(*dict.fromkeys((*keys, VALUE, *log.order)))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    out = rows.groupBy(*keys).transformWithState(
        HoldProcessor(limit_ms, log.order, schema), schema, "append", "eventTime")
    return Log(out, log.order)


__all__ = ["keyed_columns", "keyed_fold", "keyed_process", "keyed_rate_limit", "keyed_references",
           "keyed_sessions", "one_per_position"]
