"""Stateful transforms: user code that keeps state per key.

On batch input a transform is one shuffle by key and one sort, then a single
streamed pass: a task holds the state of the current key and one Arrow batch,
never a whole group.  A step without stores needs neither shuffle nor sort.
A hot key whose stores say how two states merge is cut into slices: one pass
finds the state each slice leaves behind, these are merged along the key, and a
second pass runs every slice from the state before it.  Without a merge the
states of one key form a chain that only one task can walk.
On streaming input the same user function runs under ``transformWithState``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidelog import session
from tidelog.operators.log import KEY, VALUE, Log, need_callable
from tidelog.operators.reducers import Fold
from tidelog.operators.timeline import SLICE, Timeline, same_key, split


@dataclass(frozen=True)
class Store:
    """A named per-key store; ``schema`` is the DDL type of what it holds.

    ``merge(before, after)`` joins the value one stretch of a key's records left
    with the value the next stretch left when started empty (either may be None).
    It has to give what running both stretches in turn would have left.
    """

    name: str
    schema: str
    merge: Callable[[object, object], object] | None = None


class MemoryCell:
    """The store of the current key during a batch pass."""

    def __init__(self, value=None):
        self.value = value

    def get(self):
        return self.value

    def put(self, value) -> None:
        self.value = value

    def delete(self) -> None:
        self.value = None


class Context:
    """What a step may look at besides key and value: its stores and the record's metadata."""

    def __init__(self, cells: dict):
        self._cells, self._row = cells, {}

    def at(self, row: dict) -> Context:
        self._row = row
        return self

    def store(self, name: str):
        return self._cells[name]

    @property
    def record(self) -> dict:
        return self._row

    def __getattr__(self, name: str):
        row = self.__dict__["_row"]
        if name in row:
            return row[name]
        raise AttributeError(f"record has no {name!r}")


# A step gets (context, key, value) and yields (key, value) pairs.
Step = Callable[[Context, object, object], Iterable[tuple]]


def transform(log: Log, step, stores: Sequence[Store], value_type: str, key_type: str) -> Log:
    """``step(ctx, key, value)`` returns one (key, value), or None for nothing."""
    need_callable(step, "step")

    def one(ctx, key, value):
        made = step(ctx, key, value)
        return () if made is None else (made,)

    return _run(log, one, stores, key_type, value_type)


def flat_transform(log: Log, step, stores: Sequence[Store], value_type: str, key_type: str) -> Log:
    """``step(ctx, key, value)`` returns any number of (key, value)."""
    need_callable(step, "step")
    return _run(log, step, stores, key_type, value_type)


def transform_values(log: Log, step, stores: Sequence[Store], value_type: str) -> Log:
    """``step(ctx, value)`` returns the new value; the key stays."""
    need_callable(step, "step")
    return _run(log, lambda ctx, key, value: ((key, step(ctx, value)),), stores,
                log.key_type.simpleString(), value_type)


def flat_transform_values(log: Log, step, stores: Sequence[Store], value_type: str) -> Log:
    """``step(ctx, value)`` returns any number of new values; the key stays."""
    need_callable(step, "step")
    return _run(log, lambda ctx, key, value: [(key, v) for v in step(ctx, value)], stores,
                log.key_type.simpleString(), value_type)


def process(log: Log, step, stores: Sequence[Store] = (), checkpoint: str | None = None):
    """``step(ctx, key, value)`` is run for its effects; nothing comes out."""
    need_callable(step, "step")

    def silent(ctx, key, value):
        step(ctx, key, value)
        return ()

    out = _run(log, silent, stores, "int", "int").df
    if log.streaming:
        place = checkpoint or session.shared_folder(out.sparkSession, "process")
        return (out.writeStream.format("noop").option("checkpointLocation", place)
                .outputMode("append").trigger(availableNow=True).start())
    out.write.format("noop").mode("overwrite").save()


def _run(log: Log, step: Step, stores: Sequence[Store], key_type: str, value_type: str) -> Log:
    pos = f"pos{len(log.order)}"
    schema = T.StructType([T.StructField(KEY, T.DataType.fromDDL(key_type)),
                           T.StructField(VALUE, T.DataType.fromDDL(value_type)),
                           *[log.df.schema[c] for c in log.order],
                           T.StructField(pos, T.IntegerType())])
    order = log.order

    def outputs(ctx, row: dict) -> Iterator[dict]:
        for i, (k, v) in enumerate(step(ctx.at(row), row[KEY], row[VALUE])):
            yield {KEY: k, VALUE: v, **{c: row[c] for c in order}, pos: i}

    if log.streaming:
        from tidelog.streaming.processors import keyed_process
        df = keyed_process(log, outputs, stores, schema)
    elif not stores:
        df = mapped(log.df, lambda row: outputs(Context({}), row), schema)
    elif any(s.merge is None for s in stores):
        df = _stored(log.df, (KEY,), order, outputs, stores, schema)
    else:
        whole, cut = split(log.df, (KEY,), order, log.derived)
        df = _stored(whole, (KEY,), order, outputs, stores, schema).unionByName(
            _sliced_run(cut, order, outputs, stores, schema))
    return Log(df, order + (pos,), derived=True)


def _stored(df: DataFrame, keys, order, outputs, stores: Sequence[Store], schema, finish=None):
    """Run a step over each group; a store starts from the column of its name, if there is one."""
    names = [s.name for s in stores]

    def start(row):
        return Context({n: MemoryCell(row.get(f"__store_{n}")) for n in names})

    return ordered_pass(df, keys, order, start, outputs, schema, finish)


def _sliced_run(cut: DataFrame, order, outputs, stores: Sequence[Store], schema) -> DataFrame:
    names = [s.name for s in stores]
    merges = {s.name: s.merge for s in stores}
    state_fields = [T.StructField(f"__store_{s.name}", T.DataType.fromDDL(s.schema))
                    for s in stores]
    left_schema = T.StructType([cut.schema[KEY], T.StructField(SLICE, T.IntegerType()),
                                *state_fields])

    def silent(ctx, row):
        for _ in outputs(ctx, row):
            pass
        return ()

    def leave(ctx):
        yield {KEY: ctx.record[KEY], SLICE: ctx.record[SLICE],
               **{f"__store_{n}": ctx.store(n).get() for n in names}}

    left = _stored(cut, (KEY, SLICE), order, silent, stores, left_schema, leave)

    def hand_on(state, row):
        if state:
            yield {KEY: row[KEY], SLICE: row[SLICE], **state}
        for n in names:
            c = f"__store_{n}"
            state[c] = merges[n](state[c], row[c]) if c in state else row[c]

    before = ordered_pass(left, (KEY,), (SLICE,), lambda row: {}, hand_on, left_schema)
    renamed = before.select(F.col(KEY).alias("__k0"), F.col(SLICE).alias("__s"),
                            *[f.name for f in state_fields])
    begun = cut.join(renamed, (F.col(SLICE) == F.col("__s")) & same_key((KEY,)), "left")
    return _stored(begun, (KEY, SLICE), order, outputs, stores, schema)


def mapped(df: DataFrame, step: Callable[[dict], Iterable[dict]], schema: T.StructType) -> DataFrame:
    """Rows in, rows out, partition by partition."""
    arrow = to_arrow_schema(schema)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [made for row in batch.to_pylist() for made in step(row)]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return df.mapInArrow(walk, schema)


def ordered_pass(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 start: Callable[[dict], object],
                 step: Callable[[object, dict], Iterable[dict]], schema: T.StructType,
                 finish: Callable[[object], Iterable[dict]] | None = None) -> DataFrame:
    """Walk the rows of each key in order: ``start`` a state, ``step`` per row, ``finish``."""
    if df.isStreaming:
        raise ValueError("an ordered walk needs all rows; on a stream use a transformer with a store")
    sorted_rows = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    arrow = to_arrow_schema(schema)
    keys = tuple(keys)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, current, out = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                key = [row[k] for k in keys]
                if state is None or key != current:
                    if state is not None and finish:
                        out.extend(finish(state))
                    state, current = start(row), key
                out.extend(step(state, row))
                if len(out) >= 10_000:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out = []
        if state is not None and finish:
            out.extend(finish(state))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return sorted_rows.mapInArrow(walk, schema)


# -- ordered folds --------------------------------------------------------------


class _Acc:
    """The accumulator of the current key; ``before`` is what earlier slices gave, boxed."""

    def __init__(self, row: dict, value=None, empty: bool = False, before: tuple | None = None):
        self.row, self.value, self.empty, self.before = row, value, empty, before


def folded(group, fold: Fold):
    """The table of a fold over each group of a ``GroupedLog``."""
    from tidelog.operators.table import Table
    log, keys, order = group.log, group.keys, group.log.order
    acc_type = T.DataType.fromDDL(fold.schema)
    key_fields = [log.df.schema[k] for k in keys]
    zero, advance, merge = fold.zero, fold.step, fold.merge
    windowed = tuple(keys) == (KEY, "window")
    if log.streaming and tuple(keys) != (KEY,) and not windowed:
        raise ValueError("on a stream fold by key or over time windows")

    def streamed(every: bool) -> DataFrame:
        if windowed:
            from tidelog.streaming.held import keyed_window_fold
            rows = group.rows.select(*dict.fromkeys((*keys, VALUE, *order)))
            return keyed_window_fold(rows, fold, order, group.windows.grace_ms, every)
        from tidelog.streaming.processors import keyed_fold
        schema = final_schema(*([log.df.schema[c] for c in order] if every else ()))
        rows = group.rows.select(*dict.fromkeys((KEY, VALUE, *order)))
        return keyed_fold(rows, fold, order, schema, every)

    def begin(row):
        return _Acc(row, zero)

    def take(acc, row):
        acc.value = advance(acc.value, row[KEY], row[VALUE])
        return ()

    def final_schema(*more) -> T.StructType:
        return T.StructType([*key_fields, *more, T.StructField(VALUE, acc_type)])

    def last(acc, *more):
        yield {**{k: acc.row[k] for k in (*keys, *more)}, VALUE: acc.value}

    def laid_out() -> tuple[DataFrame, DataFrame | None]:
        rows = group.rows.select(*dict.fromkeys((*keys, KEY, VALUE, *log.order)))
        # without a merge there is nothing that could put slices together again
        return (rows, None) if merge is None else split(rows, keys, log.order, log.derived)

    def snapshot() -> DataFrame:
        if log.streaming:
            return streamed(every=False)
        whole, cut = laid_out()
        out = ordered_pass(whole, keys, order, begin, take, final_schema(), last)
        return out if cut is None else out.unionByName(merged(partials(cut)))

    def partials(cut: DataFrame) -> DataFrame:
        schema = final_schema(T.StructField(SLICE, T.IntegerType()))
        return ordered_pass(cut, (*keys, SLICE), order, begin, take, schema,
                            lambda acc: last(acc, SLICE))

    def join_in(acc, row):
        acc.value = row[VALUE] if acc.empty else merge(row[KEY], acc.value, row[VALUE])
        acc.empty = False
        return ()

    def unstarted(row):
        return _Acc(row, empty=True)

    def merged(parts: DataFrame) -> DataFrame:
        return ordered_pass(parts, keys, (SLICE,), unstarted, join_in, final_schema(), last)

    def carried(parts: DataFrame) -> DataFrame:
        """What each slice of a key starts from: the merge of the slices before it."""
        schema = final_schema(T.StructField(SLICE, T.IntegerType()))

        def give_then_take(acc, row):
            if not acc.empty:
                yield {**{k: row[k] for k in (*keys, SLICE)}, VALUE: acc.value}
            join_in(acc, row)

        return ordered_pass(parts, keys, (SLICE,), unstarted, give_then_take, schema)

    def updates() -> Log:
        if log.streaming:
            return Log(streamed(every=True), order, derived=True)
        order_fields = [log.df.schema[c] for c in log.order]
        schema = final_schema(*order_fields)

        def out(acc, row):
            take(acc, row)
            value = acc.value if acc.before is None else merge(row[KEY], acc.before[0], acc.value)
            yield {**{k: row[k] for k in (*keys, *order)}, VALUE: value}

        whole, cut = laid_out()
        frame = ordered_pass(whole, keys, order, begin, out, schema)
        if cut is not None:
            before = carried(partials(cut)).select(
                *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                F.col(SLICE).alias("__s"), F.col(VALUE).alias("__before"),
                F.lit(True).alias("__has"))
            start = cut.join(before, (F.col(SLICE) == F.col("__s")) & same_key(keys), "left")
            frame = frame.unionByName(
                ordered_pass(start, (*keys, SLICE), order, resume, out, schema))
        return Log(frame, order, derived=True)

    def resume(row):
        return _Acc(row, zero, before=(row["__before"],) if row["__has"] else None)

    return Table(updates, snapshot, keys, group.windows, group.arrived or log)


# -- suppression by time ----------------------------------------------------------


def rate_limited(log: Log, keys: Sequence[str], limit_ms: int, max_records: int | None = None,
                 max_bytes: int | None = None) -> Log:
    """At most one record per key and ``limit_ms``.

    The first held update starts the clock.  The first record of any key whose
    time is ``limit_ms`` later or more lets the key's latest value out; when that
    record belongs to the key itself, it is the value let out.
    """
    from tidelog.operators.windows import SuppressBufferFull, span
    order = log.order
    # number the records along stream time, then find the number that ends each hold
    rows = log.df.select(*dict.fromkeys((*keys, VALUE, *order))).withColumn("__all", F.lit(0))
    line = Timeline.of(rows, ("__all",), order, log.derived).running("__n", "count", F.lit(1))
    numbered = session.pinned(line.frame)
    probes = numbered.select("*", (F.col("ts") + span(limit_ms)).alias("__at"),
                             F.lit(0).alias("__tick"))
    ticks = numbered.select("__all", F.col("ts").alias("__at"), F.lit(1).alias("__tick"),
                            F.col("__n"))
    both = probes.unionByName(ticks, allowMissingColumns=True)
    line = Timeline.of(both, ("__all",), ("__at", "__tick", "__n"))
    line = line.running("__passed", "sum", F.col("__tick"))
    held = session.pinned(
        line.frame.where("__tick = 0").withColumn("__ends", F.col("__passed") + 1)
        .drop("__at", "__tick", "__passed", "__all"))

    # walk each key once over numbers only; the value travels in the JVM row
    keys = tuple(keys)
    long = lambda name: T.StructField(name, T.LongType())
    schema = T.StructType([*[held.schema[k] for k in keys], long("__first"), long("__n"),
                           long("__out"), long("__bytes")])

    def hold(row):
        return {**{k: row[k] for k in keys}, "__first": row["__n"], "__n": row["__n"],
                "__out": row["__ends"], "__bytes": row["__bytes"]}

    def step(state, row):
        if state["held"] and row["__n"] > state["held"]["__out"]:
            yield state["held"]
            state["held"] = None
        if state["held"] is None:
            state["held"] = hold(row)
        else:
            state["held"]["__n"] = row["__n"]
            state["held"]["__bytes"] = max(state["held"]["__bytes"], row["__bytes"])
        if row["__n"] == state["held"]["__out"]:
            yield state["held"]
            state["held"] = None

    def finish(state):
        if state["held"]:
            yield state["held"]

    size = F.octet_length(F.to_json(F.struct(*keys, VALUE))).cast("long").alias("__bytes")
    chosen = ordered_pass(held.select(*keys, "__n", "__ends", size), keys, ("__n",),
                          lambda row: {"held": None}, step, schema, finish)
    if max_records is not None or max_bytes is not None:
        move = lambda at, sign: chosen.select(
            F.lit(0).alias("all"), F.col(at).alias("at"), F.lit(sign).alias("records"),
            (F.col("__bytes") * sign).alias("bytes"))
        line = Timeline.of(move("__out", -1).unionByName(move("__first", 1)), ("all",),
                           ("at", "records"))
        line = line.running("r", "sum", F.col("records")).running("b", "sum", F.col("bytes"))
        peak = line.frame.agg(F.max("r"), F.max("b")).first()
        for got, limit, what in ((peak[0], max_records, "records"), (peak[1], max_bytes, "bytes")):
            if limit is not None and got is not None and got > limit:
                raise SuppressBufferFull(f"buffer needs {got} {what}, limit is {limit}")
    total = numbered.agg(F.max("__n")).scalar()
    flushed = chosen.where(F.col("__out") <= total)
    out = held.drop("__ends").join(flushed.select("__n", "__out"), "__n").drop("__n", "__out")
    return Log(out, order, derived=True)
