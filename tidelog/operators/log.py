"""LOG: an ordered collection of keyed records, every record a fact."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import session

KEY, VALUE = "key", "value"
Pairwise = Callable[[Column, Column], Column]


def need_callable(fn, what: str) -> None:
    if not callable(fn):
        raise TypeError(f"{what} must be a function returning a Column, got {type(fn).__name__}")


def need_type(x, cls, what: str) -> None:
    if not isinstance(x, cls):
        raise TypeError(f"{what} must be a {cls.__name__}, got {type(x).__name__}")


def holds(pred: Column) -> Column:
    """A predicate result as a plain boolean: null counts as false."""
    return F.coalesce(pred.cast("boolean"), F.lit(False))


@dataclass(frozen=True)
class Log:
    """``df`` has the columns key, value and those of ``order``; others pass through.

    ``order`` is the total order of the records: event time, then offset, then
    whatever one-to-many operators added to tell their outputs apart.
    """

    df: DataFrame
    order: tuple[str, ...] = ("ts", "offset")
    derived: bool = False  # made by a window or a join: costly to compute again

    def __post_init__(self):
        need_type(self.df, DataFrame, "df")
        missing = [c for c in (KEY, VALUE, *self.order) if c not in self.df.columns]
        if missing:
            raise ValueError(f"log lacks columns {missing}")

    @classmethod
    def of(cls, df: DataFrame, key, value, ts: str = "ts", offset: str = "offset",
           **others) -> Log:
        """View any table as a log; ``others`` names further columns to keep."""
        as_col = lambda c: F.col(c) if isinstance(c, str) else c
        return cls(df.select(as_col(key).alias(KEY), as_col(value).alias(VALUE),
                             as_col(ts).alias("ts"), as_col(offset).alias("offset"),
                             *[as_col(c).alias(n) for n, c in others.items()]))

    @property
    def streaming(self) -> bool:
        return self.df.isStreaming

    @property
    def position(self) -> Column:
        return F.struct(*self.order)

    def with_watermark(self, delay_ms: int) -> Log:
        """On a stream: how far event times may lag before a record counts as late."""
        return replace(self, df=self.df.withWatermark("ts", f"{delay_ms} milliseconds"))

    def _with(self, df: DataFrame, order: tuple[str, ...] | None = None) -> Log:
        return replace(self, df=df, order=order or self.order)

    def _apply(self, fn: Pairwise, what: str):
        need_callable(fn, what)
        return fn(F.col(KEY), F.col(VALUE))

    # -- filters and projections ----------------------------------------

    def filter(self, pred: Pairwise) -> Log:
        return self._with(self.df.where(holds(self._apply(pred, "predicate"))))

    def filter_not(self, pred: Pairwise) -> Log:
        return self._with(self.df.where(~holds(self._apply(pred, "predicate"))))

    def map(self, fn: Callable[[Column, Column], tuple[Column, Column]]) -> Log:
        key, value = self._apply(fn, "mapper")
        return self._with(self.df.withColumns({KEY: key, VALUE: value}))

    def map_values(self, fn: Callable[[Column], Column]) -> Log:
        need_callable(fn, "value mapper")
        return self._with(self.df.withColumn(VALUE, fn(F.col(VALUE))))

    def select_key(self, fn: Pairwise) -> Log:
        return self._with(self.df.withColumn(KEY, self._apply(fn, "key mapper")))

    def flat_map(self, fn) -> Log:
        """``fn(key, value)`` gives a list of (key, value) pairs, or an array of structs."""
        made = self._apply(fn, "flat mapper")
        if not isinstance(made, Column):
            made = F.array(*[F.struct(k.alias(KEY), v.alias(VALUE)) for k, v in made])
        pos, out = self._exploded(made)
        return self._with(out.withColumns({KEY: F.col("__made.key"), VALUE: F.col("__made.value")})
                          .drop("__made"), self.order + (pos,))

    def flat_map_values(self, fn) -> Log:
        """``fn(value)`` gives a list of Columns, or an array Column; the key stays."""
        need_callable(fn, "flat value mapper")
        made = fn(F.col(VALUE))
        if not isinstance(made, Column):
            made = F.array(*made)
        pos, out = self._exploded(made)
        return self._with(out.drop(VALUE).withColumnRenamed("__made", VALUE), self.order + (pos,))

    def _exploded(self, made: Column) -> tuple[str, DataFrame]:
        pos = f"pos{len(self.order)}"
        return pos, self.df.select("*", F.posexplode(made).alias(pos, "__made"))

    def without_window(self) -> Log:
        """Records of a windowed table under their plain key."""
        return self._with(self.df.drop("window"))

    # -- routing ----------------------------------------------------------

    def branch_ids(self, preds: Sequence[Pairwise]) -> Log:
        """Adds ``branch``: the index of the first predicate a record meets, else null."""
        if not preds:
            raise ValueError("branch needs at least one predicate")
        chain = None
        for i, pred in enumerate(preds):
            met = holds(self._apply(pred, "predicate"))
            chain = F.when(met, F.lit(i)) if chain is None else chain.when(met, F.lit(i))
        return self._with(self.df.withColumn("branch", chain))

    def branch(self, preds: Sequence[Pairwise]) -> list[Log]:
        routed = self.branch_ids(preds)
        return [routed._with(routed.df.where(F.col("branch") == i).drop("branch"))
                for i in range(len(preds))]

    def merge(self, other: Log) -> Log:
        """All records of both; equal positions are told apart by the side they came from."""
        need_type(other, Log, "other")
        order = tuple(dict.fromkeys(self.order + other.order))
        side = f"side{len(order)}"

        def aligned(log: Log, n: int) -> DataFrame:
            gaps = {c: F.lit(0) for c in order if c not in log.order}
            return log.df.withColumns({**gaps, side: F.lit(n)})

        both = aligned(self, 0).unionByName(aligned(other, 1), allowMissingColumns=True)
        return Log(both, order + (side,), self.derived or other.derived)

    # -- effects ----------------------------------------------------------

    def peek(self, observation: Observation | str, *metrics: Column) -> Log:
        """Measure the passing records without touching them.

        Every pass counts: a global sort right behind it samples, and so passes twice.
        """
        metrics = metrics or (F.count(F.lit(1)).alias("records"),)
        return self._with(self.df.observe(observation, *metrics))

    def for_each(self, action: Callable, checkpoint: str | None = None):
        """Call ``action(row)`` for every record; on a stream the query is returned."""
        need_callable(action, "action")
        if self.streaming:
            checkpoint = checkpoint or session.shared_folder(self.df.sparkSession, "checkpoint")
            return (self.df.writeStream.foreach(action)
                    .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())

        def run(rows):
            for row in rows:
                action(row)

        self.df.foreachPartition(run)

    def print(self, rows: int = 20):
        if self.streaming:
            return self.df.writeStream.format("console").trigger(availableNow=True).start()
        self.df.orderBy(*self.order).show(rows, truncate=False)

    def to(self, topic) -> None:
        from tidelog.sources.sinks import write_log
        return write_log(self, topic)

    def through(self, topic) -> Log:
        from tidelog.sources.sinks import write_through
        return write_through(self, topic)

    # -- grouping, tables, joins ------------------------------------------

    def group_by_key(self):
        from tidelog.operators.grouped import GroupedLog
        return GroupedLog(self)

    def group_by(self, fn: Pairwise):
        return self.select_key(fn).group_by_key()

    def to_table(self):
        from tidelog.operators.table import Table
        return Table.from_log(self)

    def join(self, table, joiner: Pairwise) -> Log:
        from tidelog.operators.joins import stream_table_join
        return stream_table_join(self, table, joiner, "inner")

    def left_join(self, table, joiner: Pairwise) -> Log:
        from tidelog.operators.joins import stream_table_join
        return stream_table_join(self, table, joiner, "left")

    def join_global(self, table, lookup: Pairwise, joiner: Pairwise, as_of: bool = False) -> Log:
        from tidelog.operators.joins import global_join
        return global_join(self, table, lookup, joiner, "inner", as_of)

    def left_join_global(self, table, lookup: Pairwise, joiner: Pairwise,
                         as_of: bool = False) -> Log:
        from tidelog.operators.joins import global_join
        return global_join(self, table, lookup, joiner, "left", as_of)

    def join_windowed(self, other: Log, joiner: Pairwise, windows) -> Log:
        from tidelog.operators.joins import windowed_join
        return windowed_join(self, other, joiner, windows, "inner")

    def left_join_windowed(self, other: Log, joiner: Pairwise, windows,
                           eager: bool = False) -> Log:
        from tidelog.operators.joins import windowed_join
        return windowed_join(self, other, joiner, windows, "left", eager)

    def outer_join_windowed(self, other: Log, joiner: Pairwise, windows,
                            eager: bool = False) -> Log:
        from tidelog.operators.joins import windowed_join
        return windowed_join(self, other, joiner, windows, "full", eager)

    # -- stateful transforms -----------------------------------------------

    def transform(self, step, key_type: str, value_type: str, stores=()) -> Log:
        from tidelog.operators.stateful import transform
        return transform(self, step, stores, value_type, key_type)

    def flat_transform(self, step, key_type: str, value_type: str, stores=()) -> Log:
        from tidelog.operators.stateful import flat_transform
        return flat_transform(self, step, stores, value_type, key_type)

    def transform_values(self, step, value_type: str, stores=()) -> Log:
        from tidelog.operators.stateful import transform_values
        return transform_values(self, step, stores, value_type)

    def flat_transform_values(self, step, value_type: str, stores=()) -> Log:
        from tidelog.operators.stateful import flat_transform_values
        return flat_transform_values(self, step, stores, value_type)

    def process(self, step, stores=()) -> None:
        from tidelog.operators.stateful import process
        return process(self, step, stores)

    @property
    def key_type(self) -> T.DataType:
        return self.df.schema[KEY].dataType

    @property
    def value_type(self) -> T.DataType:
        return self.df.schema[VALUE].dataType
