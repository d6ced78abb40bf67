"""Running computations over the history of each key, safe for hot keys.

A changelog needs, for every record, something about the records before it
(running total, latest value of the other side, previous row).  The plain plan
is a window partitioned by key, which puts the whole history of a key into one
task.  ``Timeline`` keeps that plan for keys a task can hold.  The records of the
others, the hot keys, are cut into slices of their time:

1. one partially aggregated pass counts the rows of each key; hot are the keys
   with more rows than a task should hold;
2. a second one, over the rows of hot keys only, sketches the quantiles of their
   times; a hot key's time is cut there into as many parts as its rows need, so
   that slices hold about equally many rows however the rows lie in time (a burst,
   a clock that is years off).  Nothing is written or run while the plan is built;
3. windows run inside (key, slice); one partial result per (key, slice) is
   scanned along the slices of a key to give each slice what came before it.

The plan is the same for every size.  Without hot keys adaptive execution finds
their table empty and drops the second half of the plan.  Broadcast are only the
hot keys, at most rows / rows per task, and their cuts, at most rows / rows per
slice numbers.  Carried rows are joined as Spark sees fit.

A derived log (made by windows or joins) is written once before it is cut, at
any size, so that a chain of running operators grows with its length only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import session

SLICE = "__slice"
# Quantiles sketched of a hot key's times: the most slices it is cut into.
QUANTILES = 1_024

# merge(carried, local) for each kind of running aggregate
_MERGE: dict[str, Callable[[Column, Column], Column]] = {
    "sum": lambda a, b: F.coalesce(a + b, a, b),
    "count": lambda a, b: F.coalesce(a, F.lit(0)) + b,
    "min": lambda a, b: F.least(a, b),
    "max": lambda a, b: F.greatest(a, b),
}


def same_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}"))
                                       for i, k in enumerate(keys)])


def number_of(df: DataFrame, name: str) -> Column:
    """A time or a number as a double that never decreases as the column grows, in any time zone."""
    c, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        days = F.unix_date(c.cast("date")) * 86_400.0
        if isinstance(kind, T.DateType):
            return days
        return (days + F.hour(c) * 3_600 + F.minute(c) * 60
                + F.extract(F.lit("SECOND"), c).cast("double"))
    return c.cast("double")


def split(df: DataFrame, keys: Sequence[str], order: Sequence[str], derived: bool = False,
          most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot keys with their slice).

    Keys of more than ``most`` rows are hot, if that is less than the session's number.

    Slices are cut along the first column of ``order``, a time or a number.
    Records of one key at one same time are never parted.
    """
    if derived:
        df = session.pinned(df)
    per_task, per_slice = session.ROWS_PER_TASK, session.ROWS_PER_SLICE
    if most is not None:
        per_task, per_slice = min(per_task, most), min(per_slice, max(most // 4, 1))
    names = [f"__k{i}" for i in range(len(keys))]
    hot = (df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)])
           .agg(F.count(F.lit(1)).alias("__rows"))
           .where(F.col("__rows") > per_task))
    # one shape of the join for both halves, so that the hot keys are looked for once
    marked = df.join(F.broadcast(hot), same_key(keys), "left")
    cold = marked.where(F.col("__rows").isNull()).drop("__rows", *names)
    timed = (marked.where(F.col("__rows").isNotNull()).drop(*names)
             .withColumn("__place", number_of(df, order[0])))
    cuts = (timed.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)])
            .agg(F.expr(_QUANTILES_OF_PLACE).alias("__all"), F.max("__rows").alias("__n"))
            .select(*names, _cuts(F.col("__all"), F.col("__n"), per_slice).alias("__cuts")))
    cut = timed.join(F.broadcast(cuts), same_key(keys), "left")
    cut = cut.withColumn(SLICE, _slice_of(F.col("__place"), F.col("__cuts")))
    return cold, cut.drop("__rows", "__place", "__cuts", *names)


_QUANTILES_OF_PLACE = "percentile_approx(__place, array({}))".format(
    ", ".join(f"{i / QUANTILES}D" for i in range(1, QUANTILES)))


def _cuts(quantiles: Column, rows: Column, per_slice: int) -> Column:
    """The quantiles that cut so many rows into slices; fewer where they coincide."""
    slices = F.least(F.ceil(rows / per_slice), F.lit(QUANTILES)).cast("int")
    picked = F.transform(F.sequence(F.lit(1), F.greatest(slices - 1, F.lit(1))),
                         lambda i: F.get(quantiles, F.floor(i * QUANTILES / slices).cast("int") - 1))
    return F.when(slices > 1, F.array_distinct(picked))


def _slice_of(place: Column, cuts: Column) -> Column:
    """How many cuts lie before ``place``, by binary search; 0 for a missing time."""
    steps = [1 << i for i in reversed(range(QUANTILES.bit_length() - 1))]
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
        F.get(cuts, at + step - 1) < place, at + step).otherwise(at))


@dataclass(frozen=True)
class Step:
    """A running column: ``local(sliced)`` computes it within a key (or a slice of one), ``part``
    is what a slice passes on, ``scan`` gathers the parts of other slices, and
    ``merge(carried, local)`` puts both together."""

    name: str
    local: Callable[[bool], Column]
    part: Column
    scan: Callable[[str], Column]
    merge: Callable[[Column, Column], Column]


class Timeline:
    """An ordered log per key, with running columns added by its methods."""

    def __init__(self, whole: DataFrame, cut: DataFrame | None, keys: Sequence[str],
                 order: Sequence[str]):
        self.whole, self.cut, self.keys, self.order = whole, cut, tuple(keys), tuple(order)

    @classmethod
    def of(cls, df: DataFrame, keys: Sequence[str], order: Sequence[str],
           derived: bool = False, most: int | None = None) -> Timeline:
        if df.isStreaming:
            return cls(df, None, keys, order)
        return cls(*split(df, keys, order, derived, most), keys, order)

    def refined(self, *more: str) -> Timeline:
        """The same history cut finer by columns that never decrease along a key."""
        return Timeline(self.whole, self.cut, self.keys + more, self.order)

    def with_columns(self, **columns: Column) -> Timeline:
        return self._each(lambda df: df.withColumns(columns))

    def keeping(self, *names: str) -> Timeline:
        """Only these columns, as far as they are there."""
        return self._each(lambda df: df.select(*[c for c in df.columns if c in (*names, SLICE)]))

    @property
    def frame(self) -> DataFrame:
        return self.whole if self.cut is None else self.whole.unionByName(self.cut.drop(SLICE))

    def _each(self, change: Callable[[DataFrame], DataFrame]) -> Timeline:
        cut = None if self.cut is None else change(self.cut)
        return Timeline(change(self.whole), cut, self.keys, self.order)

    # -- running columns -------------------------------------------------

    def running(self, name: str, kind: str, expr: Column) -> Timeline:
        """``kind`` (sum, count, min, max, first, last) of everything up to and with the row.

        ``first`` and ``last`` skip nulls.
        """
        return self.all_running(**{name: (kind, expr)})

    def all_running(self, **columns: tuple[str, Column]) -> Timeline:
        """Several running columns that do not need one another, in one pass."""
        if self.whole.isStreaming:
            return self._streamed(**columns)
        return self._added(*[self._running(n, kind, expr) for n, (kind, expr) in columns.items()])

    def latest(self, name: str, expr: Column) -> Timeline:
        """Last non-null ``expr`` up to and with the row."""
        return self.running(name, "last", expr)

    def upcoming(self, name: str, expr: Column) -> Timeline:
        """First non-null ``expr`` from the row on (batch only)."""
        return self._added(self._reach(name, expr, back=False))

    def previous(self, name: str, expr: Column | str) -> Timeline:
        """``expr`` of the row before (null for the first row of a key).  On a stream state takes a
        column given by its name as it is, an expression next to the other columns."""
        if self.whole.isStreaming:
            return self._streamed(**{name: ("previous", expr)})
        return self._step(name, expr, back=True)

    def following(self, name: str, expr: Column) -> Timeline:
        """``expr`` of the row after, null for the last row of a key (batch only)."""
        return self._step(name, expr, back=False)

    # -- plumbing --------------------------------------------------------

    def _streamed(self, **columns: tuple[str, Column]) -> Timeline:
        """On a stream the past is state: what was seen of a key in earlier batches."""
        from tidelog.streaming.processors import keyed_columns
        return self._each(lambda df: keyed_columns(df, self.keys, self.order, columns))

    def _within(self, sliced: bool, forward: bool = True):
        cut = (SLICE,) if sliced else ()
        order = self.order if forward else [F.col(o).desc() for o in self.order]
        return Window.partitionBy(*self.keys, *cut).orderBy(*order)

    def _along(self):
        return Window.partitionBy(*self.keys).orderBy(SLICE)

    def _position(self) -> Column:
        return F.struct(*self.order)

    def _added(self, *steps: Step) -> Timeline:
        whole, cut = self.whole.withColumns({s.name: s.local(False) for s in steps}), self.cut
        if cut is not None:
            local = {f"__local{i}": s.local(True) for i, s in enumerate(steps)}
            inside = cut.withColumns(local)
            # summing sums would widen a decimal; both layouts have to give one type
            merged = {s.name: s.merge(F.col(f"__carry{i}"), F.col(f"__local{i}")).cast(
                inside.schema[f"__local{i}"].dataType) for i, s in enumerate(steps)}
            joined = inside.join(self._carried(steps), (F.col(SLICE) == F.col("__s"))
                                 & same_key(self.keys), "left")
            cut = joined.withColumns(merged).drop(
                "__s", *local, *[f"__carry{i}" for i in range(len(steps))],
                *[f"__k{i}" for i in range(len(self.keys))])
        return Timeline(whole, cut, self.keys, self.order)

    def _carried(self, steps: Sequence[Step]) -> DataFrame:
        """One row for each (key, slice) that something is carried into."""
        parts = self.cut.groupBy(*self.keys, SLICE).agg(
            *[s.part.alias(f"__part{i}") for i, s in enumerate(steps)])
        carried = parts.withColumns({f"__carry{i}": s.scan(f"__part{i}")
                                     for i, s in enumerate(steps)})
        return carried.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(self.keys)],
                              F.col(SLICE).alias("__s"), *[f"__carry{i}" for i in range(len(steps))])

    def _running(self, name: str, kind: str, expr: Column) -> Step:
        if kind == "last":
            return self._reach(name, expr, back=True)
        before = self._along().rowsBetween(Window.unboundedPreceding, -1)
        upto = lambda sliced: self._within(sliced).rowsBetween(Window.unboundedPreceding, 0)
        if kind == "first":
            return Step(name, lambda sliced: F.first(expr, True).over(upto(sliced)),
                        F.min_by(expr, F.when(expr.isNotNull(), self._position())),
                        lambda p: F.first(p, True).over(before), lambda c, x: F.coalesce(c, x))
        fn, total = getattr(F, kind), getattr(F, "sum" if kind == "count" else kind)
        return Step(name, lambda sliced: fn(expr).over(upto(sliced)), fn(expr),
                    lambda p: total(p).over(before), _MERGE[kind])

    def _reach(self, name: str, expr: Column, back: bool) -> Step:
        # looking ahead is a growing frame over the reversed order: linear, where a
        # frame that shrinks towards the end would be evaluated anew for each row
        pick = F.max_by if back else F.min_by
        return Step(
            name, lambda sliced: F.last(expr, True).over(
                self._within(sliced, back).rowsBetween(Window.unboundedPreceding, 0)),
            pick(expr, F.when(expr.isNotNull(), self._position())), self._neighbour(back),
            lambda c, x: F.coalesce(x, c))

    def _step(self, name: str, expr: Column | str, back: bool) -> Timeline:
        move = F.lag if back else F.lead
        # boxed, so that a null of the neighbour row differs from "no neighbour row"
        boxed = F.struct((F.col(expr) if isinstance(expr, str) else expr).alias("v"))
        pick = F.max_by if back else F.min_by
        added = self._added(Step(
            "__box", lambda sliced: move(boxed).over(self._within(sliced)),
            pick(boxed, self._position()), self._neighbour(back), lambda c, x: F.coalesce(x, c)))
        return added._each(lambda df: df.withColumn(name, F.col("__box.v")).drop("__box"))

    def _neighbour(self, back: bool) -> Callable[[str], Column]:
        if back:
            reach = self._along().rowsBetween(Window.unboundedPreceding, -1)
            return lambda p: F.last(p, True).over(reach)
        reach = self._along().rowsBetween(1, Window.unboundedFollowing)
        return lambda p: F.first(p, True).over(reach)
