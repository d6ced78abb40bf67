"""The smallest or largest value of a group while rows enter and leave it.

A removal cannot be taken back from a minimum, so the changelog is a sweep over the lifetimes of
the values.  The events of a group (a value enters, a value leaves) are numbered and cut into slices
of equally many.  A slice is walked with an ordered multiset of what changes inside it; what lives
through all of it counts as one value only.  That value is found without looking at the slices one
by one: a lifetime covers at most two nodes on each level of a binary tree over the slices, nodes keep
their extreme, and a slice asks the nodes above it.  So no task holds more than a slice's events,
however many of the rows one group has.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import session
from tidelog.operators.log import KEY, VALUE, Log
from tidelog.operators.stateful import ordered_pass
from tidelog.operators.timeline import Timeline

# Events of a group that one task walks together.
SLICE_EVENTS = 65_536
# Levels of the tree over a group's slices.
LEVELS = 32


class Multiset:
    """Values with how often each is there, least and most at hand; nulls are left out."""

    def __init__(self, counts: Iterable[tuple] = ()):
        self.counts = dict(counts)
        self.values = sorted(self.counts)

    def add(self, x, times: int = 1) -> None:
        if x is None:
            return
        count = self.counts.get(x, 0) + times
        if count > 0 and x not in self.counts:
            insort(self.values, x)
        if count > 0:
            self.counts[x] = count
        elif x in self.counts:
            del self.counts[x]
            del self.values[bisect_left(self.values, x)]

    @property
    def least(self):
        return self.values[0] if self.values else None

    @property
    def most(self):
        return self.values[-1] if self.values else None


def _lifetimes(log: Log, keys: tuple[str, ...], mapped, reducer) -> DataFrame:
    """Each value of each row: group ``key``, ``__x``, from ``__at`` up to ``__to`` (null: to the end)."""
    at = F.struct(*log.order)
    line = Timeline.of(log.df.withColumn("__at", at), keys, log.order, log.derived)
    line = line.following("__to", F.col("__at"))
    lives = line.frame.where(F.col(VALUE).isNotNull()).select(mapped.alias("m"), "__at", "__to")
    lives = lives.select("m.*", "__at", "__to").where(F.col(KEY).isNotNull())
    return session.pinned(lives.select(
        KEY, reducer.input().alias("__x"), "__at", "__to", F.monotonically_increasing_id().alias("__v")))


def _numbered(lives: DataFrame, order: tuple[str, ...], pos: str) -> DataFrame:
    """The events of each group with their slice and number: entries (sign 1) and leavings (sign -1)."""
    event = lambda at, sign, p: F.when(F.col(at).isNotNull(), F.struct(
        *[F.col(f"{at}.{c}").alias(c) for c in order], F.lit(p).alias(pos), F.lit(sign).alias("sign")))
    both = F.filter(F.array(event("__to", -1, 0), event("__at", 1, 1)), lambda e: e.isNotNull())
    events = lives.select(KEY, "__x", "__v", F.explode(both).alias("e")).select(KEY, "__x", "__v", "e.*")
    line = Timeline.of(events, (KEY,), (*order, pos)).running("__n", "count", F.lit(1))
    return session.pinned(line.frame.withColumn("__s", F.floor((F.col("__n") - 1) / SLICE_EVENTS).cast("long")))


def _nodes(first: Column, end: Column) -> Column:
    """(level, node) of the tree that together cover the slices from ``first`` up to ``end``."""
    def at(level: Column) -> Column:
        width = F.pow(F.lit(2), level)
        low, high = F.ceil(first / width).cast("long"), F.floor(end / width).cast("long")
        node = lambda n: F.struct(level.alias("level"), n.alias("node"))
        inside = low < high
        return F.array(F.when(inside & (low % 2 == 1), node(low)), F.when(inside & (high % 2 == 1), node(high - 1)))

    every = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)), at))
    return F.filter(every, lambda n: n.isNotNull())


def _through(spans: DataFrame, slices: DataFrame, pick) -> DataFrame:
    """For each slice the extreme of the values that live through all of it."""
    end = F.coalesce(F.col("__last"), F.lit(2 ** (LEVELS - 1)))
    covers = spans.where(F.col("__first") + 1 < end).select(
        KEY, "__x", F.explode(_nodes(F.col("__first") + 1, end)).alias("n"))
    best = covers.groupBy(KEY, "n.level", "n.node").agg(pick("__x").alias("__x"))
    asked = slices.select(KEY, "__s", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("level"))
    asked = asked.withColumn("node", F.floor(F.col("__s") / F.pow(F.lit(2), F.col("level"))).cast("long"))
    return asked.join(best, [KEY, "level", "node"]).groupBy(KEY, "__s").agg(pick("__x").alias("__x"))


def extreme_changes(log: Log, keys: tuple[str, ...], mapped: Column, reducer) -> Log:
    """The extreme of a group after every event; null where nothing is left in it."""
    order, pos = log.order, f"pos{len(log.order)}"
    pick = F.min if reducer.kind == "min" else F.max
    events = _numbered(_lifetimes(log, keys, mapped, reducer), order, pos)
    spans = events.groupBy(KEY, "__v").agg(
        F.first("__x").alias("__x"), F.min(F.when(F.col("sign") == 1, F.col("__s"))).alias("__first"),
        F.min(F.when(F.col("sign") == -1, F.col("__s"))).alias("__last")).where(F.col("__x").isNotNull())
    # a value that leaves in a later slice than it came in is there when that slice begins
    carried = spans.where(F.col("__last") > F.col("__first")).select(KEY, F.col("__last").alias("__s"), "__x")
    begun = carried.unionByName(_through(spans, events.select(KEY, "__s").distinct(), pick))
    rows = events.drop("__v").unionByName(begun.withColumns(
        {"__n": F.lit(0).cast("long"), "sign": F.lit(1)}), allowMissingColumns=True)
    schema = T.StructType([events.schema[KEY], T.StructField(VALUE, events.schema["__x"].dataType),
                           *[events.schema[c] for c in (*order, pos)]])
    names, kind = (KEY, *order, pos), reducer.kind

    def step(held, row):
        held.add(row["__x"], row["sign"])
        if row["__n"]:
            yield {**{c: row[c] for c in names}, VALUE: held.least if kind == "min" else held.most}

    return Log(ordered_pass(rows, (KEY, "__s"), ("__n",), lambda row: Multiset(), step, schema),
               (*order, pos), derived=True)
