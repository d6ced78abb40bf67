"""Joining two streams: within a time window, and tables through a foreign key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.operators.log import KEY, VALUE, Log, Pairwise
from tidelog.operators.timeline import Timeline


def windowed_stream_join(left: Log, right: Log, joiner: Pairwise, windows, how: str) -> Log:
    """Both logs need a watermark; unmatched rows come out once it has passed their window.

    The time bounds in the condition let the engine drop state it cannot need.
    """
    def side(log: Log, p: str):
        rows = log.df.where(F.col(KEY).isNotNull() & F.col(VALUE).isNotNull())
        return rows.select(F.col(KEY).alias(f"{p}_key"), F.col(VALUE).alias(f"{p}_value"),
                           F.col("ts").alias(f"{p}_ts"), F.col("offset").alias(f"{p}_offset"))

    near = F.expr(
        f"l_key = r_key AND r_ts >= l_ts - INTERVAL {windows.before_ms} MILLISECONDS "
        f"AND r_ts <= l_ts + INTERVAL {windows.after_ms} MILLISECONDS")
    both = side(left, "l").join(side(right, "r"), near,
                                {"inner": "inner", "left": "leftOuter", "full": "fullOuter"}[how])
    return Log(both.select(
        F.coalesce("l_key", "r_key").alias(KEY),
        joiner(F.col("l_value"), F.col("r_value")).alias(VALUE),
        F.greatest("l_ts", "r_ts").alias("ts"),
        F.col("l_offset").alias("offset"), F.col("r_offset").alias("other_offset")),
        ("ts", "offset", "other_offset"))


def foreign_key_stream_join(left: Log, right: Log, foreign_key: Callable[[Column], Column],
                            joiner: Pairwise, order: tuple[str, ...]) -> Log:
    """The changelog of a foreign-key join of two tables.

    A left row enters the foreign key it names and leaves the one it named before;
    under each foreign key the right value meets the rows that are in.  A row that
    leaves one key and enters another at the same position shows the entry only.
    """
    from tidelog.streaming.processors import keyed_references, one_per_position
    place = lambda log, side: [
        F.lit(side).alias(c) if c == "__side" else
        F.col(c) if c in log.order else F.lit(0).alias(c) for c in order]
    line = Timeline.of(left.df, (KEY,), left.order).previous("__old", F.col(VALUE))
    named = lambda v: F.when(v.isNotNull(), foreign_key(v))
    rows = line.frame.withColumns({"__was": named(F.col("__old")), "__is": named(F.col(VALUE))})
    leaves = F.when(F.col("__was").isNotNull() & ~F.col("__was").eqNullSafe(F.col("__is")), F.struct(
        F.col("__was").alias("fk"), F.when(F.lit(False), F.col(VALUE)).alias("row")))
    enters = F.when(F.col("__is").isNotNull(), F.struct(
        F.col("__is").alias("fk"), F.col(VALUE).alias("row")))
    moves = rows.select(F.col(KEY).alias("__lk"), *place(left, 0), F.explode(
        F.filter(F.array(leaves, enters), lambda m: m.isNotNull())).alias("m"))
    moves = moves.select("__lk", *order, F.col("m.fk").alias("__fk"), F.col("m.row").alias("__l"))
    values = right.df.select(F.col(KEY).alias("__fk"), F.col(VALUE).alias("__r"), *place(right, 1))
    met = keyed_references(moves.unionByName(values, allowMissingColumns=True), order)
    value = F.when(F.col("__live"), joiner(F.col("__l"), F.col("__r")))
    changes = one_per_position(met.select(KEY, value.alias(VALUE), "__live", *order), order)
    names = tuple("side" if c == "__side" else c for c in order)
    return Log(changes.withColumnRenamed("__side", "side"), names, derived=True)
