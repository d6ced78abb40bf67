"""Joins: record with table, table with table, through a foreign key, and within a time window.

All are equi-joins on the key; ``joiner(left, right)`` builds the value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tidelog.operators.log import KEY, VALUE, Log, Pairwise, need_callable, need_type
from tidelog.operators.table import GlobalTable, Table, without_idle_tombstones
from tidelog.operators.timeline import Timeline
from tidelog.operators.windows import JoinWindows, span

HOW = ("inner", "left", "full")


def _check(joiner, how: str, allowed=HOW) -> None:
    need_callable(joiner, "joiner")
    if how not in allowed:
        raise ValueError(f"how must be one of {allowed}, got {how!r}")


# -- record with table, as of the record's time ------------------------------------


def stream_table_join(log: Log, table: Table, joiner: Pairwise, how: str = "inner") -> Log:
    """Each record meets the table's value at its own time; table updates emit nothing.

    At equal times the table's update comes first.  Records with a null key or
    value are skipped.  On streams with a watermark a record waits until it has passed, so
    that records and updates may come in any order within its delay; without one
    they meet as they come.
    """
    _check(joiner, how, ("inner", "left"))
    need_type(table, Table, "table")
    rest = [c for c in log.df.columns if c != KEY]
    rows = log.df.where(F.col(KEY).isNotNull() & F.col(VALUE).isNotNull())
    updates = table.updates()
    both = _tagged((updates, "__table"), (log._with(rows), "__row"), {"__row": rest})
    order = _tag_order(updates, log)
    if both.isStreaming and any("spark.watermarkDelayMs" in f.metadata for f in both.schema):
        from tidelog.streaming.held import keyed_as_of
        met = keyed_as_of(both, order)
    else:
        line = Timeline.of(both, (KEY,), order, updates.derived or log.derived)
        met = line.latest("__now", F.col("__table")).frame.where(F.col("__side") == 1)
    if how == "inner":
        met = met.where(F.col("__now.value").isNotNull())
    out = met.select(KEY, joiner(F.col("__row.value"), F.col("__now.value")).alias(VALUE),
                     *[F.col(f"__row.{c}").alias(c) for c in rest if c != VALUE])
    return Log(out, log.order, derived=True)


def _tag_order(*logs: Log) -> tuple[str, ...]:
    """One order for several logs: time, then side, then the rest of each log's order."""
    tail = dict.fromkeys(c for log in logs for c in log.order if c != "ts")
    return ("ts", "__side", *tail)


def _tagged(first: tuple[Log, str], second: tuple[Log, str],
            carry: dict[str, list[str]] | None = None) -> DataFrame:
    """Both logs in one frame: key, order columns, ``__side``, and a boxed row per side."""
    carry = carry or {}
    logs = (first[0], second[0])
    order = [c for c in _tag_order(*logs) if c != "__side"]
    frames = []
    for side, (log, name) in enumerate((first, second)):
        columns = carry.get(name, [VALUE])
        frames.append(log.df.select(
            KEY, *[c if c in log.order else F.lit(0).alias(c) for c in order],
            F.lit(side).alias("__side"), F.struct(*columns).alias(name)))
    return frames[0].unionByName(frames[1], allowMissingColumns=True)


# -- record with a global table -----------------------------------------------------


def global_join(log: Log, table: GlobalTable, lookup: Pairwise, joiner: Pairwise,
                how: str = "inner", as_of: bool = False) -> Log:
    """Look each record up in a table loaded beforehand, by a key computed from the record.

    No broadcast is forced: Catalyst broadcasts the snapshot while its size stays
    under the session's threshold (AQE checks the real size again), and beyond it
    the join shuffles, with hot lookup keys split by AQE.  ``as_of`` meets the
    table as it was at the record's time instead.
    """
    _check(joiner, how, ("inner", "left"))
    need_type(table, GlobalTable, "table")
    need_callable(lookup, "lookup")
    wanted = lookup(F.col(KEY), F.col(VALUE))
    if as_of:
        moved = log._with(log.df.withColumns({"__key": F.col(KEY), KEY: wanted}))
        out = stream_table_join(moved, table, joiner, how)
        return out._with(out.df.withColumn(KEY, F.col("__key")).drop("__key"))
    right = table.snapshot().select(F.col(KEY).alias("__rk"), F.struct(VALUE).alias("__r"))
    rows = log.df.withColumn("__wanted", wanted)
    if how == "inner":
        rows = rows.where(F.col("__wanted").isNotNull())
    met = rows.join(right, F.col("__wanted") == F.col("__rk"), how)
    out = met.withColumn(VALUE, joiner(F.col(VALUE), F.col("__r.value")))
    return Log(out.drop("__rk", "__r", "__wanted"), log.order, derived=True)


# -- table with table, same key -------------------------------------------------------


def table_join(left: Table, right: Table, joiner: Pairwise, how: str = "inner") -> Table:
    _check(joiner, how)
    need_type(right, Table, "right table")

    def snapshot() -> DataFrame:
        # keys are unique on both sides, so no key can be hot here
        l = left.snapshot().select(KEY, F.struct(VALUE).alias("__l"))  # noqa: E741
        r = right.snapshot().select(KEY, F.struct(VALUE).alias("__r"))
        both = l.join(r, KEY, how)
        return both.select(KEY, joiner(F.col("__l.value"), F.col("__r.value")).alias(VALUE))

    def updates() -> Log:
        a, b = left.updates(), right.updates()
        order = _tag_order(a, b)
        line = Timeline.of(_tagged((a, "__l"), (b, "__r")), (KEY,), order, a.derived or b.derived)

        def joined(l: Column, r: Column) -> Column:  # noqa: E741
            live = {"inner": l.isNotNull() & r.isNotNull(), "left": l.isNotNull(),
                    "full": l.isNotNull() | r.isNotNull()}[how]
            return F.when(live, joiner(l, r))

        sides = {"__ln": ("last", F.col("__l")), "__rn": ("last", F.col("__r"))}
        now = joined(F.col("__ln.value"), F.col("__rn.value"))
        if line.whole.isStreaming:
            # both sides before the record give the value before it: one state, not three
            line = line.all_running(**sides, __lb=("prior", F.col("__l")), __rb=("prior", F.col("__r")))
            line = line.with_columns(value=now, __before=joined(F.col("__lb.value"), F.col("__rb.value")))
        else:
            line = line.all_running(**sides).with_columns(value=now).previous("__before", F.col(VALUE))
        out = line.frame.where(F.col(VALUE).isNotNull() | F.col("__before").isNotNull())
        out = out.withColumnRenamed("__side", "side")
        order = tuple("side" if c == "__side" else c for c in order)
        return Log(out.select(KEY, VALUE, *order), order, derived=True)

    source = left.source.merge(right.source) if left.source and right.source else None
    return Table(updates, snapshot, source=source)


# -- table with table, foreign key ------------------------------------------------------


def foreign_key_join(left: Table, right: Table, foreign_key: Callable[[Column], Column],
                     joiner: Pairwise) -> Table:
    """Left rows find their right row by a key taken from the left value; keyed by the left key."""
    _check(joiner, "inner")
    need_callable(foreign_key, "foreign_key")
    need_type(right, Table, "right table")

    def snapshot() -> DataFrame:
        # AQE splits a hot foreign key; the right side has one row per key
        l = left.snapshot().select(F.col(KEY).alias("__lk"), F.struct(VALUE).alias("__l"),  # noqa: E741
                                   foreign_key(F.col(VALUE)).alias("__fk"))
        r = right.snapshot().select(F.col(KEY).alias("__rk"), F.struct(VALUE).alias("__r"))
        both = l.where(F.col("__fk").isNotNull()).join(r, F.col("__fk") == F.col("__rk"))
        return both.select(F.col("__lk").alias(KEY),
                           joiner(F.col("__l.value"), F.col("__r.value")).alias(VALUE))

    def updates() -> Log:
        a, b = left.updates(), right.updates()
        order = _tag_order(a, b)
        if a.streaming or b.streaming:
            from tidelog.streaming.joins import foreign_key_stream_join
            return foreign_key_stream_join(a, b, foreign_key, joiner, order)
        l = _versions(a, 0, order, "__l")  # noqa: E741
        r = _versions(b, 1, order, "__r", number="__r_n")
        l = _meeting(l.withColumn("__fk", foreign_key(F.col("__l"))), b, order)  # noqa: E741
        pairs = l.join(r, (F.col("__fk") == F.col("__r_key")) & (F.col("__n") == F.col("__r_n")))
        begins = F.greatest("__l_from", "__r_from")
        ends = F.least("__l_to", "__r_to")
        value = joiner(F.col("__l"), F.col("__r"))
        moves = pairs.select(F.col("__l_key").alias(KEY), F.explode(F.array(
            F.struct(begins.alias("at"), F.lit(True).alias("live"), value.alias(VALUE)),
            F.struct(ends.alias("at"), F.lit(False).alias("live"),
                     F.when(F.lit(False), value).alias(VALUE)))).alias("m"))
        # where one pair ends as the next begins, only the beginning is seen
        seen = (moves.where(F.col("m.at").isNotNull()).groupBy(KEY, F.col("m.at").alias("at"))
                .agg(F.max_by("m.value", "m.live").alias(VALUE)))
        names = tuple("side" if c == "__side" else c for c in order)
        return Log(seen.select(KEY, VALUE, *[F.col(f"at.{c}").alias(n)
                                             for c, n in zip(order, names)]), names, derived=True)

    return Table(updates, snapshot, source=left.source)


def _positions(log: Log, side: int, order: tuple[str, ...]) -> list[Column]:
    return [F.lit(side).alias(c) if c == "__side" else
            F.col(c) if c in log.order else F.lit(0).alias(c) for c in order]


def _versions(log: Log, side: int, order: tuple[str, ...], name: str,
              number: str | None = None) -> DataFrame:
    """Every live version of every key with the positions it holds from and to, and its
    ``number`` among the key's updates if that is wanted."""
    at = F.struct(*_positions(log, side, order))
    line = Timeline.of(log.df.withColumn("__at", at), (KEY,), log.order, log.derived)
    line = line.following("__to", F.col("__at"))
    if number:
        line = line.running(number, "count", F.lit(1))
    return line.frame.where(F.col(VALUE).isNotNull()).select(
        F.col(KEY).alias(f"{name}_key"), F.col(VALUE).alias(name), *([number] if number else []),
        F.col("__at").alias(f"{name}_from"), F.col("__to").alias(f"{name}_to"))


# Numbers are laid out in two steps, so that no array holds more than this many.
NUMBERS_AT_ONCE = 4096


def _meeting(l: DataFrame, right: Log, order: tuple[str, ...]) -> DataFrame:  # noqa: E741
    """Each left version once for the number ``__n`` of every right update it meets.

    These are the last update before the version begins and all until it ends, a range
    of numbers found by counting updates along the foreign key; so the join with
    the right versions, on key and number, makes no pair that is not a result.
    """
    totals = right.df.groupBy(F.col(KEY).alias("__fk")).agg(F.count(F.lit(1)).alias("__total"))
    known = l.join(totals, "__fk")
    probes = [known.where(F.col(at).isNotNull()).select(
        "__fk", f"{at}.*", F.lit(end).alias("__end"), "__total",
        F.struct("__l_key", "__l_from", "__l_to").alias("__who"),
        F.when(F.lit(not end), F.col("__l")).alias("__l"))
        for at, end in (("__l_from", False), ("__l_to", True))]
    ticks = right.df.select(F.col(KEY).alias("__fk"), *_positions(right, 1, order),
                            F.lit(1).alias("__tick"))
    both = probes[0].unionByName(probes[1]).unionByName(ticks, allowMissingColumns=True)
    line = Timeline.of(both, ("__fk",), order, derived=True)
    line = line.running("__met", "count", F.col("__tick"))
    met = line.frame.where(F.col("__who").isNotNull()).groupBy("__fk", "__who").agg(
        F.first("__l", ignorenulls=True).alias("__l"),
        F.max(F.when(~F.col("__end"), F.col("__met"))).alias("__low"),
        F.coalesce(F.max(F.when(F.col("__end"), F.col("__met"))), F.max("__total")).alias("__high"))
    met = met.withColumn("__low", F.greatest(F.col("__low"), F.lit(1))).where("__low <= __high")
    block = lambda c: F.floor(F.col(c) / F.lit(NUMBERS_AT_ONCE)).cast("long")
    start = F.col("__block") * NUMBERS_AT_ONCE
    spread = met.withColumn("__block", F.explode(F.sequence(block("__low"), block("__high"))))
    return spread.select("__fk", "__who.*", "__l", F.explode(F.sequence(
        F.greatest("__low", start), F.least(F.col("__high"), start + NUMBERS_AT_ONCE - 1))).alias("__n"))


# -- record with record, within a time window ---------------------------------------------


def windowed_join(left: Log, right: Log, joiner: Pairwise, windows: JoinWindows,
                  how: str = "inner", eager: bool = False) -> Log:
    """Records of equal key whose times differ by no more than the window allows.

    The batch plan joins on (key, time bucket): a bucket is as long as the whole
    window, each left row lies in one bucket and each right row in the one or two
    it can reach, so a hot key is spread over as many tasks as it has buckets.
    Unmatched rows come out once, at the end; ``eager`` adds them as early as a
    row arrives before any match.
    """
    _check(joiner, how)
    need_type(right, Log, "right log")
    need_type(windows, JoinWindows, "windows")
    if left.streaming or right.streaming:
        from tidelog.streaming.joins import windowed_stream_join
        return windowed_stream_join(left, right, joiner, windows, how)
    l, r = _side(left, "l"), _side(right, "r")  # noqa: E741
    pairs = _paired(l, r, windows, "inner" if how == "inner" or eager else "left")
    frames = [_joined(pairs, joiner)]
    if how != "inner" and eager:
        frames.append(_joined(_paired(l, r, windows, "left_anti", earlier=True), joiner, "l",
                              right.value_type))
    if how == "full":
        lonely = _paired(r, l, JoinWindows(windows.after_ms, windows.before_ms), "left_anti",
                         earlier=eager)
        frames.append(_joined(lonely, joiner, "r", left.value_type))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return Log(out, ("ts", "offset", "other_offset"), derived=True)


def _side(log: Log, name: str) -> DataFrame:
    rows = log.df.where(F.col(KEY).isNotNull() & F.col(VALUE).isNotNull())
    return rows.select(F.col(KEY).alias("k"), F.struct("ts", "offset", VALUE).alias(name))


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _paired(one: DataFrame, two: DataFrame, windows: JoinWindows, how: str,
            earlier: bool = False) -> DataFrame:
    """Join ``one`` (before .. after) ``two`` through time buckets."""
    a, b = one.columns[1], two.columns[1]
    width = max(1, windows.before_ms + windows.after_ms) * 1000
    bucket = lambda micros: F.floor(micros / F.lit(width)).cast("long")
    left = one.withColumn("__b", bucket(_micros(F.col(f"{a}.ts"))))
    t = _micros(F.col(f"{b}.ts"))
    reach = F.array_distinct(F.array(bucket(t - windows.after_ms * 1000),
                                     bucket(t + windows.before_ms * 1000)))
    right = two.withColumn("__b2", F.explode(reach)).withColumnRenamed("k", "k2")
    at, other = F.col(f"{a}.ts"), F.col(f"{b}.ts")
    near = ((F.col("k") == F.col("k2")) & (F.col("__b") == F.col("__b2"))
            & (other >= at - span(windows.before_ms)) & (other <= at + span(windows.after_ms)))
    if earlier:
        # on equal times the left log counts as the earlier one
        near = near & ((other < at) if a == "l" else (other <= at))
    return left.join(right, near, how).drop("__b", "__b2", "k2")


def _joined(pairs: DataFrame, joiner: Pairwise, only: str | None = None,
            other_type: DataType | None = None) -> DataFrame:
    field = lambda side, c: F.col(f"{side}.{c}")
    if only:
        missing = F.lit(None).cast(other_type)
        value = (joiner(field("l", VALUE), missing) if only == "l"
                 else joiner(missing, field("r", VALUE)))
        offset = [field(only, "offset"), F.lit(None).cast("long")]
        first, second = offset if only == "l" else offset[::-1]
        return pairs.select(F.col("k").alias(KEY), value.alias(VALUE),
                            field(only, "ts").alias("ts"), first.alias("offset"),
                            second.alias("other_offset"))
    return pairs.select(
        F.col("k").alias(KEY), joiner(field("l", VALUE), field("r", VALUE)).alias(VALUE),
        F.greatest(field("l", "ts"), field("r", "ts")).alias("ts"),
        field("l", "offset").alias("offset"), field("r", "offset").alias("other_offset"))


__all__ = ["stream_table_join", "global_join", "table_join", "foreign_key_join", "windowed_join",
           "without_idle_tombstones"]
