"""Questions about captured output."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.scalars import at_path
from tidelog.operators.log import KEY, VALUE, Log, holds, need_callable

PLACE = ("partition", "offset")


def _place(log: Log) -> tuple[str, ...]:
    return tuple(c for c in PLACE if c in log.df.columns) or log.order


def raw_messages(log: Log, topic: str | None = None) -> DataFrame:
    """The records of a topic in offset order."""
    df = log.df if topic is None else log.df.where(F.col("topic") == topic)
    return df.orderBy(*_place(log))


def messages(log: Log, topic: str | None = None) -> DataFrame:
    return raw_messages(log, topic).select(VALUE)


def messages_where(log: Log, path: str, pred: Callable[[Column], Column]) -> Log:
    """The records whose value at ``path`` meets ``pred``."""
    need_callable(pred, "predicate")
    return Log(log.df.where(holds(pred(at_path(F.col(VALUE), path)))), log.order)


def messages_equal(log: Log, path: str, value) -> Log:
    return messages_where(log, path, lambda c: c == F.lit(value))


def by_key(log: Log, path: str, value) -> DataFrame:
    """The first value whose ``path`` equals ``value`` (no row if there is none)."""
    found = messages_equal(log, path, value).df
    first = found.agg(F.min_by(F.struct(VALUE), F.struct(*_place(log))).alias("m"))
    return first.where(F.col("m").isNotNull()).select(F.col("m.value").alias(VALUE))


def by_id(log: Log, value) -> DataFrame:
    return by_key(log, "id", value)


def by_keys(log: Log, path: str, values: Sequence | DataFrame) -> Log:
    """All records whose ``path`` is one of ``values`` (a sequence, or a one-column frame)."""
    if isinstance(values, DataFrame):
        wanted = values.select(F.col(values.columns[0]).alias("__wanted")).distinct()
        found = log.df.join(wanted, at_path(F.col(VALUE), path) == F.col("__wanted"), "left_semi")
        return Log(found, log.order)
    return Log(log.df.where(at_path(F.col(VALUE), path).isin(list(values))), log.order)


def missing_ids(log: Log, path: str, ids: DataFrame) -> DataFrame:
    """The ids no record has at ``path``; empty when all are present."""
    name = ids.columns[0]
    # distinct first: a hot id shrinks to one row before the shuffle
    seen = log.df.select(at_path(F.col(VALUE), path).alias("__seen")).distinct()
    return ids.distinct().join(seen, F.col(name) == F.col("__seen"), "left_anti")


def all_keys_present(log: Log, path: str, ids: DataFrame) -> bool:
    return missing_ids(log, path, ids).isEmpty()


__all__ = ["KEY", "raw_messages", "messages", "messages_where", "messages_equal", "by_key",
           "by_id", "by_keys", "missing_ids", "all_keys_present"]
