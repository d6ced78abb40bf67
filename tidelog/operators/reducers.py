"""What a group can be reduced to.

A ``Reducer`` names an algebraic aggregate, so one definition serves the grouped
plan (partially aggregated before the shuffle), the running plan (one value per
update) and the streaming plan.  ``Fold`` is the fallback for any Python fold
that depends on record order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("sum", "count", "min", "max", "first", "last")


def _value(key: Column, value: Column) -> Column:
    return value


@dataclass(frozen=True)
class Reducer:
    kind: str
    of: Callable[[Column, Column], Column] = _value

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown reducer {self.kind!r}; one of {KINDS}")
        if not callable(self.of):
            raise TypeError("a reducer takes a function (key, value) -> Column")

    @property
    def invertible(self) -> bool:
        return self.kind in ("sum", "count")

    @property
    def plain(self) -> bool:
        """Whether it takes the values as they are."""
        return self.of is _value

    def input(self, key: str = "key", value: str = "value") -> Column:
        return self.of(F.col(key), F.col(value))

    def grouped(self, order: Sequence[str]) -> Column:
        """The aggregate expression for ``groupBy().agg()``."""
        x = self.input()
        if self.kind in ("first", "last"):
            pick = F.min_by if self.kind == "first" else F.max_by
            return pick(x, F.when(x.isNotNull(), F.struct(*order)))
        return getattr(F, self.kind)(x)


def total(of: Callable[[Column, Column], Column] = _value) -> Reducer:
    return Reducer("sum", of)


def counted() -> Reducer:
    return Reducer("count", lambda k, v: F.lit(1))


def smallest(of: Callable[[Column, Column], Column] = _value) -> Reducer:
    return Reducer("min", of)


def largest(of: Callable[[Column, Column], Column] = _value) -> Reducer:
    return Reducer("max", of)


def earliest(of: Callable[[Column, Column], Column] = _value) -> Reducer:
    return Reducer("first", of)


def newest(of: Callable[[Column, Column], Column] = _value) -> Reducer:
    return Reducer("last", of)


@dataclass(frozen=True)
class Fold:
    """Any fold over a key's records in order: ``step(acc, key, value) -> acc``.

    ``schema`` is the DDL type of the accumulator.  With ``merge(key, a, b)`` a
    hot key is folded in slices whose results are merged in order; without it a
    key is one sequential pass (streamed, never held in memory).
    """

    zero: object
    step: Callable[[object, object, object], object]
    schema: str
    merge: Callable[[object, object, object], object] | None = None

    def starting(self, init) -> Fold:
        """This fold begun with ``init``; one that merges slices would count it in each."""
        if init is None:
            return self
        if self.merge is not None:
            raise ValueError("give a fold with merge its start as zero, not as init")
        return replace(self, zero=init)
