"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import shared_folder

# Texts a Python task works on together, in characters.
CHUNK_CHARS = 2_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    place = shared_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def text_of(name: str) -> Column:
    """The text column, null counted as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def numbered(df: DataFrame) -> DataFrame:
    """Whole rows packed away in ``row`` next to a row number: no column name can clash.

    The number is only stable once the result is stored.
    """
    return df.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("n"))


def chunks(sizes: Iterable[int], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Cut positions 0..n into runs whose sizes sum to about ``limit``."""
    start, total, at = 0, 0, -1
    for at, size in enumerate(sizes):
        total += size
        if total >= limit:
            yield start, at + 1
            start, total = at + 1, 0
    if start <= at:
        yield start, at + 1


def batches_of_texts(batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_CHARS
                     ) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Record batches cut so that the texts of each hold a bounded number of characters.

    ``column`` may name a field of a struct column, as ``row.text``.
    """
    column, _, inner = column.partition(".")
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column)
        if inner:
            texts = pa.compute.struct_field(texts, inner)
        lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
        for lo, hi in chunks(lengths, limit):
            yield batch.slice(lo, hi - lo), texts.slice(lo, hi - lo).to_pylist()
        del batch, texts
        # Workers outlive their tasks; what they no longer need goes back to the executor.
        pa.default_memory_pool().release_unused()


def per_worker(slot: str, key: str, make: Callable):
    """What ``make`` built for ``key`` in this Python worker, kept for the tasks that follow.

    Functions travel to the workers by value, so they have no module to keep things in.  A slot
    holds one thing; another key takes its place.
    """
    state = sys.modules.setdefault("_tidelog_worker", types.ModuleType("_tidelog_worker"))
    if getattr(state, slot, (None,))[0] != key:
        setattr(state, slot, (None,))
        setattr(state, slot, (key, make()))
    return getattr(state, slot)[1]


def let_go() -> None:
    """Drop what earlier operators kept in this Python worker."""
    sys.modules.pop("_tidelog_worker", None)


class Memo:
    """Remembers what ``compute`` made of a unit; starts again beyond ``limit`` entries.

    Bounds memory only: a unit seen again after a restart is computed again.
    """

    def __init__(self, compute: Callable[[list], list], limit: int) -> None:
        self.compute, self.limit, self.known = compute, limit, {}

    def learn(self, units: set) -> dict:
        missing = list(units.difference(self.known))
        if len(self.known) + len(missing) > self.limit:
            self.known = {}
            missing = list(units)
        self.known.update(zip(missing, self.compute(missing), strict=True))
        return self.known


class FrequentMemo:
    """Remembers results of units that keep coming.

    Two generations: a unit of the older one that is asked for moves to the newer, and a full newer
    one takes the older one's place.  So what comes again within ``limit`` / 2 others stays, and no
    more than ``limit`` and one batch are held.
    """

    def __init__(self, limit: int) -> None:
        self.limit, self.newer, self.older = limit, {}, {}

    def find(self, units: set) -> tuple[dict, set]:
        """(a dictionary with the results that are known, the units that are not)."""
        if len(self.newer) > self.limit // 2:
            self.older, self.newer = self.newer, {}
        missing = units.difference(self.newer)
        known = missing.intersection(self.older)
        self.newer.update([(unit, self.older.pop(unit)) for unit in known])
        return self.newer, missing.difference(known)

    def add(self, results: Iterable[tuple]) -> None:
        self.newer.update(results)
