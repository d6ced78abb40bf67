"""Near-duplicates by SimHash, found with an inverted index over fingerprint bytes.

Fingerprints of 64 bits within 3 bits of each other agree in at least 5 of their 8 bytes.  The
index has a posting list for each choice of 5 byte positions and the bytes found there, so a
pair that meets in a list has reached the guaranteed minimum of 5 shared positional bytes; the
count of further shared bytes is tallied only to keep a pair to the first list it meets in.
Pairs are verified by their differing bits.  Copies are folded to one fingerprint first, and
the members of a list differ in 24 bits at most, which bounds a list by 2**24 entries.  A list
gives a spanning forest of its links, never all pairs; a long list looks up the 2,324 possible
neighbours of each member instead of comparing pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import batches_of_texts, let_go, stored
from tidelog.llm.components import components

BITS = 3
SEED = 42
SHINGLE = 3
SHARED = 8 - BITS
LISTS = list(combinations(range(8), SHARED))
# Beyond so many members a list is probed by neighbour instead of compared by pair.
PROBE_FROM = 2_400
PART_BYTES = 1 << 20


def _mask(positions: Iterable[int]) -> int:
    return sum(0xFF << (8 * p) for p in positions)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


MASKS = np.array([_mask(x) for x in LISTS], dtype=np.uint64)
NEIGHBOURS = [sum(1 << b for b in flips) for k in range(1, BITS + 1)
              for flips in combinations(range(8 * (8 - SHARED)), k)]


def _parts(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in runs of bounded size."""
    start = 0
    while start < len(text):
        end = min(len(text), start + PART_BYTES)
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield text[start:end].split()
        start = end


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text's 3-word shingles; 0 for a text without words."""
    ones, total, last = np.zeros(64, dtype=np.int64), 0, []
    digest = xxhash.xxh64_digest
    for words in _parts((text or "").encode("utf-8", "surrogatepass").lower()):
        words = last + words
        hashes = [digest(x, SEED) for x in map(b" ".join, zip(words, words[1:], words[2:]))]
        if hashes:
            bits = np.frombuffer(b"".join(hashes), dtype=np.uint8).reshape(-1, 8)
            ones += np.unpackbits(bits, axis=1).sum(axis=0, dtype=np.int64)
        total += len(hashes)
        last = words[-2:] if len(words) >= 2 else words
    if not total:
        if not last:
            return 0
        return xxhash.xxh64_intdigest(b" ".join(last), SEED)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with a long column of fingerprints."""
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())])

    def run(batches):
        let_go()
        for batch, texts in batches_of_texts(batches, text):
            prints = pa.array([_signed(fingerprint(t)) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, prints], [*batch.schema.names, out])

    return docs.mapInArrow(run, schema)


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while True:
        ra, rb = _find(parent, a), _find(parent, b)
        apart = ra != rb
        if not apart.any():
            return
        np.minimum.at(parent, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])


def _find(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    root = parent[nodes]
    while (up := parent[root]).tobytes() != root.tobytes():
        root = up
    return root


def _free_bits(prints: np.ndarray, positions: tuple[int, ...]) -> np.ndarray:
    free = [p for p in range(8) if p not in positions]
    out = np.zeros(len(prints), dtype=np.uint32)
    for at, p in enumerate(free):
        out |= ((prints >> np.uint64(8 * p)) & np.uint64(0xFF)).astype(np.uint32) << np.uint32(8 * at)
    return out


def _forest(which: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (print, its root) within whole lists, given sorted by list, then by print."""
    keys = prints & MASKS[which]
    starts = np.flatnonzero(np.r_[True, (which[1:] != which[:-1]) | (keys[1:] != keys[:-1])])
    sizes = np.diff(np.r_[starts, len(prints)])
    group = np.repeat(np.arange(len(starts)), sizes)
    parent = np.arange(len(prints))
    short = np.flatnonzero((sizes > 1)[group] & (sizes < PROBE_FROM)[group])
    lag = 1
    while len(short):
        short = short[short + lag < len(prints)]
        short = short[group[short] == group[np.minimum(short + lag, len(prints) - 1)]]
        near = np.bitwise_count(prints[short] ^ prints[short + lag]) <= BITS
        if near.any():
            _unite(parent, short[near], short[near] + lag)
        lag += 1
    for g in np.flatnonzero(sizes >= PROBE_FROM):
        lo = starts[g]
        values = _free_bits(prints[lo:lo + sizes[g]], LISTS[which[lo]])
        order = np.argsort(values)
        values = values[order]
        for flip in NEIGHBOURS:
            wanted = values ^ np.uint32(flip)
            at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
            found = values[at] == wanted
            if found.any():
                _unite(parent, lo + order[found], lo + order[at[found]])
    root = _find(parent, np.arange(len(prints)))
    linked = root != np.arange(len(prints))
    return prints[linked], prints[root[linked]]


def links(prints: DataFrame, column: str = "fp") -> DataFrame:
    """Rows (a, b): links among distinct fingerprints that span their components."""
    lists = F.array(*[F.struct(F.lit(i).cast("short").alias("list"),
                               F.col(column).bitwiseAND(F.lit(_signed(int(m)))).alias("key"))
                      for i, m in enumerate(MASKS)])
    postings = prints.select(F.col(column).alias("fp"), F.explode(lists).alias("at"))
    postings = postings.select("fp", F.col("at.list").alias("list"), F.col("at.key").alias("key"))
    dealt = postings.repartition("list", "key").sortWithinPartitions("list", "key", "fp")

    def run(batches):
        which, held = np.zeros(0, np.int16), np.zeros(0, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            which = np.concatenate([which, batch.column("list").to_numpy()])
            held = np.concatenate([held, batch.column("fp").to_numpy().view(np.uint64)])
            keys = held & MASKS[which]
            change = np.flatnonzero((which[1:] != which[:-1]) | (keys[1:] != keys[:-1]))
            cut = change[-1] + 1 if len(change) else 0
            if cut:
                yield _edges(*_forest(which[:cut], held[:cut]))
                which, held = which[cut:], held[cut:]
        if len(held):
            yield _edges(*_forest(which, held))

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])


def simhash_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                  whole_rows: bool = False) -> DataFrame:
    """One row per input row: doc_id, fingerprint (hex), component_id, kept.

    ``component_id`` is the smallest ``doc_id`` reachable over links of at most 3 differing
    bits (null only where no member has an id).  ``kept`` marks exactly one row per component:
    the one with that id, of repeated ids the first.  Null and empty texts have fingerprint
    zero and link like any other.  An empty table gives an empty result.  With ``whole_rows``
    the input row comes along as a struct ``row``.
    """
    packed = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("n"))
    ids = [F.col("row")[doc_id].alias("doc_id"), "n"]
    if whole_rows:
        rows = fingerprints(packed.select("row", *ids), f"row.{text}", "fp")
    else:
        rows = fingerprints(packed.select(F.col("row")[text].alias("text"), *ids), "text", "fp").drop("text")
    rows = stored(rows, "prints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(prints))
    rooted = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # Stored, so that the join below has its own shuffle, which can split a hot fingerprint's rows.
    named = stored(rooted.join(least, "root").select("fp", "root", "component_id"), "named")
    joined = rows.drop("row").join(named, "fp")
    out = ["doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"]
    if not whole_rows:
        return joined.select(*out)
    # Rows that carry the component's id: one, unless ids repeat or are all missing.
    joined = stored(joined, "joined")
    heads = (joined.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .groupBy("root").agg(F.min("n").alias("head")))
    marked = joined.join(heads, "root").select("n", *out, (F.col("n") == F.col("head")).alias("kept"))
    return marked.join(rows.select("n", "row"), "n").drop("n")
