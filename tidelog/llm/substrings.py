"""Removing repeated byte strings with a suffix array sorted in two stages.

Every string of 200 bytes belongs to the smallest hash of the 64-byte strings in it, so equal
strings belong to the same hash, and the strings of a text fall into runs of neighbours with
one hash.  Only runs whose hash occurs in another run can hold a repeated string.  Their bytes
go to a task by hash; equal runs are folded first.  There a suffix array is built over them in
two stages: suffixes smaller than their successor are sorted directly, all others are induced
by scanning the buckets of first bytes in order.  Adjacent common prefixes of at least 200 bytes
then mark the strings that start more than once.  Nothing is ever compared across documents'
ends.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import batches_of_texts, stored
from tidelog.session import shared_folder

LENGTH = 200
SEED_BYTES = 64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.empty(count, np.uint64)
    out[0], done = 1, 1
    while done < count:
        step = np.uint64(pow(base, done, 1 << 64))
        more = min(done, count - done)
        out[done:done + more] = out[:more] * step
        done += more
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Seeds:
    """Hashes of all strings of ``size`` bytes of a text, and their minima over longer strings."""

    def __init__(self, limit: int, length: int = LENGTH, size: int = SEED_BYTES) -> None:
        self.length, self.size, self.limit = length, size, limit
        self.places = (1 << max(1, limit - 1).bit_length()) - 1
        self.up, self.down = _powers(_BASE, limit), _powers(_INVERSE, limit)

    def hashes(self, text: np.ndarray) -> np.ndarray:
        """The hash of the ``size`` bytes at each place."""
        n = len(text)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        return _mixed((sums[self.size:] - sums[:-self.size]) * self.down[:n - self.size + 1])

    def smallest(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each start of a string of ``length`` bytes the smallest hash in it, and its place.

        Of hashes equal in their upper bits the first counts, which depends on the string alone.
        """
        hashes = self.hashes(text)
        low = np.uint64(self.places)
        least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        span, width = 1, self.length - self.size + 1
        while span < width:
            step = min(span, width - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        place = (least & low).astype(np.int64)
        return hashes[place], place

    def runs(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, first, last, places): runs of string starts with one smallest hash, and at how
        many places it stands there; more than one only in a run that may repeat itself."""
        if len(text) < self.length:
            none = np.zeros(0, np.int64)
            return none.astype(np.uint64), none, none, none
        least, place = [], []
        reach = self.limit - self.length + 1
        for at in range(0, len(text) - self.length + 1, reach):
            found, where = self.smallest(text[at:at + self.limit])
            least.append(found)
            place.append(where + at)
        least, place = np.concatenate(least), np.concatenate(place)
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        moved = np.add.reduceat(np.r_[True, place[1:] != place[:-1]].astype(np.int64), first)
        return least[first], first, np.r_[first[1:] - 1, len(least) - 1], np.maximum(moved, 1)


def suffix_array(text: np.ndarray, first: np.ndarray, last: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` that start in [first, last] of each string, sorted to ``depth``.

    Each string ends with a 0, which occurs nowhere else.  Suffixes smaller than their successor
    are sorted directly; every other one is placed when its successor is scanned.
    """
    n = len(text)
    step = np.ones(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    places = np.arange(n)
    # Equal neighbours compare as the next unequal ones do.
    turn = np.minimum.accumulate(np.where(step != 0, places, n - 1)[::-1])[::-1]
    smaller = step[turn] > 0
    smaller[n - 1] = True
    # Beyond the last wanted start the chain of induced suffixes goes on to a sorted one.
    anchor = np.minimum.accumulate(np.where(smaller, places, n - 1)[::-1])[::-1]
    wanted = np.zeros(n + 1, np.int32)
    np.add.at(wanted, first, 1)
    np.add.at(wanted, anchor[last] + 1, -1)
    wanted = np.cumsum(wanted[:-1]) > 0
    direct = np.flatnonzero(wanted & smaller)
    chars = text.tobytes().decode("latin-1")
    keys = [chars[i:i + depth] for i in direct.tolist()]
    direct = direct[np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)]
    del keys, chars
    # An induced suffix is the one before a scanned suffix of its string.
    induced = wanted & ~smaller
    begins = np.zeros(n, bool)
    begins[first] = True
    heads = text[direct]
    waiting: dict[int, list[np.ndarray]] = {}
    out = []
    for char in np.unique(text[wanted]).tolist():
        wave = np.concatenate(waiting.pop(char)) if char in waiting else np.zeros(0, np.int64)
        bucket = []
        while len(wave):
            bucket.append(wave)
            wave = wave[~begins[wave]] - 1
            wave = wave[induced[wave] & (text[wave] == char)]
        bucket.append(direct[np.searchsorted(heads, char):np.searchsorted(heads, char, "right")])
        scanned = np.concatenate(bucket)
        out.append(scanned)
        before = scanned[~begins[scanned]] - 1
        before = before[induced[before] & (text[before] > char)]
        order = np.argsort(text[before], kind="stable")
        before = before[order]
        for part in np.split(before, np.flatnonzero(np.diff(text[before])) + 1):
            if len(part):
                waiting.setdefault(int(text[part[0]]), []).append(part)
    return np.concatenate(out)


def repeated(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string the starts of its ``length``-byte parts that also start elsewhere in them."""
    sizes = np.array([len(s) for s in strings])
    begin = np.r_[0, np.cumsum(sizes + 1)[:-1]]
    text = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8) + np.uint8(1)
    last = begin + sizes - length
    array = suffix_array(text, begin, last, length)
    owner = np.searchsorted(begin, array, "right") - 1
    array = array[array <= last[owner]]
    padded = np.r_[text, np.zeros(8, np.uint8)]
    words = np.ndarray((len(text),), "<u8", padded.tobytes(), strides=(1,))
    a, b = array[:-1], array[1:]
    for at in [*range(0, length - 7, 8), length - 8]:
        # Neighbours whose common prefix reaches on.
        same = words[a + at] == words[b + at]
        a, b = a[same], b[same]
    hit = np.zeros(len(text), bool)
    hit[a] = hit[b] = True
    return [np.flatnonzero(hit[x:x + s]) for x, s in zip(begin.tolist(), sizes.tolist())]


def ranges(starts: np.ndarray) -> list[tuple[int, int]]:
    """Runs of consecutive numbers, as (first, last)."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1) + 1
    return [(int(p[0]), int(p[-1])) for p in np.split(starts, cut)]


def spread(string: bytes, key: int, seeds: Seeds) -> list[tuple[int, int, bytes]]:
    """A string whose hash is in very many strings, cut by where the smallest hash stands.

    Equal parts have it at the same offset and agree in all their bytes, so the bytes that every
    part of an offset range has on either side of it give a finer key.  The ranges double
    from both ends: where the surroundings differ, they differ within the finer key.  Returns
    (finer key, offset of the first part, bytes).
    """
    text = np.frombuffer(string, np.uint8)
    width = seeds.length - seeds.size
    stands = np.flatnonzero(seeds.hashes(text) == np.uint64(key))
    starts = np.arange(len(text) - seeds.length + 1)
    at = stands[np.searchsorted(stands, starts)]
    offset = at - starts
    side = np.minimum(offset, width - offset)
    level = np.where(side > 0, np.floor(np.log2(np.maximum(side, 1))) + 1, 0).astype(int)
    kind = np.where(offset <= width - offset, level, -level - 1)
    cut = np.flatnonzero((np.diff(kind) != 0) | (np.diff(at) != 0)) + 1
    out = []
    for part in np.split(starts, cut):
        lo, hi = int(part[0]), int(part[-1])
        # Bounds of the offset over the whole range, not only over this string's part of it.
        near, reach = _bounds(int(kind[lo]), width)
        stand = int(at[lo])
        core = string[stand - near:stand + seeds.size + width - reach]
        finer = xxhash.xxh64_intdigest(core, (key + int(kind[lo])) & 0xFFFFFFFF)
        out.append((finer, lo, string[lo:hi + seeds.length]))
    return out


def _bounds(kind: int, width: int) -> tuple[int, int]:
    """The least and greatest offset of a range."""
    level = kind if kind >= 0 else -kind - 1
    lo, hi = (0, 0) if level == 0 else (1 << (level - 1), min((1 << level) - 1, width))
    if kind >= 0:
        return lo, min(hi, width // 2)
    return max(width - hi, width - width // 2), width - lo


# One task's suffix array covers about so many bytes.
ARRAY_BYTES = 2_000_000
# Different strings of one hash, beyond which the hash is spread over finer keys.
HOT = 10_000
# Bytes of a text hashed at once.
PART_BYTES = 1 << 20
_FAR = "array<struct<a:int,b:int>>"


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _texts(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The texts as compressed bytes, stored by row number so that joins on it need no shuffle."""
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()

    def pack(batches):
        for batch, chunk in batches_of_texts(batches, "text"):
            squeeze = zstandard.ZstdCompressor(level=3)
            raw = [(t or "").encode("utf-8", "surrogatepass") for t in chunk]
            yield pa.RecordBatch.from_arrays(
                [batch.column("n"), batch.column("doc_id"), pa.array([len(r) for r in raw], pa.int64()),
                 pa.array([squeeze.compress(r) for r in raw], pa.binary())], ["n", "doc_id", "n_bytes", "packed"])

    rows = docs.select(F.monotonically_increasing_id().alias("n"), docs[doc_id].alias("doc_id"),
                       docs[text].alias("text"))
    packed = rows.mapInArrow(pack, f"n long, doc_id {kind}, n_bytes long, packed binary")
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"tidelog_texts_{uuid.uuid4().hex}"
    (packed.repartition(count, "n").write.option("path", shared_folder(spark, "texts"))
     .bucketBy(count, "n").sortBy("n").saveAsTable(name))
    return spark.table(name)


def _unpacked(batch: pa.RecordBatch, at: int) -> bytes:
    return zstandard.ZstdDecompressor().decompress(batch.column("packed")[at].as_py())


def _runs(texts: DataFrame, length: int, size: int) -> DataFrame:
    """(key, part, n, lo, hi, places): runs of string starts; ``part`` names their bytes."""

    def run(batches):
        seeds = Seeds(max(PART_BYTES, 2 * length), length, size)
        for batch in batches:
            for at in range(batch.num_rows):
                raw = _unpacked(batch, at)
                if len(raw) < length:
                    continue
                keys, lo, hi, places = seeds.runs(np.frombuffer(raw, np.uint8))
                parts = [xxhash.xxh3_64_digest(raw[a:b]) for a, b in zip(lo.tolist(), (hi + length).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(np.frombuffer(b"".join(parts), np.int64)),
                     pa.array(np.full(len(keys), batch.column("n")[at].as_py())), pa.array(lo.astype(np.int32)),
                     pa.array(hi.astype(np.int32)), pa.array(np.minimum(places, 2).astype(np.int8))],
                    ["key", "part", "n", "lo", "hi", "places"])

    return texts.select("n", "packed").mapInArrow(
        run, "key long, part long, n long, lo int, hi int, places byte")


def _strings(wanted: DataFrame, texts: DataFrame, length: int, size: int, finer: bool) -> DataFrame:
    """(near, key, part, base, sub, copies, bytes) of the runs in ``wanted``; cut up if ``finer``."""
    lists = wanted.groupBy("n").agg(F.collect_list(F.struct("key", "part", "lo", "hi", "copies")).alias("runs"))

    def run(batches):
        seeds = Seeds(PART_BYTES, length, size) if finer else None
        names = ["near", "key", "part", "base", "sub", "copies", "bytes"]
        for batch in batches:
            for at in range(batch.num_rows):
                raw, rows = _unpacked(batch, at), []
                for r in batch.column("runs")[at].as_py():
                    string = raw[r["lo"]:r["hi"] + length]
                    if not finer:
                        rows.append((r["key"], r["key"], r["part"], 0, r["part"], r["copies"], string))
                        continue
                    # Runs of more than a part's bytes are periodic; pieces of them are cut alike.
                    for lo in range(0, len(string) - length + 1, PART_BYTES - length + 1):
                        for near, base, piece in spread(string[lo:lo + PART_BYTES], r["key"] % (1 << 64), seeds):
                            rows.append((_signed(near), r["key"], r["part"], lo + base,
                                         _signed(xxhash.xxh3_64_intdigest(piece)), r["copies"], piece))
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return lists.join(texts.select("n", "packed"), "n").mapInArrow(
        run, "near long, key long, part long, base int, sub long, copies long, bytes binary")


def _marked(strings: DataFrame, length: int) -> DataFrame:
    """(near, sub, marks): ranges of repeated starts in the strings (near, sub, copies, bytes)."""
    dealt = strings.select("near", "sub", "copies", "bytes").repartition("near").sortWithinPartitions("near")

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        found = repeated([r[3] for r in rows], length)
        out = []
        for (near, sub, copies, string), starts in zip(rows, found):
            marks = [(0, len(string) - length)] if copies > 1 else ranges(starts)
            if marks:
                out.append((near, sub, [{"a": a, "b": b} for a, b in marks]))
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)],
                                          ["near", "sub", "marks"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("near", "sub", "copies", "bytes"))):
                if size >= ARRAY_BYTES and row[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield solve(held)

    return dealt.mapInArrow(run, f"near long, sub long, marks {_FAR}")


def _all_marks(kept: DataFrame, texts: DataFrame, length: int, size: int, hot: int) -> DataFrame:
    """(key, part, marks) of every different run that holds repeated strings."""
    folded = stored(kept.groupBy("key", "part").agg(
        F.count("*").alias("copies"), F.min(F.struct("n", "lo", "hi")).alias("at"))
        .select("key", "part", "copies", "at.*"), "folded")
    variants = stored(folded.groupBy("key").agg(F.count("*").alias("variants")), "variants")
    counted = folded.join(variants, "key")
    # A run all of whose occurrences are equal is settled: its strings start once in each.
    settled = F.expr("variants = 1 AND copies > 1")
    whole = F.array(F.struct(F.lit(0).alias("a"), (F.col("hi") - F.col("lo")).alias("b")))
    marks = counted.where(settled).select("key", "part", whole.alias("marks"))
    plain = _strings(counted.where(~settled & (F.col("variants") <= hot)), texts, length, size, False)
    found = _marked(plain, length).select(F.col("near").alias("key"), F.col("sub").alias("part"), "marks")
    marks = marks.unionByName(found)
    crowded = counted.where(F.col("variants") > hot)
    if crowded.isEmpty():
        return marks
    pieces = stored(_strings(crowded, texts, length, size, True), "pieces")
    alike = pieces.groupBy("near", "sub").agg(F.sum("copies").alias("copies"), F.first("bytes").alias("bytes"))
    finer = stored(_marked(alike, length), "finer")
    moved = F.transform("marks", lambda m: F.struct((m["a"] + F.col("base")).alias("a"),
                                                    (m["b"] + F.col("base")).alias("b")))
    back = pieces.select("near", "sub", "key", "part", "base").join(finer, ["near", "sub"])
    return marks.unionByName(back.select("key", "part", moved.alias("marks")))


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH,
                   size: int = SEED_BYTES, hot: int = HOT) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, spans, kept.

    Removes every byte covered by a string of ``length`` bytes that also starts anywhere else,
    in another row or in the same one; ``kept`` are the remaining bytes, ``spans`` the removed
    ones as (start, end).  Texts are UTF-8; null counts as empty; a text shorter than ``length``
    keeps all.  Repeated rows and ids are texts like any other, so they remove each other.  An
    empty table gives an empty result.
    """
    texts = _texts(docs, text, doc_id)
    runs = _runs(texts, length, size)
    again = runs.groupBy("key").agg(F.sum("places").alias("places")).where("places > 1").select("key")
    kept = stored(runs.drop("places").join(again, "key"), "kept")
    marks = stored(_all_marks(kept, texts, length, size, hot), "marks")
    placed = kept.select("key", "part", "n", "lo").join(marks, ["key", "part"])
    span = F.transform("marks", lambda m: F.struct((m["a"] + F.col("lo")).alias("a"),
                                                   (m["b"] + F.col("lo") + length).alias("b")))
    lists = placed.select("n", span.alias("marks")).groupBy("n").agg(F.flatten(F.collect_list("marks")).alias("marks"))

    def apply(batches):
        pair = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for at in range(batch.num_rows):
                raw, spans = _unpacked(batch, at), []
                for a, b in sorted((m["a"], m["b"]) for m in batch.column("marks")[at].as_py() or []):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(b, spans[-1][1])
                    else:
                        spans.append([a, b])
                edges = [0, *(x for s in spans for x in s), len(raw)]
                rest = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, 1), pa.array([len(raw)], pa.int64()),
                     pa.array([len(raw) - len(rest)], pa.int64()), pa.array([len(spans)], pa.int64()),
                     pa.array([[{"start": a, "end": b} for a, b in spans]], pair), pa.array([rest], pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return texts.join(lists, "n", "left").select("doc_id", "packed", "marks").mapInArrow(
        apply, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, "
               "spans array<struct<start:int,end:int>>, kept binary")
