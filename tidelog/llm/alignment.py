"""Aligning the tokens of two tokenizers over the same text.

Tokens are byte ranges.  ``merge_asof`` over the token starts of one side finds the token of the
other side that covers each, keyed by the stretch of document they lie in; both directions
together are the overlaps.  Where a token and the one that covers it start together, both sides
ended together before: these places cut the tokens into groups, the smallest runs in which both
sides hold the same bytes.

Documents come in stretches, cut before a single space between two words, where neither tokenizer
lets a token reach across; so a stretch is aligned once and remembered while it stays frequent.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import tokenizer as tk
from tidelog.llm.common import FrequentMemo, batches_of_texts, per_worker, stored, text_of

# Stretches a worker remembers (some 350 bytes each): no longer ones, and none met only once in a batch.
MEMO_STRETCHES = 140_000
KEPT_CHARS = 48
BATCH_CHARS = 2_000_000
# Stretches encoded as one text.
ENCODED_AT_ONCE = 4_096
SPACE = "▁"
DOUBTFUL = re.compile(r" (?=\s|\Z)")


def _byte_alphabet() -> dict[int, str]:
    """The characters byte-level tokenizers write bytes with: printable ones as they are."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _piece_bytes(piece: str, is_byte: bool) -> bytes:
    return bytes([int(piece[1:-1], 16)]) if is_byte else piece.replace(SPACE, " ").encode()


class Pair:
    """Both tokenizers, loaded, with the bytes of their tokens."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a = tk.load(byte_path)
        self.a.encode_special_tokens = True
        back = {c: b for b, c in _byte_alphabet().items()}
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(back.get(c, 0) for c in n) for n in names]
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = range(self.b.get_piece_size())
        self.b_bytes = [_piece_bytes(self.b.id_to_piece(i), self.b.is_byte(i)) for i in pieces]
        self.a_names, self.b_names = (np.array([[f"{i}{sign}" for i in range(len(side))] for sign in ("," + end)], object)
                                      for side, end in ((self.a_bytes, "|"), (self.b_bytes, ";")))
        self.a_size, self.b_size = (np.array([len(x) for x in side]) for side in (self.a_bytes, self.b_bytes))
        # cutting needs pieces that hold a space at their start only
        self.cuttable = not any(SPACE in self.b.id_to_piece(i).lstrip(SPACE) for i in pieces)

    def stretches(self, text: str) -> list[str]:
        """A text cut at each single space between two words; a stretch begins with that space, which
        is left out here, and the first with the space that leads the text."""
        if not self.cuttable:
            return [text]
        words = text.split(" ")
        if words[0] and not words[0][0].isspace() and DOUBTFUL.search(text) is None:
            return words
        out = [words[0]]
        for before, word in zip(words, words[1:]):
            # a space before white space, or after a space, belongs to what stands before it
            if not word or word[0].isspace() or not before:
                out[-1] += " " + word
            else:
                out.append(word)
        return out

    def spells(self, stretches: list[str], a: list[int], b: list[int]) -> bool:
        """Whether both sides spell the stretches, each led by a space."""
        spelt = (" " + " ".join(stretches)).encode()
        return (b"".join([self.a_bytes[i] for i in a]) == spelt and b"".join([self.b_bytes[i] for i in b]) == spelt)

    def encoded(self, stretches: list[str]) -> tuple[list[int], list[int]]:
        """Ids of both sides for stretches in one text; the second puts the leading space back itself."""
        text = " ".join(stretches)
        return (self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text))

    def spelt(self, stretches: list[str]) -> tuple[list[str], list[int], list[int]]:
        """(stretches that both sides spell, ids of all of them on either side)."""
        # a space between two of these is one that texts may be cut at
        plain = [s for s in stretches if s and not (s[0].isspace() or s[-1].isspace())]
        odd = set(stretches).difference(plain)
        parts = [plain[i:i + ENCODED_AT_ONCE] for i in range(0, len(plain), ENCODED_AT_ONCE)]
        kept: list[str] = []
        a: list[int] = []
        b: list[int] = []
        for part in parts:
            x, y = self.encoded(part)
            if self.spells(part, x, y):
                kept += part
                a += x
                b += y
            else:
                odd.update(part)
        for one in odd:
            x, y = self.encoded([one])
            if self.spells([one], x, y):
                kept.append(one)
                a += x
                b += y
        return kept, a, b


def _tokens(ids: list[int], size: np.ndarray, stretch_ends: np.ndarray) -> pd.DataFrame:
    """Tokens of stretches that stand one after the other: stretch, id, start."""
    flat = np.array(ids, np.int64)
    start = np.cumsum(size[flat]) - size[flat]
    return pd.DataFrame({"stretch": np.searchsorted(stretch_ends, start, "right"), "id": flat, "start": start})


def _covering(one: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
    """Each token of one side with the start of the token of the other side that covers its start."""
    theirs = pd.DataFrame({"stretch": other["stretch"], "start": other["start"], "cover_start": other["start"]})
    return pd.merge_asof(one, theirs, on="start", by="stretch")


def _distinct(groups: np.ndarray, ids: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, id) with how often each occurs."""
    keys, counts = np.unique(groups * base + ids, return_counts=True)
    return keys // base, keys % base, counts


def _linked(stretch_of: np.ndarray, a: tuple, b: tuple) -> pd.DataFrame:
    """Per stretch and pair of ids in one group: in how many links it stands."""
    (ga, ia, ca), (gb, ib, cb) = a, b
    first, many = np.unique(gb, return_index=True, return_counts=True)[1:]
    times = many[ga]
    at = np.repeat(first[ga] - np.cumsum(times) + times, times) + np.arange(times.sum())
    rows = pd.DataFrame({"stretch": stretch_of[np.repeat(ga, times)], "pair": np.repeat(ia, times) << 32 | ib[at],
                         "links": np.repeat(ca, times) * cb[at]})
    return rows.groupby(["stretch", "pair"], sort=True, as_index=False)["links"].sum()


@dataclass
class Aligned:
    """Stretches cut into groups.  ``counts`` has a row for each of n_a, n_b, n_groups, n_overlaps and
    n_links; ``groups`` are texts, each group with ``;`` behind it; ``pairs`` and their ``links``
    stand stretch after stretch, ``sizes`` many of each."""

    stretches: list[str]
    counts: np.ndarray
    groups: list[str]
    sizes: np.ndarray
    pairs: np.ndarray
    links: np.ndarray

    def remembered(self, which: set) -> Iterator[tuple]:
        ends = np.cumsum(self.sizes)
        for i, stretch in enumerate(self.stretches):
            if stretch in which:
                held = slice(ends[i] - self.sizes[i], ends[i])
                yield stretch, (*self.counts[:, i].tolist(), self.groups[i], self.pairs[held].tobytes(),
                                self.links[held].tobytes())

    @classmethod
    def recalled(cls, stretches: list[str], known: list[tuple]) -> Aligned:
        count = len(known)
        return cls(stretches, np.array([k[:5] for k in known], np.int64).reshape(count, 5).T, [k[5] for k in known],
                   np.fromiter((len(k[6]) // 8 for k in known), np.int64, count),
                   np.frombuffer(b"".join([k[6] for k in known]), np.int64),
                   np.frombuffer(b"".join([k[7] for k in known]), np.int64))

    def __add__(self, more: Aligned) -> Aligned:
        both = lambda name: np.concatenate([getattr(self, name), getattr(more, name)])
        return Aligned(self.stretches + more.stretches, np.concatenate([self.counts, more.counts], 1),
                       self.groups + more.groups, both("sizes"), both("pairs"), both("links"))


def align_stretches(pair: Pair, stretches: list[str]) -> Aligned:
    """Those of the stretches that both sides spell, cut into groups."""
    kept, a, b = pair.spelt(stretches)
    if not kept:
        return Aligned.recalled([], [])
    ends = np.cumsum([len(s.encode()) + 1 for s in kept])
    n = len(kept)
    ta, tb = _tokens(a, pair.a_size, ends), _tokens(b, pair.b_size, ends)
    over_a, over_b = _covering(ta, tb), _covering(tb, ta)
    # where both sides start together a group begins
    new_a, new_b = ((x["cover_start"] == x["start"]).to_numpy() for x in (over_a, over_b))
    ga, gb = np.cumsum(new_a) - 1, np.cumsum(new_b) - 1
    of_a, of_b = ta["stretch"].to_numpy(), tb["stretch"].to_numpy()
    per = lambda of, weights=None: np.bincount(of, weights, n).astype(np.int64)
    stretch_of = of_a[new_a]
    many_a, many_b = np.bincount(ga), np.bincount(gb)
    n_a, n_b, n_groups = per(of_a), per(of_b), per(stretch_of)
    # the union of both directions: tokens that start together are found by both
    counts = np.stack([n_a, n_b, n_groups, n_a + n_b - per(of_a[new_a]), per(stretch_of, many_a * many_b)])
    ids_a, ids_b = ta["id"].to_numpy(), tb["id"].to_numpy()
    rows = _linked(stretch_of, _distinct(ga, ids_a, len(pair.a_bytes)), _distinct(gb, ids_b, len(pair.b_bytes)))
    return Aligned(kept, counts, _spelt_groups(pair, ids_a, ids_b, ga, gb, np.cumsum(n_a + n_b)),
                   per(rows["stretch"].to_numpy()), rows["pair"].to_numpy(), rows["links"].to_numpy())


def _spelt_groups(pair: Pair, ids_a, ids_b, ga, gb, cuts) -> list[str]:
    """The groups of each stretch as text: a group's A ids, then its B ids, each with its sign behind it."""
    last_a, last_b = (np.append(g[1:] != g[:-1], True) for g in (ga, gb))
    tokens = np.empty(len(ids_a) + len(ids_b), object)
    before_b, upto_a = np.cumsum(np.bincount(gb)) - np.bincount(gb), np.cumsum(np.bincount(ga))
    tokens[np.arange(len(ga)) + before_b[ga]] = pair.a_names[last_a.astype(int), ids_a]
    tokens[np.arange(len(gb)) + upto_a[gb]] = pair.b_names[last_b.astype(int), ids_b]
    flat = tokens.tolist()
    return ["".join(flat[lo:hi]) for lo, hi in zip([0, *cuts[:-1].tolist()], cuts.tolist())]


class Batch:
    """The documents of one batch, put together from their stretches."""

    def __init__(self, numbers: list[int], texts: list[str | None], pair: Pair, memo: FrequentMemo):
        cut = [pair.stretches(t) if t else [] for t in texts]
        seen = Counter(chain.from_iterable(cut))
        known, missing = memo.find(set(seen))
        found = [s for s in seen if s not in missing]
        fresh = align_stretches(pair, list(missing))
        self.all = Aligned.recalled(found, [known[s] for s in found]) + fresh
        memo.add(fresh.remembered({s for s in fresh.stretches if seen[s] > 1 and len(s) <= KEPT_CHARS}))
        place = dict.fromkeys(missing, -1)
        place.update(zip(self.all.stretches, range(len(self.all.stretches))))
        sizes = [len(x) for x in cut]
        doc = np.repeat(np.arange(len(cut)), sizes)
        unit = np.fromiter(map(place.__getitem__, chain.from_iterable(cut)), np.int64, len(doc))
        # one stretch that is not spelt leaves the whole document without tokens
        whole = np.bincount(doc[unit < 0], minlength=len(cut)) == 0
        self.doc, self.unit = doc[whole[doc]], unit[whole[doc]]
        self.numbers = np.array(numbers, np.int64)
        self.counts = [np.bincount(self.doc, c[self.unit], len(cut)).astype(np.int64) for c in self.all.counts]
        units, at = unit.tolist(), 0
        self.groups = []
        for i, size in enumerate(sizes):
            of = self.all.groups
            self.groups.append("".join([of[u] for u in units[at:at + size]])[:-1] if whole[i] else "")
            at += size

    def linked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(pairs, offsets, documents, links): the documents that hold each pair, with their links."""
        ends = np.cumsum(self.all.sizes)
        times = self.all.sizes[self.unit]
        at = np.repeat((ends - self.all.sizes)[self.unit] - np.cumsum(times) + times, times) + np.arange(times.sum())
        pairs, code = np.unique(self.all.pairs, return_inverse=True)
        width = max(1, len(self.numbers))
        keys = code[at] * width + np.repeat(self.doc, times)
        order = np.argsort(keys)
        keys, first = np.unique(keys[order], return_index=True)
        links = np.add.reduceat(self.all.links[at][order], first) if len(keys) else self.all.links[:0]
        held, offsets = np.unique(keys // width, return_index=True)
        return pairs[held], np.append(offsets, len(keys)), self.numbers[keys % width], links


ROWS = ("n long, doc_id {kind}, n_a long, n_b long, n_groups long, n_overlaps long, n_links long, groups string, "
        "a int, b int, docs array<long>, links array<long>")


def alignments(docs: DataFrame, byte_path: str, piece_path: str, text: str = "text", doc_id: str = "doc_id"
               ) -> DataFrame:
    """Two kinds of rows: one for each document, with its groups, and one for each batch and pair of
    ids, with the documents that hold it and the links it has there.  ``a`` is null in the first kind.

    ``groups`` has the groups of a document joined by ``;``, in each the ids of both sides joined
    by ``,`` with ``|`` between the sides.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    chosen = docs.select(F.monotonically_increasing_id().alias("n"), F.col(doc_id).alias("doc_id"),
                         text_of(text).alias("text"))
    names = [c.strip().split(" ")[0] for c in ROWS.split(",")]

    def run(batches) -> Iterator[pa.RecordBatch]:
        pair = per_worker("pair", byte_path + piece_path, lambda: Pair(byte_path, piece_path))
        memo = per_worker("stretches", byte_path + piece_path, lambda: FrequentMemo(MEMO_STRETCHES))
        for batch, texts in batches_of_texts(batches, "text", BATCH_CHARS):
            made = Batch(batch.column("n").to_pylist(), texts, pair, memo)
            rows = len(texts)
            columns = [batch.column("n"), batch.column("doc_id"), *[pa.array(c) for c in made.counts],
                       pa.array(made.groups, pa.string()), *[pa.nulls(rows, pa.int32())] * 2,
                       *[pa.nulls(rows, pa.list_(pa.int64()))] * 2]
            yield pa.RecordBatch.from_arrays(columns, names)
            pairs, offsets, holders, links = made.linked()
            # pieces, so that no record batch grows with the batch of texts
            for lo in range(0, len(pairs), 20_000):
                hi = min(lo + 20_000, len(pairs))
                cut, lists = offsets[lo:hi + 1] - offsets[lo], slice(offsets[lo], offsets[hi])
                blank = [pa.nulls(hi - lo, c.type) for c in columns[:8]]
                yield pa.RecordBatch.from_arrays(
                    [*blank, pa.array((pairs[lo:hi] >> 32).astype(np.int32)),
                     pa.array((pairs[lo:hi] & 0xFFFFFFFF).astype(np.int32)),
                     *[pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(x[lists]))
                       for x in (holders, links)]], names)

    return chosen.mapInArrow(run, ROWS.format(kind=kind))


def align(docs: DataFrame, byte_path: str, piece_path: str, text: str = "text", doc_id: str = "doc_id",
          groups: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_overlaps, n_links, n_best, count_sum,
    groups (or ``groups_sha256`` with ``groups="digest"``).

    Side A encodes space+text with the byte-level tokenizer, side B the text with the piece model,
    which adds the space; special tokens inside texts are plain text.  Links are all pairs of an A
    and a B token in one group.  A pair of ids counts the documents (rows) that hold it linked;
    ``count_sum`` adds the counts of a document's links, ``n_best`` are the links whose count is the
    highest of their A id.

    Texts that are null, empty or not spelt by both sides have no tokens: zeros and empty groups.
    Repeated ids and rows are each answered and counted; an empty table gives an empty result;
    further columns are left out.
    """
    if groups not in ("text", "digest"):
        raise ValueError("groups must be 'text' or 'digest'")
    found = alignments(docs, byte_path, piece_path, text, doc_id)
    if groups == "digest":
        spelt = F.when(F.col("groups") != "", F.sha2("groups", 256)).otherwise(F.lit(""))
        found = found.withColumn("groups", spelt).withColumnRenamed("groups", "groups_sha256")
    kept = "groups" if groups == "text" else "groups_sha256"
    # encoded once; what follows is joined over this table
    found = stored(found, "aligned")
    pairs = found.where(F.col("a").isNotNull()).select("a", "b", "docs", "links")
    # no more rows than the vocabularies have pairs
    counts = stored(pairs.groupBy("a", "b").agg(F.sum(F.size("docs")).cast("long").alias("count")), "pair-counts")
    tops = counts.groupBy("a").agg(F.max("count").alias("top"))
    known = counts.join(tops, "a").select("a", "b", "count", (F.col("count") == F.col("top")).alias("best"))
    held = pairs.join(known, ["a", "b"]).select(
        "count", "best", F.explode(F.arrays_zip("docs", "links")).alias("d"))
    sums = held.groupBy(F.col("d.docs").alias("n")).agg(
        F.sum(F.when(F.col("best"), F.col("d.links"))).alias("n_best"),
        F.sum(F.col("d.links") * F.col("count")).alias("count_sum"))
    whole = found.where(F.col("n").isNotNull()).drop("a", "b", "docs", "links")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return whole.join(sums, "n", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_overlaps", "n_links", zero("n_best"), zero("count_sum"), kept)
