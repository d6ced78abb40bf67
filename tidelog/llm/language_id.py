"""Language ID by unigram pieces, summed over all segmentations.

Each language has its own probabilities for the pieces of a fixed public vocabulary.  The
probability of a word is the sum over every way to segment it into pieces, which a forward
pass gives; a text's is the product over its words.  The probabilities are learned by
expectation maximisation with the matching backward pass.  Distinct words are worked on
together, position by position, and remembered.

A word is a whole run of letters, of any length: sums are rescaled every few positions, so they
stay within a double's range, and a very long run goes through the pass in stretches that hand
over the sums of the last positions.  All pieces of the vocabulary take part.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import batches_of_texts, per_worker

# Documents of each language the probabilities are learned from, at most, by a hash of the id.
FIT_DOCS = 300
# Parts a language is ranked in before the whole of it.
RANKS = 64
ROUNDS = 4
# Positions of a word after which its sums are rescaled.
RESCALED = 8
# Letters of a run that are worked on at once; the fit, a sample, takes longer runs in parts.
STRETCH = 4_096
# What a single character that is no piece counts for, in every language.
UNKNOWN = 1e-8
# What remembered words may take, in characters; a word counts some more than its own.
MEMO_CHARS, WORD_COSTS = 10_000_000, 8
# Words worked on together, and their positions.
BATCH, BATCH_CELLS = 8_192, 200_000
_WORDS = re.compile(r"[^\W\d_]+")
_MARK = "\u2581"
_BASE = np.uint64(0x9E3779B97F4A7C15)
UND = "und"


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def _has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def _batches(texts: list[str]) -> Iterator[list[str]]:
    """Texts, sorted by length, in runs that bound both their number and their positions."""
    start = 0
    for end in range(1, len(texts) + 1):
        if end == len(texts) or end - start == BATCH or (end + 1 - start) * len(texts[end]) > BATCH_CELLS:
            yield texts[start:end]
            start = end


def _hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix hashes of texts, their lengths, and powers of the base."""
    length = max(map(len, texts))
    codes = np.zeros((len(texts), length), np.uint64)
    for i, t in enumerate(texts):
        codes[i, :len(t)] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    prefix = np.zeros((len(texts), length + 1), np.uint64)
    power = np.array([pow(int(_BASE), i, 1 << 64) for i in range(length + 1)], np.uint64)
    for i in range(length):
        prefix[:, i + 1] = prefix[:, i] * _BASE + codes[:, i] + np.uint64(1)
    return prefix, np.array([len(t) for t in texts]), power


class Vocabulary:
    """The pieces of a public vocabulary file, found by the hash of their characters."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {model.id_to_piece(i) for i in range(model.get_piece_size())
                  if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        self.longest = max(map(len, pieces))
        self.hashes = np.array(sorted(map(self._hash, pieces)), np.uint64)

    @staticmethod
    def _hash(piece: str) -> int:
        value = 0
        for char in piece:
            value = (value * int(_BASE) + ord(char) + 1) % (1 << 64)
        return value

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece numbers; the number of pieces where there is none."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, len(self.hashes))


class Lattice:
    """All segmentations of some texts: for each end and length the piece found there.

    Of the first ``known`` positions nothing is looked up: their sums are handed to ``forward``.
    """

    def __init__(self, vocabulary: Vocabulary, texts: list[str], known: int = 0) -> None:
        prefix, self.lengths, power = _hashes(texts)
        self.none, self.longest, self.known = len(vocabulary.hashes), vocabulary.longest, known
        self.edges = []
        for end in range(known + 1, prefix.shape[1]):
            alive = np.flatnonzero(self.lengths >= end)
            for size in range(1, min(end, self.longest) + 1):
                found = vocabulary.find(prefix[alive, end] - prefix[alive, end - size] * power[size])
                rows = alive if size == 1 else alive[found < self.none]
                if len(rows):
                    self.edges.append((end, size, rows, found if size == 1 else found[found < self.none]))

    def forward(self, chances: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Sums over all segmentations of each beginning; ``chances``: a row per piece, one for none.

        The sums a later position may still need are divided by the last one every ``RESCALED``
        positions, for texts that go on; ``self.scales`` keeps the divisors, ``self.shift`` the sum
        of their logarithms.  So sums are comparable within one such stretch only.
        """
        alpha = np.zeros((self.lengths.max() + 1, len(self.lengths), chances.shape[1]))
        alpha[:self.known + 1] = 1 if before is None else before
        self.shift, self.scales, last = np.zeros(alpha.shape[1:]), {}, self.known
        for end, size, rows, pieces in self.edges:
            if end != last and last % RESCALED == 0 and last > self.known:
                on = np.flatnonzero(self.lengths > last)
                scale = np.ones_like(self.shift)
                scale[on] = alpha[last, on]
                alpha[max(0, last + 1 - self.longest):last + 1] /= scale
                self.scales[last] = scale
                self.shift += np.log(scale)
            last = end
            alpha[end, rows] += alpha[end - size, rows] * chances[pieces]
        return alpha

    def log_totals(self, chances: np.ndarray) -> np.ndarray:
        alpha = self.forward(chances)
        return np.log(alpha[self.lengths, np.arange(len(self.lengths))]) + self.shift

    def expected(self, chances: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece, for texts that occur ``counts`` times in each language."""
        alpha = self.forward(chances)
        beta = np.zeros_like(alpha)
        at = np.arange(len(self.lengths))
        beta[self.lengths, at] = counts / alpha[self.lengths, at]
        uses, last = np.zeros_like(chances), alpha.shape[0]
        for end, size, rows, pieces in reversed(self.edges):
            # Undo the rescaling in the order it was done, back to front.
            while last > end:
                last -= 1
                if last in self.scales:
                    # Positions a rescaling touched were stored divided; what reaches them from behind is, too.
                    window = slice(max(0, last + 1 - self.longest), last + 1)
                    alpha[window] *= self.scales[last]
                    beta[window] /= self.scales[last]
            through = beta[end, rows] * chances[pieces]
            np.add.at(uses, pieces, alpha[end - size, rows] * through)
            beta[end - size, rows] += through
        return uses


def log_total_of_run(vocabulary: Vocabulary, text: str, chances: np.ndarray) -> np.ndarray:
    """The log of the sum over all segmentations of one long text, a stretch at a time."""
    before, total, done = None, 0.0, 0
    while done < len(text):
        known = min(done, vocabulary.longest)
        lattice = Lattice(vocabulary, [text[done - known:done + STRETCH]], known)
        alpha = lattice.forward(chances, before)
        done = min(len(text), done + STRETCH)
        # Sums of the last positions, divided by the last one.
        keep = min(done, vocabulary.longest)
        tail = alpha[-keep - 1:] if keep < len(alpha) else alpha
        last = tail[-1:].copy()
        total = total + lattice.shift + np.log(last[0])
        before = tail / last
    return total[0]


class Model:
    """Piece probabilities by language and the share of each language."""

    def __init__(self, path: str, counts: dict[str, Counter], shares: dict[str, float]) -> None:
        self.path, self.languages = path, sorted(counts)
        vocabulary = Vocabulary(path)
        size, langs = len(vocabulary.hashes), len(self.languages)
        self.shares = np.log([shares[x] for x in self.languages])
        words = sorted(set().union(*counts.values()), key=lambda w: (len(w), w))
        parts = list(_batches(words))
        lattices = [(Lattice(vocabulary, [_MARK + w for w in p]), np.array([[counts[x][w] for x in self.languages] for w in p], float))
                    for p in parts]
        self.chances = self._normal(np.ones((size, langs)))
        for _ in range(ROUNDS):
            uses = sum(lattice.expected(self.chances, held) for lattice, held in lattices)
            self.chances = self._normal((uses[:-1] if len(parts) else np.ones((size, langs))) + 0.01)
        self.chances = self.chances.astype(np.float64)

    def _normal(self, uses: np.ndarray) -> np.ndarray:
        return np.vstack([uses / uses.sum(axis=0), np.full((1, uses.shape[1]), UNKNOWN)])


class Scorer:
    """Log-probabilities of words by language, remembered in a growing table."""

    def __init__(self, model: Model) -> None:
        self.model, self.vocabulary = model, Vocabulary(model.path)
        self.forget()

    def forget(self) -> None:
        self.known, self.chars, self.table = {}, 0, np.zeros((0, len(self.model.languages)))

    def learn(self, words: set[str]) -> None:
        fresh = sorted(words.difference(self.known), key=len)
        if self.chars + sum(map(len, fresh)) + WORD_COSTS * len(fresh) > MEMO_CHARS:
            self.forget()
            fresh = sorted(words, key=len)
        short = bisect_right(fresh, STRETCH, key=len)
        found = [Lattice(self.vocabulary, [_MARK + w for w in part]).log_totals(self.model.chances)
                 for part in _batches(fresh[:short])]
        found += [log_total_of_run(self.vocabulary, _MARK + w, self.model.chances)[None] for w in fresh[short:]]
        self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh)), strict=True))
        self.chars += sum(map(len, fresh)) + WORD_COSTS * len(fresh)
        self.table = np.concatenate([self.table, *found])

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        cut = [words_of(t) for t in texts]
        self.learn(set().union(*cut))
        out = []
        for text, words in zip(texts, cut):
            if not words or not self.model.languages or not _has_letter(text):
                out.append((UND, 0.0))
                continue
            sums = self.model.shares + self.table[[self.known[w] for w in words]].sum(axis=0)
            odds = np.exp(sums - sums.max())
            best = int(np.argmax(odds))
            out.append((self.model.languages[best], float(odds[best] / odds.sum())))
        return out


def held_out(doc_id: str):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, path: str, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
          limit: int = FIT_DOCS) -> Model:
    """The model of all languages named by documents that are not held out.

    Language shares count all of those documents; the pieces are learned from ``limit`` of each
    language at most, from their whole texts.
    """
    taught = docs.where(F.col(lang).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id))
    taught = taught.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    shares = {r["lang"]: r["count"] for r in taught.groupBy("lang").count().collect()}
    chosen = taught.select("id", "lang", F.pmod(F.hash("id"), F.lit(RANKS)).alias("part"))
    # The first of a language are among the first of each part, so no task ranks a whole language.
    for keys in (("lang", "part"), ("lang",)):
        order = Window.partitionBy(*keys).orderBy(F.xxhash64("id"), "id")
        chosen = chosen.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= limit)
    # At most ``limit`` rows of each language: small, whatever the input.
    sample = taught.join(F.broadcast(chosen.select("id", "lang").distinct()), ["id", "lang"])

    def run(batches):
        for batch, texts in batches_of_texts(batches, "text"):
            for language, body in zip(batch.column("lang").to_pylist(), texts):
                held = Counter(w[i:i + STRETCH] for w in words_of(body) for i in range(0, len(w), STRETCH))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(held), pa.string()), pa.array(list(held), pa.string()),
                     pa.array(list(held.values()), pa.int64())], ["lang", "word", "n"])

    counts: dict[str, Counter] = {x: Counter() for x in shares}
    told = sample.select("lang", "text").mapInArrow(run, "lang string, word string, n long")
    for row in told.groupBy("lang", "word").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[row["lang"]][row["word"]] += row["n"]
    total = sum(shares.values())
    return Model(path, counts, {x: n / total for x, n in shares.items()})


def identify(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    The prediction reads the whole text and nothing else; ``score`` is its posterior
    probability.  A text that is null or has no letter, and any text if no language was
    learned, is ``und`` with score 0.  Repeated rows are each answered, an empty table gives an
    empty result; a row without an id counts as not held out, but teaches nothing.
    """
    key = uuid.uuid4().hex
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        scorer = per_worker("languages", key, lambda: Scorer(model))
        for batch, texts in batches_of_texts(batches, "text"):
            found = scorer(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), held_out(doc_id).alias("held_out"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
