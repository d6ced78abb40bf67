"""BPE encoding and decoding with tree concatenation of long unsplit text.

White space always separates what this kind of tokenizer encodes, so a text is encoded by its
words.  A word longer than a leaf is cut into halves again and again; the leaves are encoded
as one parallel batch and concatenated pairwise up the tree.  At a join a window around it is
encoded anew and grows until it gives, on either side, a token the side has too (same id, same
characters).  Both sequences are valid on their own, validity is a property of neighbouring
tokens, and every neighbouring pair of the result stands in one of them: the result is exactly
what encoding the whole would give.  If no window agrees, the last one is the whole word.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

from tidelog.llm import tokenizer as tk
from tidelog.llm.common import FrequentMemo, batches_of_texts, per_worker

# Words up to this length, in characters, are encoded in one piece.
LEAF = 32
# Tokens taken on either side of a join at first; no fewer than an added token has characters, which
# is recognised only as a whole.
WINDOW = 16
Token = tuple[int, int, int]


def _tokens(encoding, offset: int) -> list[Token]:
    return [(i, offset + a, offset + b) for i, (a, b) in zip(encoding.ids, encoding.offsets, strict=True)]


def _clean(tokens: list[Token], at: int) -> bool:
    """Whether the token starts a character of its own (one character can be several tokens)."""
    return at == 0 or tokens[at - 1][2] <= tokens[at][1]


def _join(tokenizer, text: str, left: list[Token], right: list[Token], lo: int, hi: int) -> list[Token]:
    size = WINDOW
    while True:
        first, last = len(left) - size, size
        a = left[first][1] if first > 0 else lo
        b = right[last - 1][2] if last < len(right) else hi
        seam = _tokens(tokenizer.encode(text[a:b], add_special_tokens=False), a)
        if a == lo and b == hi:
            return seam
        head = (0, 0) if a == lo else _first_common(left, max(first, 0), seam)
        tail = (len(seam) - 1, len(right)) if b == hi else _last_common(seam, right, min(last, len(right)))
        if head and tail and head[1] <= tail[0]:
            return left[:head[0]] + seam[head[1]:tail[0] + 1] + right[tail[1]:]
        size *= 2


def _first_common(left: list[Token], start: int, seam: list[Token]) -> tuple[int, int] | None:
    places = {left[i]: i for i in range(start, len(left)) if _clean(left, i)}
    for j, token in enumerate(seam):
        if token in places and _clean(seam, j):
            return places[token], j
    return None


def _last_common(seam: list[Token], right: list[Token], end: int) -> tuple[int, int] | None:
    places = {right[i]: i for i in range(end) if _clean(right, i)}
    for j in range(len(seam) - 1, -1, -1):
        if seam[j] in places and _clean(seam, j):
            return j, places[seam[j]] + 1
    return None


def tree_encode(tokenizer, text: str, leaf: int = LEAF) -> list[int]:
    """Token ids of a text, by encoding its halves and concatenating them up the tree."""
    cuts = [0, len(text)]
    while max(b - a for a, b in zip(cuts, cuts[1:])) > leaf:
        cuts = sorted({*cuts, *((a + b) // 2 for a, b in zip(cuts, cuts[1:]))})
    spans = list(zip(cuts, cuts[1:]))
    parts = [_tokens(e, a) for e, (a, _) in zip(
        tokenizer.encode_batch([text[a:b] for a, b in spans], add_special_tokens=False), spans)]
    while len(spans) > 1:
        joined, covered = [], []
        for i in range(0, len(spans) - 1, 2):
            lo, hi = spans[i][0], spans[i + 1][1]
            joined.append(_join(tokenizer, text, parts[i], parts[i + 1], lo, hi))
            covered.append((lo, hi))
        if len(spans) % 2:
            joined.append(parts[-1])
            covered.append(spans[-1])
        parts, spans = joined, covered
    return [t[0] for t in parts[0]]


def _units(text: str) -> list[str]:
    return [w for w in text.replace("\n", " ").split(" ") if w]


def _learner(path: str) -> tuple[FrequentMemo, Callable]:
    """What frequent words gave, and how to learn others: (number of ids, ids, decoded text)."""
    loaded = tk.load(path)

    # What a token decodes to alone; those of a text are joined by spaces.
    decoded = [loaded.decode([i], skip_special_tokens=False) for i in range(loaded.get_vocab_size())]
    names = [str(i) for i in range(len(decoded))]

    def learn(units: list[str]) -> list[tuple[int, str, str]]:
        short = [u for u in units if len(u) <= LEAF]
        ids = dict(zip(short, (e.ids for e in loaded.encode_batch_fast(short, add_special_tokens=False))))
        ids |= {u: tree_encode(loaded, u) for u in units if len(u) > LEAF}
        found = [ids[u] for u in units]
        return [(len(i), " ".join([names[t] for t in i]), " ".join([decoded[t] for t in i])) for i in found]

    return FrequentMemo(tk.MEMO_UNITS), learn


def encode(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id",
           as_array: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids, decoded.

    ``ids`` are the decimal ids joined by one space (an array with ``as_array``), ``decoded``
    what they decode to with special tokens kept.  For tokenizers that drop white space and
    decode by joining tokens with a space.  A null text counts as empty: no ids, empty text.
    Repeated rows are each answered; an empty table gives an empty result.
    """
    kind = "array<int>" if as_array else "string"
    chosen = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))

    def run(batches):
        memo, learn = per_worker("encoded", path, lambda: _learner(path))
        for batch, chunk in batches_of_texts(batches, "text"):
            cut = [_units(t or "") for t in chunk]
            known, missing = memo.find(set().union(*cut))
            missing = list(missing)
            memo.add(zip(missing, learn(missing), strict=True))
            counts, ids, decoded = [], [], []
            for units in cut:
                n, some_ids, some_decoded = zip(*map(known.__getitem__, units)) if units else ((), (), ())
                counts.append(sum(n))
                ids.append(" ".join(filter(None, some_ids)))
                decoded.append(" ".join(filter(None, some_decoded)))
            out = pa.array([list(map(int, i.split())) for i in ids], pa.list_(pa.int32())) if as_array \
                else pa.array(ids, pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), out, pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids", "decoded"])

    return chosen.mapInArrow(run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, "
                                  f"n_tokens long, ids {kind}, decoded string")
