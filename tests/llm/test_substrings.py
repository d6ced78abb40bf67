import random
from collections import Counter

import numpy as np
import pytest

from tidelog.llm import substrings


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, kept) of each text, by counting every string."""
    raw = [(t or "").encode() for t in texts]
    starts = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 2, bool)
        for i in range(len(r) - length + 1):
            if starts[r[i:i + length]] > 1:
                gone[i + 1:i + 1 + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum())
        out.append((len(r), int(gone.sum()), spans, bytes(c for c, g in zip(r, gone[1:]) if not g)))
    return out


def check(docs, **options):
    rows = docs.collect()
    length = options.get("length", 200)
    expected = Counter((r.doc_id, *b) for r, b in zip(rows, brute([r.text for r in rows], length)))
    found = substrings.remove_repeats(docs, **options).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == expected
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in found)


def test_suffix_array_is_sorted():
    rng = random.Random(2)
    for letters in ("a", "ab", "abcd"):
        strings = ["".join(rng.choices(letters, k=rng.randint(12, 60))).encode() for _ in range(30)]
        text = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8) + np.uint8(1)
        begin = np.cumsum([0, *(len(s) + 1 for s in strings[:-1])])
        last = begin + [len(s) - 12 for s in strings]
        array = substrings.suffix_array(text, begin, last, 12)
        body = text.tobytes()
        keys = [body[i:i + 12] for i in array]
        assert keys == sorted(keys) and len(set(array.tolist())) == len(array)
        assert set(array.tolist()) >= {i for a, b in zip(begin, last) for i in range(a, b + 1)}


@pytest.mark.parametrize("hot", [10_000, 1])
def test_short_strings_agree_with_brute_force(spark, hot):
    rng = random.Random(4)
    passage = "".join(rng.choices("abcdefgh ", k=60))
    texts = ["".join(rng.choices("ab", k=rng.randint(0, 60))) for _ in range(40)]
    texts += ["".join(rng.choices("abcdefghijk ", k=30)) + passage + "".join(rng.choices("abcdefghijk ", k=30))
              for _ in range(30)]
    texts += ["a" * 70, "aab" * 30, None, "", "é" * 40, passage, passage, passage[:40]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    check(docs, length=24, size=8, hot=hot)


def test_long_texts_in_parts(spark, monkeypatch):
    monkeypatch.setattr(substrings, "PART_BYTES", 64)
    rng = random.Random(5)
    texts = ["".join(rng.choices("abc", k=400)) for _ in range(4)] + ["xy" * 300, "q" * 500]
    texts += [texts[0][50:300] + "!" + texts[1][:200]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    check(docs, length=24, size=8)
    check(docs, length=24, size=8, hot=1)


def test_agrees_with_brute_force(odd, documents):
    check(odd)
    check(documents)
    assert substrings.remove_repeats(odd.limit(0)).count() == 0
