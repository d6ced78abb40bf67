import random
from collections import Counter
from itertools import accumulate

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidelog.llm import alignment as al

BYTE_BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pair():
    return al.Pair(BYTE_BPE, PIECES)


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    return lambda text: (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])


def cut(pair, text, a, b):
    """The groups of whole texts, by brute force."""
    spelt = (" " + text).encode() if text else b""
    if any(b"".join([side[i] for i in ids]) != spelt for side, ids in ((pair.a_bytes, a), (pair.b_bytes, b))):
        return []
    ends = [list(accumulate(len(side[i]) for i in ids)) for side, ids in ((pair.a_bytes, a), (pair.b_bytes, b))]
    both, out, last = sorted(set(ends[0]) & set(ends[1])), [], 0
    for end in both:
        out.append(tuple([i for i, e in zip(ids, es) if last < e <= end] for ids, es in zip((a, b), ends)))
        last = end
    return out


def brute(pair, library, docs):
    made, held = [], Counter()
    for doc_id, text in docs:
        groups = cut(pair, text, *library(text))
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        held.update(links.keys())
        made.append((doc_id, groups, links))
    top = Counter()
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    return Counter((
        doc_id, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups),
        sum(links.values()), sum(n for (x, y), n in links.items() if held[x, y] == top[x]),
        sum(n * held[p] for p, n in links.items()),
        ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)) for doc_id, groups, links in made)


def told(df):
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in df.collect())


def random_texts(n, seed=1):
    rng = random.Random(seed)
    bits = ["a", "b", "ab", "the", "'s", "'t", "re", "12", "7", "é", "́", " ", " ", "  ", "\n", "\t ", " ", "　",
            "\x1c", "\x85", "\x00", "\U0001F600", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "!!", "-", "漢字", "​", "ﬁ"]
    return ["".join(rng.choices(bits, k=rng.randint(0, 30))) for _ in range(n)]


def test_equals_brute_force_on_whole_texts(spark, pair, library):
    docs = [(i % 290, t) for i, t in enumerate(random_texts(300))]
    docs += [(1, None), (2, ""), (None, "a b"), (3, "▁x"), (4, "say ▁ it"), (5, " "), (6, "   "), (7, "z" * 3000),
             (8, "same text"), (9, "same text"), (9, "same text")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS a").repartition(3)
    assert told(al.align(df, BYTE_BPE, PIECES)) == brute(pair, library, docs)


def test_small_memo_and_batches(spark, pair, library, documents, monkeypatch):
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    monkeypatch.setattr(al, "MEMO_STRETCHES", 500)
    monkeypatch.setattr(al, "BATCH_CHARS", 20_000)
    monkeypatch.setattr(al, "KEPT_CHARS", 6)
    got = told(al.align(documents, BYTE_BPE, PIECES))
    assert got == brute(pair, library, docs)


def test_stretches_put_together_are_the_text(pair, library):
    for text in filter(None, random_texts(2000, 5)):
        a, b = library(text)
        parts = pair.stretches(text)
        assert " ".join(parts) == text
        one = [pair.encoded([p]) for p in parts]
        assert [i for x, _ in one for i in x] == a, repr(text)
        if cut(pair, text, a, b):
            assert [i for _, y in one for i in y] == b, repr(text)


def test_groups_come_from_merge_asof(pair, monkeypatch):
    words = ["unbelievable", "naïveté", "multiplicity"]
    whole = al.align_stretches(pair, words)
    assert max(whole.counts[3] - whole.counts[2]) > 0
    monkeypatch.setattr(al.pd, "merge_asof", lambda one, other, **_: one.assign(cover_start=one["start"]))
    with pytest.raises((IndexError, ValueError)):
        al.align_stretches(pair, words)


def test_digest_and_empty_table(documents):
    empty = documents.limit(0)
    assert al.align(empty, BYTE_BPE, PIECES, groups="digest").columns[-1] == "groups_sha256"
    assert al.align(empty, BYTE_BPE, PIECES).count() == 0
    with pytest.raises(ValueError):
        al.align(documents, BYTE_BPE, PIECES, groups="none")
