import hashlib
import random
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

from tidelog.llm import bpe
from tidelog.llm.token_counts import token_counts
from tidelog.llm.tokenizer import load, space_led

BYTE_BPE, WORD_BPE = (public_tokenizers.path(f"{x}.json") for x in ("byte_bpe_50k", "word_bpe_49k"))


def random_texts(n, seed=1):
    rng = random.Random(seed)
    alphabet = ["a", "b", "ab", "the", "'s", "'", "'t", "re", "12", "7", "é", "é", "́", " ", "  ", "\n", "\t ",
                " ", " ", "\x1c", "\x85", "\U0001F600", "<|endoftext|>", "<|endof", "!!", "-", "Σ", "İ", "漢字", "​"]
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(n)]


def test_units_encode_as_the_text_does():
    tokenizer = load(BYTE_BPE)
    for text in random_texts(3000):
        ids = [i for u in space_led(text) for i in tokenizer.encode(u, add_special_tokens=False).ids]
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_encode_as_the_text_does():
    tokenizer = load(WORD_BPE)
    for text in random_texts(3000):
        ids = [i for u in bpe._units(text) for i in tokenizer.encode(u, add_special_tokens=False).ids]
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_tree_equals_the_whole():
    rng = random.Random(3)
    for path in (WORD_BPE, BYTE_BPE):
        tokenizer = load(path)
        for text in random_texts(400, 7) + ["a" * 500, "ab" * 300, "é" * 200, "'s" * 200, "!" * 333, "1" * 100,
                                            "".join(rng.choices("aehnt'!é", k=2000)), "thethe" * 100 + "<|endoftext|>" * 9]:
            for leaf in (1, 3, 17):
                assert bpe.tree_encode(tokenizer, text, leaf) == tokenizer.encode(
                    text, add_special_tokens=False).ids, repr(text)


def test_encode_agrees_with_the_library(odd, documents):
    plain = Tokenizer.from_file(WORD_BPE)
    for docs in (odd, documents):
        expected = Counter()
        for r in docs.collect():
            ids = plain.encode(r.text or "", add_special_tokens=False).ids
            expected[r.doc_id, len(ids), " ".join(map(str, ids)), plain.decode(ids, skip_special_tokens=False)] += 1
        assert Counter(map(tuple, bpe.encode(docs, WORD_BPE).collect())) == expected
    assert bpe.encode(odd.limit(0), WORD_BPE).count() == 0
    row = bpe.encode(odd.where("doc_id = 11"), WORD_BPE, as_array=True).first()
    assert row.ids == plain.encode("two words", add_special_tokens=False).ids


def test_counts_agree_with_the_library(spark, odd, documents, tmp_path):
    plain = Tokenizer.from_file(BYTE_BPE)
    for docs in (odd, documents):
        expected = Counter()
        for r in docs.collect():
            n = len(plain.encode(r.text or "", add_special_tokens=False).ids)
            expected[r.doc_id, len((r.text or "").encode()), n, n > 512] += 1
        cache = str(tmp_path / "cache")
        assert Counter(map(tuple, token_counts(docs, BYTE_BPE, cache).collect())) == expected
        held = spark.read.parquet(cache).count()
        assert Counter(map(tuple, token_counts(docs, BYTE_BPE, cache).collect())) == expected
        assert spark.read.parquet(cache).count() == held
    assert held == len({hashlib.sha256((r.text or "").encode()).digest()
                        for d in (odd, documents) for r in d.collect()})
    assert token_counts(odd.limit(0), BYTE_BPE).count() == 0


def test_long_words_are_joined_up_the_tree(spark, monkeypatch):
    """The operator's own leaf size occurs in the documents, and windows grow where sides disagree."""
    tokenizer, sizes = load(WORD_BPE), []
    plain = bpe._join
    monkeypatch.setattr(bpe, "_join", lambda *a: sizes.append(a[5] - a[4]) or plain(*a))
    words = {u for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").where(
        "text rlike '[^ \\n]{33,}'").collect() for u in bpe._units(r.text or "") if len(u) > bpe.LEAF}
    assert words
    for word in [*words, "the" * 3000, "ab!" * 999]:
        assert bpe.tree_encode(tokenizer, word) == tokenizer.encode(word, add_special_tokens=False).ids
    assert len(sizes) > 300 and max(sizes) == 9000
