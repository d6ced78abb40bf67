import binascii
import math
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest

from tidelog.llm import language_id
from tidelog.llm.language_id import Lattice, Vocabulary, identify, learn

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PIECES)


def slow_total(vocabulary, word, chances):
    """The sum over all segmentations, one by one."""
    text = "▁" + word
    if not word:
        return 1.0

    def total(rest):
        if not rest:
            return 1.0
        out = 0.0
        for size in range(1, min(len(rest), vocabulary.longest) + 1):
            at = int(vocabulary.find(np.array([vocabulary._hash(rest[:size])], np.uint64))[0])
            if at < len(vocabulary.hashes) or size == 1:
                out += chances[at, 0] * total(rest[size:])
        return out

    return total(text)


def test_forward_sums_all_segmentations(vocabulary):
    rng = np.random.default_rng(1)
    chances = np.r_[rng.random((len(vocabulary.hashes), 1)), [[1e-3]]]
    words = ["a", "the", "nation", "Жßꀕx", "ing", "\U0001D400b"]
    found = Lattice(vocabulary, ["▁" + w for w in sorted(words, key=len)]).log_totals(chances)[:, 0]
    assert np.exp(found) == pytest.approx([slow_total(vocabulary, w, chances) for w in sorted(words, key=len)])


def exact_log_total(vocabulary, text, chances):
    """The same by dynamic programming over fractions, which cannot run out of range."""
    pieces = {int(h): i for i, h in enumerate(vocabulary.hashes)}
    sums = [Fraction(1)]
    for end in range(1, len(text) + 1):
        total = Fraction(0)
        for size in range(1, min(end, vocabulary.longest) + 1):
            at = pieces.get(vocabulary._hash(text[end - size:end]))
            if at is not None or size == 1:
                total += sums[end - size] * Fraction(float(chances[-1 if at is None else at, 0]))
        sums.append(total)
    return math.log(sums[-1].numerator) - math.log(sums[-1].denominator)


def test_long_runs_are_not_cut(vocabulary, monkeypatch):
    rng = np.random.default_rng(2)
    chances = np.r_[rng.random((len(vocabulary.hashes), 1)) * 1e-5, [[1e-8]]]
    words = ["▁information", "▁government" * 3, "▁" + "donaudampfschifffahrtsgesellschaft" * 4, "▁" + "ж中" * 90]
    assert max(map(len, words[:2])) > 10 and vocabulary.longest > 10
    exact = [exact_log_total(vocabulary, w, chances) for w in words]
    found = Lattice(vocabulary, words).log_totals(chances)[:, 0]
    assert found == pytest.approx(exact, rel=1e-12)
    for stretch in (1, 7, 16, 50, 4_096):
        monkeypatch.setattr(language_id, "STRETCH", stretch)
        found = [language_id.log_total_of_run(vocabulary, w, chances)[0] for w in words]
        assert found == pytest.approx(exact, rel=1e-12)
    # A word split over rescalings is still used up character by character.
    lattice = Lattice(vocabulary, words)
    uses, lengths = lattice.expected(chances, np.ones((len(words), 1))), np.zeros(len(chances))
    for _, size, _, pieces in lattice.edges:
        lengths[pieces] = size
    assert (uses[:, 0] * lengths).sum() == pytest.approx(sum(map(len, words)))


def test_long_runs_and_a_full_memo_change_nothing(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    scorer = language_id.Scorer(learn(docs, PIECES))
    texts = [r.text for r in docs.limit(40).collect()] + ["x" * 9_000, "nation" * 2_000 + " a"]
    whole = scorer(texts)
    monkeypatch.setattr(language_id, "MEMO_CHARS", 10)
    monkeypatch.setattr(language_id, "STRETCH", 20)
    scorer.forget()
    single = [scorer([t])[0] for t in texts]
    assert [w[0] for w in whole] == [s[0] for s in single]
    assert [w[1] for w in whole] == pytest.approx([s[1] for s in single])


def test_expected_uses_cover_every_character(vocabulary):
    words = ["▁the", "▁nation", "▁xyz"]
    chances = np.full((len(vocabulary.hashes) + 1, 1), 1e-3)
    lattice = Lattice(vocabulary, words)
    uses = lattice.expected(chances, np.array([[2.0], [1.0], [3.0]]))
    lengths = np.zeros(len(uses))
    for _, size, _, pieces in lattice.edges:
        lengths[pieces] = size
    assert (uses[:, 0] * lengths).sum() == pytest.approx(2 * 4 + 7 + 3 * 4)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = identify(docs, learn(docs, PIECES)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    assert all(r.held_out == (binascii.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_odd_rows(odd):
    model = learn(odd, PIECES)
    found = identify(odd, model).collect()
    assert Counter(r.doc_id for r in found) == Counter(r.doc_id for r in odd.collect())
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1, 2, 3))
    assert all(by_id[i].lang_pred in {"en", "de", "fr"} for i in (4, 5, 7, 10))
    assert identify(odd.limit(0), model).count() == 0
    nothing = learn(odd.limit(0), PIECES)
    assert {r.lang_pred for r in identify(odd, nothing).collect()} == {"und"}
