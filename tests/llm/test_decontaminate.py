import re
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidelog.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
ITEMS = [(1, "One two THREE four five six seven eight nine ten eleven"), (10, "seven eight nine"), (2, "Éa éa"),
         (3, None), (4, " .. "), (5, "éa ÉA x"), (None, "lonely item here"), (2, "b b"), (6, "word " * 10)]
DOCS = [(1, "x one Two three, four five six seven EIGHT nine ten! y", "a"), (2, "seven eight nine ten", "b"),
        (3, None, None), (4, "", "a"), (5, "...", "a"), (6, "éa ÉA x", "a"), (7, "Éa éa X", "a"), (8, "b b b b", "a"),
        (9, "see a lonely-item here", "a"), (None, "b b", "a"), (2, "seven eight nine ten", "b"), (11, "word " * 30000, "a"),
        (12, "one two three four five six seven", "a")]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, n=10):
    grams = {}
    for item, text in items:
        w = words(text)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            grams.setdefault(tuple(w[i:i + size]), set()).add(item)
    sizes = {len(g) for g in grams}
    out = Counter()
    for doc_id, text, *_ in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in grams:
                    hit.update(range(i, i + size))
                    found |= grams[tuple(w[i:i + size])]
        out[doc_id, len(w), len(hit), tuple(sorted(str(f) for f in found if f is not None)), bool(hit)] += 1
    return out


def told(df):
    return Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in df.collect())


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, words string").repartition(3)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("n", [10, 3, 1])
def test_equals_brute_force(docs, items, n):
    assert told(dc.decontaminate(docs, items, n)) == brute(DOCS, ITEMS, n)


def test_beyond_the_broadcast_bound(docs, items, monkeypatch):
    monkeypatch.setattr(dc, "BROADCAST_BYTES", 0)
    df = dc.decontaminate(docs, items)
    assert told(df) == brute(DOCS, ITEMS)


def test_equal_hashes_are_told_apart(docs, items, monkeypatch):
    monkeypatch.setattr(dc, "_hashed", lambda w: F.transform(w, lambda x: F.lit(5).cast("long")))
    few = docs.where("doc_id < 10")
    assert told(dc.decontaminate(few, items)) == brute([d for d in DOCS if d[0] and d[0] < 10], ITEMS)


def test_spans_and_documents_go(docs, items):
    got = {r.doc_id: r.cleaned for r in dc.decontaminate(docs, items, remove="spans").collect()}
    assert got[1] == "x! y" and got[2] == " ten" and got[3] == "" and got[5] == "..."
    assert got[9] == "see a" and got[8] == "" and got[12] == DOCS[12][1]
    kept = dc.decontaminate(docs, items, remove="documents", whole_rows=True)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 12]
    assert kept.where("doc_id = 5").first().row.asDict() == {"doc_id": 5, "text": "...", "words": "a"}


def test_nothing_to_look_for(docs, items):
    assert told(dc.decontaminate(docs, items.limit(0))) == brute(DOCS, [])
    assert dc.decontaminate(docs.limit(0), items).count() == 0
    with pytest.raises(ValueError):
        dc.decontaminate(docs, items, remove="all")
    with pytest.raises(ValueError):
        dc.decontaminate(docs, items, n=0)


def test_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = docs.select("doc_id", "text").collect()
    assert told(dc.decontaminate(docs, items)) == brute(rows, items.select("item_id", "text").collect())


def test_no_python_in_the_plan(docs, items):
    plan = dc.decontaminate(docs, items, remove="spans")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
