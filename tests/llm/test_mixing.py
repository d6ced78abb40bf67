from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidelog.llm.mixing import MOST, mix


def slow_targets(sizes):
    """Targets by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > MOST * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: MOST * sizes[s] for s in over}


def check(docs):
    rows = mix(docs).taken().select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += len((r.text or "").encode().split())
    assert len(rows) == docs.count() and sum(r.size for r in rows) == sum(sizes.values())
    expected, taken = slow_targets(dict(sizes)), Counter()
    for r in rows:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source])
        assert r.taken <= MOST * r.size and (not r.size or r.taken % r.size == 0)
    for source, target in expected.items():
        largest = max(r.size for r in rows if r.source == source)
        assert target - largest <= taken[source] <= target + 1e-6
    return rows


def test_targets_are_met(odd, documents):
    check(odd)
    assert sorted(map(tuple, check(documents)), key=str) == sorted(map(tuple, check(documents.repartition(5))), key=str)


def test_caps_reshare(spark):
    rows = [(i, "w " * 10, "a", 0) for i in range(3)] + [(10 + i, "v " * 50, "b", 0) for i in range(40)]
    check(spark.createDataFrame(rows, "doc_id long, text string, source string, row int"))


def test_shards_hold_every_copy_once(documents):
    made = mix(documents, shard_words=3_000, whole_rows=True)
    mixed = made.mixed().select("shard", "position", "row.*")
    assert mixed.columns[2:] == documents.columns
    copies = Counter(r.doc_id for r in mixed.collect())
    assert copies == Counter({r.doc_id: r.copies for r in made.taken().where("copies > 0").collect()})
    shards = mixed.groupBy("shard").agg(F.count("*").alias("n"), F.max("position").alias("last"),
                                        F.countDistinct("position").alias("places")).collect()
    assert len(shards) > 10 and all(s.n == s.last == s.places for s in shards)


def test_empty_table(odd):
    made = mix(odd.limit(0), whole_rows=True)
    assert made.taken().count() == 0 and made.mixed().count() == 0


def test_nothing_left_out_fits(spark):
    # One long document ends the whole blocks of "a"; small ones stand in the blocks behind it.
    rows = [(0, "w " * 60_000, "a")] + [(i, "w " * 1_000, "a") for i in range(1, 121)]
    rows += [(1_000 + i, "v " * 1_000, "b") for i in range(100)] + [(2_000 + i, "u " * 1_000, "c") for i in range(900)]
    for seed in range(3):
        made = mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), shard_words=50_000,
                   weights=(1.0, 2.0, 8.0), seed=seed, whole_rows=True)
        found = made.taken().select("doc_id", "source", "size", "source_size", "target", "copies").collect()
        for source in "abc":
            mine = [r for r in found if r.source == source]
            short = mine[0].target - sum(r.size * r.copies for r in mine)
            out = [r.size for r in mine if r.copies == mine[0].target // mine[0].source_size]
            assert 0 <= short + 1e-6 and (not out or short < min(out))
        copies = Counter(r.doc_id for r in made.mixed().select("row.doc_id").collect())
        assert copies == Counter({r.doc_id: r.copies for r in found if r.copies})
