import numpy as np
from pyspark.sql import functions as F

from tidelog.llm import neighbours
from tidelog.llm.neighbours import nearest


def brute(rows, asks, k):
    ids = np.array([r[0] for r in rows])
    vectors = np.array([r[1] for r in rows], np.float64)
    out = {}
    for i, v in zip(ids, vectors):
        if asks(i):
            scores = (vectors * v).sum(axis=1)
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def listed(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(found, truth):
    assert found.keys() == truth.keys()
    return sum(len({v for v, _ in found[q]} & {v for v, _ in truth[q]}) for q in truth) / sum(map(len, truth.values()))


def test_recall_on_the_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    truth = brute([(r.vec_id, r.embedding) for r in vectors.collect()], lambda i: i % 20 == 0, 20)
    found = listed(nearest(vectors, F.col("vec_id") % 20 == 0))
    assert recall(found, truth) >= 0.95
    scores = {q: dict(t) for q, t in truth.items()}
    assert all(abs(s - scores[q][v]) < 1e-12 for q in found for v, s in found[q] if v in scores[q])


def test_other_norms_blocks_and_copies(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 50)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 7)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8))
    rows = [(i, (centres[i % 12] * rng.uniform(0.5, 3) + rng.normal(size=8) * 0.2).tolist()) for i in range(900)]
    rows += [(900 + i, [1.0] * 8) for i in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found, truth = listed(nearest(frame, F.col("vec_id") % 20 == 0, list_rows=40)), brute(rows, lambda i: i % 20 == 0, 20)
    assert recall(found, truth) >= 0.9
    # Equal scores come by id: among the copies, the smallest ids.
    assert [v for v, _ in found[1200]] == [v for v, _ in truth[1200]]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (20, [0.5, 0.5], 1), (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (40, [nan, 1.0], 1),
            (5, [inf, 1.0], 1), (6, [None, 1.0], 1), (7, [1.0, 2.0, 3.0], 1), (None, [1.0, 1.0], 1), (8, [2.0, 0.0], None),
            (8, [2.0, 0.0], None), (9, [-1.0, 0.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id int")
    found = listed(nearest(frame, F.col("vec_id") % 20 == 0))
    assert found == {0: [(8, 2.0), (20, 0.5), (9, -1.0)], 20: [(8, 1.0), (0, 0.5), (9, -0.5)]}
    assert nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest(frame.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_recall_over_hundreds_of_lists(spark):
    vectors = np.array([r.embedding for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()])
    rng = np.random.default_rng(1)
    many = np.concatenate([vectors + rng.normal(size=vectors.shape) * vectors.std() * 0.5 for _ in range(10)])
    rows = [(i, v.tolist()) for i, v in enumerate(many)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = listed(nearest(frame, F.col("vec_id") % 97 == 0, list_rows=40))
    assert recall(found, brute(rows, lambda i: i % 97 == 0, 20)) >= 0.9


def test_the_ratio_prunes_and_finds(spark):
    """By the lists alone, 20,000 vectors in 500 lists: what is entered, read and found."""
    vectors = np.array([r.embedding for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()])
    for noise in (0.5, 0.1):
        rng = np.random.default_rng(1)
        many = np.concatenate([vectors + rng.normal(size=vectors.shape) * vectors.std() * noise for _ in range(10)])
        longest = np.linalg.norm(many, axis=1).max() * (1 + 1e-12)
        lists = neighbours.Centroids(many[rng.permutation(len(many))[:10_000]], longest, -(-len(many) // 40), len(many))
        entered = lists.enter(many)
        sizes = np.bincount(np.concatenate(entered), minlength=len(lists.points))
        assert 1.001 * len(many) < sizes.sum() < 1.5 * len(many) and min(map(len, entered)) == 1
        for step in (97, 400):
            found, read = [], []
            for q in range(0, len(many), step):
                gone_to = lists.search(many[q], sizes)
                read.append(sizes[gone_to].sum() / len(many))
                scores = many @ many[q]
                scores[q] = -np.inf
                gone_to = set(gone_to)
                found += [not gone_to.isdisjoint(entered[v].tolist()) for v in np.argsort(-scores)[:20]]
            assert np.mean(found) >= 0.9 and np.mean(read) <= 0.65
