"""Approximate nearest neighbours with balanced posting lists.

Vectors are placed so that the largest inner product is the smallest distance: all are scaled
by the longest and get one more component that makes their lengths equal.  Centroids fitted on
a bounded sample head the posting lists.  A vector near a boundary is entered in several lists,
those whose distance is within a ratio of the nearest; a list beyond a number of rows is cut into
blocks.  A query searches a graph of the centroids held in memory and goes to all lists within a
distance ratio of its nearest, or of the usual nearest distance if its own is less (a query that
sits on a centroid would find no other list within any ratio).  The ratio is fitted to the sample:
the least at which ``GOAL`` of the neighbours that rows of the sample have in it lie in lists the
ratio selects; of a sample that is a share of all rows, that share of the neighbours is looked for,
which are about as near as all of them among all rows.
The nearest few lists are scored first; of the others only rows that reach the ``k``-th score
found there come out, which loses nothing.
Blocks of lists meet blocks of queries in one task each, which scores them in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import stored

# Vectors the centroids are fitted on, at most, and centroids at most.
FIT_ROWS = 20_000
MOST_CENTROIDS = 2_048
# Rows a list should hold; rows and queries of one block.
LIST_ROWS = 256
BLOCK_ROWS, BLOCK_QUERIES = 4_096, 1_024
ROUNDS = 8
# A vector enters the lists up to this ratio of its nearest distance, and no more than these.
ENTER_RATIO, MOST_ENTERED = 1.005, 8
# The share of neighbours the search ratio is fitted to, rows of the sample it is fitted with, their neighbours.
GOAL, FIT_QUERIES, FIT_NEIGHBOURS = 0.97, 400, 20
# Vectors whose distances to all centroids are held at once, in the driver as in tasks.
AT_ONCE = 1_024
# Queries one task searches the graph for.
SEARCHED = 256
# Lists a query goes to at least, and rows they must hold together; beyond that the ratio alone decides.
LEAST_LISTS, LEAST_ROWS = 8, 1_000
LINKS = 16
SEED = 7


def usable(vector: Column) -> Column:
    """Neither null nor empty, all components finite, not all zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


def _raised(vectors: np.ndarray, longest: float) -> np.ndarray:
    scaled = vectors / longest
    rest = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1)))
    return np.c_[scaled, rest]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squared = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(squared, 0))


def _pieces(rows: np.ndarray) -> list[np.ndarray]:
    return [rows[i:i + AT_ONCE] for i in range(0, len(rows), AT_ONCE)]


class Centroids:
    """Centroids, and a graph that links each to its nearest, to those it is near to, and to one random other.

    Links go both ways: few centroids have the outer ones among their nearest, and no other way leads there.
    """

    def __init__(self, sample: np.ndarray, longest: float, count: int, rows: int | None = None) -> None:
        rng = np.random.default_rng(SEED)
        self.longest = longest
        points = np.unique(_raised(sample, longest), axis=0)
        count = max(1, min(count, len(points)))
        self.points = points[rng.choice(len(points), count, replace=False)]
        for _ in range(ROUNDS):
            nearest = np.concatenate([_distances(p, self.points).argmin(axis=1) for p in _pieces(points)])
            held = np.bincount(nearest, minlength=count)
            sums = np.zeros_like(self.points)
            np.add.at(sums, nearest, points)
            full = held > 0
            self.points[full] = sums[full] / held[full][:, None]
            # An empty list takes over a point of the fullest one.
            for empty in np.flatnonzero(~full):
                self.points[empty] = points[rng.choice(np.flatnonzero(nearest == held.argmax()))]
        between = _distances(self.points, self.points)
        linked = np.zeros((count, count), bool)
        for at, row in enumerate(between):
            linked[at, np.r_[np.argsort(row)[1:LINKS + 1], rng.integers(count)]] = True
        self.linked = linked | linked.T
        self.start = int(between.sum(axis=1).argmin())
        self._fit_ratio(sample, len(sample) / (rows or len(sample)), rng)

    def _fit_ratio(self, sample: np.ndarray, share: float, rng: np.random.Generator) -> None:
        """``share`` of all rows are in the sample, and as many of the neighbours looked for."""
        picked = rng.choice(len(sample), min(FIT_QUERIES, len(sample)), replace=False)
        units = sample[picked] / np.linalg.norm(sample[picked], axis=1)[:, None]
        far = _distances(np.c_[units, np.zeros(len(picked))], self.points)
        self.usual = float(np.median(far.min(axis=1)))
        ratios = far / np.maximum(far.min(axis=1), self.usual)[:, None]
        held, near = min(max(1, round(FIT_NEIGHBOURS * share)), len(sample) - 1), []
        for at in picked:
            scores = sample @ sample[at]
            scores[at] = -np.inf
            near.append(np.argsort(-scores, kind="stable")[:held])
        lists = self.enter(sample[np.concatenate(near)])
        needed = [ratios[i // held, x].min() for i, x in enumerate(lists)]
        self.ratio = max(1.0, float(np.quantile(needed, GOAL))) if needed else 1.0

    def enter(self, vectors: np.ndarray) -> list[np.ndarray]:
        """The lists each vector is entered in, nearest first."""
        out = []
        for piece in _pieces(vectors):
            far = _distances(_raised(piece, self.longest), self.points)
            order = np.argsort(far, axis=1, kind="stable")[:, :MOST_ENTERED]
            near = np.take_along_axis(far, order, axis=1)
            held = (near <= ENTER_RATIO * near[:, :1]).sum(axis=1)
            out += [row[:n].copy() for row, n in zip(order, held)]
        return out

    def search(self, query: np.ndarray, sizes: np.ndarray) -> list[int]:
        """Lists for a query, nearest first: from near to near through the graph, pruned by distance ratio."""
        unit = np.r_[query / np.sqrt(query @ query), 0.0]
        count = len(self.points)
        far, known, followed = np.full(count, np.inf), np.zeros(count, bool), np.zeros(count, bool)
        fresh = np.array([self.start])
        while len(fresh):
            known[fresh] = True
            far[fresh] = np.linalg.norm(self.points[fresh] - unit, axis=1)
            # All centroids within the ratio are followed, and the nearest ones until they hold enough.
            order = np.flatnonzero(known)
            order = order[np.argsort(far[order], kind="stable")]
            lists = order[:self._wanted(far[order], sizes[order])]
            ahead = lists[~followed[lists]]
            followed[ahead] = True
            fresh = np.flatnonzero(self.linked[ahead].any(axis=0) & ~known)
        if sizes[lists].sum() < min(LEAST_ROWS, int(sizes.sum())):
            return list(range(count))
        return lists.tolist()

    def _wanted(self, far: np.ndarray, sizes: np.ndarray) -> int:
        """How many of the lists, nearest first, a query goes to."""
        near = far <= self.ratio * max(far[0], self.usual)
        held = np.cumsum(sizes) - sizes
        return int((near | (np.arange(len(far)) < LEAST_LISTS) | (held < LEAST_ROWS)).sum())


def fit(vectors: DataFrame, list_rows: int = LIST_ROWS, limit: int = FIT_ROWS) -> Centroids | None:
    """Centroids from ``limit`` vectors at most, chosen by a hash of their id."""
    rows, longest = vectors.agg(
        F.count("*"), F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)))).first()
    if not rows:
        return None
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(limit).select("vector").toArrow()
    return Centroids(_matrix(sample["vector"].combine_chunks()), longest * (1 + 1e-12),
                     min(MOST_CENTROIDS, -(-rows // list_rows)), rows)


def nearest(vectors: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id",
            vector: str = "embedding", list_rows: int = LIST_ROWS) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the ``k`` nearest found of each query.

    ``queries`` is a condition on the rows of ``vectors``; candidates are all rows but the
    query's own.  Nearest is the largest inner product, in double precision, ties to the smaller
    id.  Vectors that are null, empty, zero, or hold null or non-finite components take no part,
    nor do rows without an id or of another length than the longest common one.  Rows with one id
    are one candidate, the best of them, and one query.  Fewer candidates than ``k`` all come
    back; an empty table gives an empty result.
    """
    picked = vectors.where(F.col(vec_id).isNotNull() & usable(F.col(vector))).select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"),
        queries.alias("asks"))
    width = picked.groupBy(F.size("vector").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    rows = stored(picked.where(F.size("vector") == (width["w"] if width else 0)), "vectors")
    centroids = fit(rows, list_rows)
    result = "query_id long, vec_id long, score double"
    if centroids is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def enter(batches):
        for batch in batches:
            lists = centroids.enter(_matrix(batch.column("vector"))) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vector"), pa.array(
                [x.tolist() for x in lists], pa.list_(pa.int32()))], ["id", "vector", "lists"])

    entered = rows.select("id", "vector").mapInArrow(enter, "id long, vector array<double>, lists array<int>")
    postings = stored(entered.select("id", "vector", F.explode("lists").alias("list")), "postings")
    # One row per list, and never more lists than MOST_CENTROIDS.
    sizes = np.zeros(len(centroids.points), np.int64)
    for r in postings.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]

    def ask(batches):
        for batch in batches:
            lists = [centroids.search(q, sizes) for q in _matrix(batch.column("vector"))] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vector"), pa.array(
                lists, pa.list_(pa.int32()))], ["id", "vector", "lists"])

    asks = rows.where("asks")
    parts = max(1, -(-asks.count() // SEARCHED))
    asked = asks.repartition(parts, "id").dropDuplicates(["id"]).select("id", "vector")
    asked = stored(asked.mapInArrow(ask, "id long, vector array<double>, lists array<int>").select(
        "id", "vector", F.posexplode("lists").alias("at", "list")), "asked")

    def score(queries: pa.Table, block: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if queries.num_rows and block.num_rows:
            found = _best(queries, block, k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), found)))

    def scored(asked: DataFrame) -> DataFrame:
        """Rows (query_id, vec_id, score) of the lists asked for that reach the query's ``floor``."""
        counts = np.zeros(len(sizes), np.int64)
        for r in asked.groupBy("list").count().collect():
            counts[r["list"]] = r["count"]
        row_blocks, query_blocks = (np.maximum(1, -(-n // most)).tolist()
                                    for n, most in ((sizes, BLOCK_ROWS), (counts, BLOCK_QUERIES)))

        def blocked(df: DataFrame, own: list[int], other: list[int], mine: str, theirs: str) -> DataFrame:
            """Each row once for every block of the other side its block has to meet."""
            mine_of, theirs_of = (F.element_at(F.lit(x), F.col("list") + 1) for x in (own, other))
            return df.withColumn(mine, F.pmod(F.xxhash64("id"), mine_of.cast("long")).cast("int")).withColumn(
                theirs, F.explode(F.sequence(F.lit(0), theirs_of - 1)))

        left = blocked(asked, query_blocks, row_blocks, "q", "r")
        right = blocked(postings, row_blocks, query_blocks, "r", "q")
        hits = left.groupBy("list", "q", "r").cogroup(right.groupBy("list", "q", "r")).applyInArrow(score, result)
        return hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))

    first = stored(scored(asked.where(F.col("at") < LEAST_LISTS).drop("at").withColumn(
        "floor", F.lit(float("-inf")))), "first")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    floors = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select(
        F.col("query_id").alias("id"), F.col("score").alias("floor"))
    others = asked.where(F.col("at") >= LEAST_LISTS).drop("at").join(floors, "id", "left").withColumn(
        "floor", F.coalesce("floor", F.lit(float("-inf"))))
    hits = first.unionByName(scored(others))
    hits = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _best(queries: pa.Table, block: pa.Table, k: int) -> list[np.ndarray]:
    asked = queries["id"].combine_chunks().to_numpy()
    ids = block["id"].combine_chunks().to_numpy()
    floors = queries["floor"].combine_chunks().to_numpy()
    a, b = _matrix(queries["vector"].combine_chunks()), _matrix(block["vector"].combine_chunks())
    rough = a @ b.T
    rough[asked[:, None] == ids[None]] = -np.inf
    # Matrix products differ in the last bits by position; what is kept is scored row by row.
    slack = 1e-9 * (np.abs(a).max() * np.abs(b).max() * a.shape[1] + 1)
    out = [[], [], []]
    for at, row in enumerate(rough):
        least = max(floors[at], np.partition(row, -k)[-k] if len(row) > k else -np.inf)
        near = np.flatnonzero((row >= least - slack) & (row > -np.inf))
        exact = (b[near] * a[at]).sum(axis=1)
        order = np.lexsort((ids[near], -exact))
        # Copies of a row under one id count once.
        _, first = np.unique(ids[near][order], return_index=True)
        order = order[np.sort(first)][:k]
        out[0].append(np.full(len(order), asked[at]))
        out[1].append(ids[near][order])
        out[2].append(exact[order])
    return [np.concatenate(x) for x in out]
