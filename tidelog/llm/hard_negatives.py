"""Hard negatives by rotated one-bit codes with stored alignments.

Vectors are turned by a random orthogonal matrix and coded by the signs of their coordinates; the
alignment of vector and code is stored with it.  What a code leaves over is coded the same way after
another rotation, ``CODES`` times, and the length of the last rest is kept.  An anchor keeps its
turned coordinates in ``PLANES`` bit planes, so that popcounts of planes and codes, weighted with the
alignments, estimate an inner product.  By the Cauchy-Schwarz inequality it lies within

    |anchor| |last rest| + the sum over codes of |code| |what the planes leave of the anchor|

of the estimate: a certain interval, not a likely one.  Pairs whose interval can neither reach
the best found nor the wanted range are left out; the others are scored exactly, in integers.

Rows are dealt into groups of a bounded size; every anchor visits every group, streamed past its
rows.  What a group passes on is a few rows for each anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import stored

SEED = 7
# One-bit codes of a row; bit planes of an anchor's coordinates.
CODES, PLANES = 6, 7
# Bytes of vectors a group of rows may hold, and pairs looked at in one step.
GROUP_BYTES = 32 << 20
PAIRS_AT_ONCE = 2_000_000
# Groups are no smaller than this many rows.
LEAST_ROWS = 1_024

Matrix = np.ndarray


def rotations(dims: int) -> list[Matrix]:
    """A random orthogonal matrix for each code; they depend on the size alone."""
    rng = np.random.default_rng(SEED)
    return [np.linalg.qr(rng.standard_normal((dims, dims)))[0] for _ in range(CODES)]


def _length(v: Matrix) -> Matrix:
    return np.sqrt((v * v).sum(-1))


class Coded:
    """Vectors (rows of ``v``) as one-bit codes: ``bits`` and ``align`` per code, and the last rest."""

    def __init__(self, v: Matrix, turns: list[Matrix]):
        self.v, self.norm = v, _length(v)
        rest, bits, align = v, [], []
        for turn in turns:
            turned = rest @ turn.T
            up = turned >= 0
            align.append(np.abs(turned).mean(1))
            rest = rest - (np.where(up, 1.0, -1.0) * align[-1][:, None]) @ turn
            bits.append(np.packbits(up, axis=1).view(np.uint64))
        self.bits, self.align, self.rest = bits, align, _length(rest)


class Anchors:
    """Vectors as bit planes of their turned coordinates, which are ``least + step * number``."""

    def __init__(self, v: Matrix, turns: list[Matrix]):
        self.v, self.norm, self.sides = v, _length(v), []
        for turn in turns:
            turned = v @ turn.T
            least = turned.min(1, initial=0.0)
            step = np.maximum((turned.max(1, initial=0.0) - least) / (2 ** PLANES - 1), 1e-300)
            number = np.rint((turned - least[:, None]) / step[:, None]).astype(np.int64)
            planes = [np.packbits((number >> b & 1).astype(bool), axis=1).view(np.uint64) for b in range(PLANES)]
            left = _length(turned - least[:, None] - step[:, None] * number)
            self.sides.append((least, step, planes, number.sum(1), left))


def intervals(a: Anchors, who: slice, b: Coded, rows: Matrix) -> tuple[Matrix, Matrix]:
    """(least, most) inner product of some anchors with the given rows."""
    dims = a.v.shape[1]
    estimate = np.zeros((len(a.norm[who]), len(rows)))
    error = a.norm[who, None] * b.rest[rows][None]
    for (least, step, planes, total, left), bits, align in zip(a.sides, b.bits, b.align, strict=True):
        bits, align = bits[rows], align[rows]
        ones = np.bitwise_count(bits).sum(1, dtype=np.int64)
        met = np.zeros(estimate.shape, np.int32)
        for p, plane in enumerate(planes):
            for w in range(bits.shape[1]):
                met += np.bitwise_count(plane[who, w, None] & bits[:, w][None]).astype(np.int32) << p
        # signs are twice the bits less one
        signed = least[who, None] * (2.0 * ones - dims)[None] + step[who, None] * (2.0 * met - total[who, None])
        estimate += align[None] * signed
        error += left[who, None] * (align * dims ** 0.5)[None]
    # what rounding can add
    error += 1e-9 * (a.norm[who, None] * b.norm[rows][None] + 1.0)
    return np.ceil(estimate - error), np.floor(estimate + error)


def exact_scores(a: Matrix, b: Matrix) -> list[int]:
    """Integer inner products of paired rows."""
    top = np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * a.shape[1]
    if top < 2.0 ** 53:
        return np.einsum("ij,ij->i", a, b).astype(np.int64).tolist()
    return [sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for p, q in zip(a, b, strict=True)]


class Group:
    """The rows of one group, gathered from record batches."""

    def __init__(self, batches: list[pa.RecordBatch], dims: int, turns: list[Matrix]):
        take = lambda c: [x for b in batches for x in b.column(c).to_pylist()]
        self.n, self.ids, labels = take("n"), take("vec_id"), take("label")
        v = np.frombuffer(b"".join(take("v")), np.float64).reshape(-1, dims)
        self.coded = Coded(v, turns)
        self.place = {n: i for i, n in enumerate(self.n)}
        by_label: dict = {}
        for i, label in enumerate(labels):
            by_label.setdefault(label, []).append(i)
        self.by_label = {label: np.array(at) for label, at in by_label.items()}
        self.labels = np.zeros(len(labels), np.int64)
        for code, at in enumerate(self.by_label.values()):
            self.labels[at] = code
        self.code_of = {label: code for code, label in enumerate(self.by_label)}


def _first(found: list[tuple], limit: int) -> list[tuple]:
    """Best scores first, ties by smaller id."""
    return sorted(found, key=lambda f: (-f[0], f[1], f[2]))[:limit]


def _kth_largest(lows: Matrix, k: int) -> Matrix:
    """The k-th largest of each row, minus infinity where there are fewer."""
    if lows.shape[1] < k:
        return np.full(len(lows), -np.inf)
    return -np.partition(-lows, k - 1, axis=1)[:, k - 1]


def nearest_alike(group: Group, anchors: list[dict], coded: Anchors, limit: int) -> Iterator[dict]:
    """For each anchor the first ``limit`` other rows of its label within the group."""
    lo = 0
    while lo < len(anchors):
        # anchors come sorted by label
        label, hi = anchors[lo]["label"], lo
        rows = group.by_label.get(label)
        step = max(1, PAIRS_AT_ONCE // len(rows)) if rows is not None else len(anchors)
        while hi < len(anchors) and anchors[hi]["label"] == label and hi - lo < step:
            hi += 1
        part, lo = range(lo, hi), hi
        if rows is None:
            continue
        low, high = intervals(coded, slice(part.start, part.stop), group.coded, rows)
        for p, i in enumerate(part):
            me = group.place.get(anchors[i]["n"])
            if me is not None:
                at = np.searchsorted(rows, me)
                low[p, at] = high[p, at] = -np.inf
        reach = (high >= _kth_largest(low, limit)[:, None]) & (high > -np.inf)
        yield from _scored(group, anchors, coded, part, rows, reach, lambda anchor: ((0, None, None),), limit)


def nearest_unlike(group: Group, anchors: list[dict], coded: Anchors, limit: int, least: int, most: int
                   ) -> Iterator[dict]:
    """For each anchor and each of its positives the first ``limit`` rows of other labels in range.

    In range is what scores from ``least`` to ``most`` percent of the positive.
    """
    rows = np.arange(len(group.n))
    step = max(1, PAIRS_AT_ONCE // max(1, len(rows)))
    for lo in range(0, len(anchors), step):
        part = range(lo, min(lo + step, len(anchors)))
        low, high = intervals(coded, slice(part.start, part.stop), group.coded, rows)
        reach = np.zeros(low.shape, bool)
        for p, i in enumerate(part):
            unlike = group.labels != group.code_of.get(anchors[i]["label"], -1)
            for positive in anchors[i]["positives"]:
                floor, ceiling = positive["score"] * least / 100, positive["score"] * most / 100
                may = unlike & (high[p] >= floor) & (low[p] <= ceiling)
                sure = low[p][may & (low[p] >= floor) & (high[p] <= ceiling)]
                if len(sure) >= limit:
                    may &= high[p] >= np.partition(sure, len(sure) - limit)[len(sure) - limit]
                reach[p] |= may

        def ranges(anchor):
            return [(at, positive["score"] * least, positive["score"] * most)
                    for at, positive in enumerate(anchor["positives"])]

        yield from _scored(group, anchors, coded, part, rows, reach, ranges, limit)


def _scored(group: Group, anchors: list[dict], coded: Anchors, part: range, rows: Matrix, reach: Matrix,
            ranges, limit: int) -> Iterator[dict]:
    """Score the pairs that are left and pick the first of each range."""
    for p, i in enumerate(part):
        left = rows[np.nonzero(reach[p])[0]]
        if not len(left):
            continue
        scores = exact_scores(np.broadcast_to(coded.v[i], (len(left), coded.v.shape[1])), group.coded.v[left])
        found = [(s, group.ids[r], group.n[r]) for s, r in zip(scores, left.tolist(), strict=True)]
        for at, least, most in ranges(anchors[i]):
            fit = found if least is None else [f for f in found if least <= 100 * f[0] <= most]
            for score, vec_id, n in _first(fit, limit):
                yield {"anchor": anchors[i]["n"], "at": at, "vec_id": vec_id, "n": n, "score": score}


FOUND = "anchor long, at int, vec_id long, n long, score long"


def _pass(rows: DataFrame, anchors: DataFrame, groups: int, dims: int, find) -> DataFrame:
    """``find(group, anchors, coded)`` for every group of rows and all anchors, streamed past it."""
    dealt = rows.withColumns({"g": F.pmod(F.xxhash64("n"), F.lit(groups)).cast("int"), "kind": F.lit(0)})
    visiting = anchors.withColumns({"g": F.explode(F.sequence(F.lit(0), F.lit(groups - 1))), "kind": F.lit(1)})
    both = dealt.unionByName(visiting, allowMissingColumns=True)
    both = both.repartition(groups, "g").sortWithinPartitions("g", "kind", "label", "n")
    fields = ["anchor", "at", "vec_id", "n", "score"]

    def run(batches):
        turns = rotations(dims)
        now, held, group = None, [], None
        for batch in batches:
            g, kind = batch.column("g").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero(np.diff(g.astype(np.int64) * 2 + kind)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                part = batch.slice(int(lo), int(hi - lo))
                if hi == lo:
                    continue
                if g[lo] != now:
                    now, held, group = g[lo], [], None
                if kind[lo] == 0:
                    held.append(part)
                    continue
                if group is None:
                    group = Group(held, dims, turns) if held else None
                    held = []
                if group is None:
                    continue
                visitors = part.to_pylist()
                v = np.frombuffer(b"".join([a["v"] for a in visitors]), np.float64).reshape(-1, dims)
                made = list(find(group, visitors, Anchors(v, turns)))
                if made:
                    yield pa.RecordBatch.from_pylist(made, schema=pa.schema([
                        (f, pa.int32() if f == "at" else pa.int64()) for f in fields]))

    return both.mapInArrow(run, FOUND)


def _ranked(found: DataFrame, keys: list[str], limit: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id", "n")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def vectors_of(df: DataFrame, anchor: Column, label: Column | str, vec_id: str, vector: str, scale: int
               ) -> tuple[DataFrame, int]:
    """Rows that take part (n, vec_id, label, anchor, v: scaled integers as doubles) and their width."""
    label = F.col(label) if isinstance(label, str) else label
    rows = df.select(F.monotonically_increasing_id().alias("n"), F.col(vec_id).cast("long").alias("vec_id"),
                     label.cast("string").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
                     F.col(vector).cast("array<double>").alias("x"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()
                      & ~F.exists("x", bad))
    widest = rows.agg(F.max(F.size("x"))).first()[0] or 0
    dims = max(64, -(-widest // 64) * 64)

    def scaled(batches):
        for batch in batches:
            lists = batch.column("x")
            sizes = np.diff(lists.offsets.to_numpy())
            out = np.zeros((batch.num_rows, dims))
            out[np.arange(dims)[None] < sizes[:, None]] = np.floor(scale * lists.flatten().to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("n", "vec_id", "label", "anchor")],
                 pa.array([r.tobytes() for r in out], pa.binary())], ["n", "vec_id", "label", "anchor", "v"])

    return rows.mapInArrow(scaled, "n long, vec_id long, label string, anchor boolean, v binary"), dims


def mine(df: DataFrame, anchor: Column, label: Column | str = "label", positives: int = 5, negatives: int = 5,
         least: int = 80, most: int = 100, scale: int = 256, vec_id: str = "vec_id",
         vector: str = "embedding") -> DataFrame:
    """One row per anchor, positive and negative: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    Components become ``floor(scale * x)``; scores are integer inner products, higher first, ties
    by smaller id.  An anchor's positives are its first other rows of the same label; negatives
    of a positive are the first rows of other labels that score ``least`` to ``most`` percent
    of it.  All of them, if there are fewer.

    Rows with a null id, label or vector, or a null, NaN or infinite component take no part.
    Shorter vectors count as filled with zeros.  Rows that repeat an id are rows of their own
    (equal in rank, told apart by where they stand), and an anchor row meets all but itself.
    Scores beyond a long stop the job.  No anchors, one label or no rows give an empty result.
    """
    if min(positives, negatives) < 1:
        raise ValueError("at least one positive and one negative are needed")
    rows, dims = vectors_of(df, anchor, label, vec_id, vector, scale)
    rows = stored(rows, "scaled-vectors")
    groups = _groups(rows, dims)
    visitors = rows.where("anchor").drop("anchor")
    rows = rows.drop("anchor")
    alike = _pass(rows, visitors, groups, dims,
                  lambda group, who, coded: nearest_alike(group, who, coded, positives))
    first = _ranked(alike, ["anchor"], positives).groupBy(F.col("anchor").alias("n")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives"))
    known = stored(visitors.join(first, "n"), "anchors")
    unlike = _pass(rows, known, groups, dims,
                   lambda group, who, coded: nearest_unlike(group, who, coded, negatives, least, most))
    told = known.select(F.col("n").alias("anchor"), F.col("vec_id").alias("anchor_id"), "positives")
    best = _ranked(unlike, ["anchor", "at"], negatives).withColumnRenamed("vec_id", "negative_id")
    met = F.get("positives", F.col("at"))
    return best.join(told, "anchor").select(
        "anchor_id", met["vec_id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"), "negative_id",
        met["score"].alias("positive_score"), F.col("score").alias("negative_score"))


def _groups(rows: DataFrame, dims: int) -> int:
    """Groups so that one fits a task, and all tasks have some where there are rows enough."""
    n = rows.count()
    spark = rows.sparkSession
    fit = -(-n * dims * 8 // GROUP_BYTES)
    spread = min(int(spark.conf.get("spark.sql.shuffle.partitions")), n // LEAST_ROWS)
    return max(1, fit, spread)
