"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

A logistic model on cheap features of a text gives each document its evidence.  Grouped
aggregation over all documents gives every host and every path of a host its mean quality,
shrunk towards the level above it: a path towards its host, a host towards all documents.  How
much, the spread between groups tells (method of moments), so sparse sites follow the global
prior and only sites with much evidence of their own move a document.  A document's own
evidence is left out of its site's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import batches_of_texts, let_go, stored

# Labelled rows the document model is fitted on, at most.
FIT_ROWS = 20_000
# Bounds of the number of documents a prior counts for, and of any rate.
STRENGTH = (10.0, 1e6)
EDGE = 1e-4
FEATURES = 14


def features(text: str | None) -> list[float]:
    """What the words, characters and lines of a text look like; all zero for an empty text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * FEATURES
    held = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / len(raw)
    lines = raw.split(b"\n")
    return [np.log1p(len(words)), sum(map(len, words)) / len(words), len(set(words)) / len(words),
            sum(map(bytes.__eq__, words[1:], words)) / len(words), len(set(lines)) / len(lines), held[10],
            held[65:91].sum(), held[97:123].sum(), held[128:].sum(), held[48:58].sum(), held[33] + held[63],
            held[44] + held[46], held[35:39].sum() + held[42], held[124] + held[60] + held[62] + held[123] + held[125]]


class Model:
    """Logistic regression on standardised features; without labels of both kinds, a constant."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, rounds: int = 30) -> None:
        self.rate = (labels.sum() + 1) / (len(labels) + 2)
        self.weights = None
        if not 0 < labels.sum() < len(labels):
            return
        self.mean, self.scale = rows.mean(axis=0), rows.std(axis=0) + 1e-9
        x, w = self._scaled(rows), np.zeros(rows.shape[1] + 1)
        for _ in range(rounds):
            p = _logistic(x @ w)
            slope = x.T @ (labels - p) - np.r_[0, w[1:]]
            w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w)), slope)
        self.weights = w

    def _scaled(self, rows: np.ndarray) -> np.ndarray:
        return np.c_[np.ones(len(rows)), (rows - self.mean) / self.scale]

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(rows), self.rate)
        return np.clip(_logistic(self._scaled(rows) @ self.weights), EDGE, 1 - EDGE)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
        label: str = "quality", limit: int = FIT_ROWS) -> Model:
    """The document model, fitted on ``limit`` labelled ids at most, chosen by a hash of the id.

    Of documents that share an id, the one with the smallest features is taken.
    """
    told = (labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
            .groupBy(F.col(doc_id).alias("id")).agg(F.max(label).alias("label")))
    told = told.orderBy(F.xxhash64("id"), "id").limit(limit)
    chosen = docs.select(docs[doc_id].alias("id"), docs[text].alias("text")).join(F.broadcast(told), "id")

    def run(batches):
        for batch, texts in batches_of_texts(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array([features(t) for t in texts])],
                ["id", "label", "features"])

    held = chosen.select("id", "label", "text").mapInArrow(run, "id {}, label int, features array<double>".format(
        docs.schema[doc_id].dataType.simpleString()))
    # However often an id repeats, it counts once: no more rows than ``limit`` come back.
    held = held.groupBy("id").agg(F.max("label").alias("label"), F.min("features").alias("features")).toArrow()
    rows = np.array(held["features"].to_pylist(), dtype=float).reshape(-1, FEATURES)
    order = np.lexsort(rows.T)
    return Model(rows[order], np.array(held["label"].to_pylist(), dtype=float)[order])


def score_texts(docs: DataFrame, model: Model, text: str, out: str) -> DataFrame:
    """``docs`` with the document model's probability of good quality."""
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches):
        let_go()
        for batch, texts in batches_of_texts(batches, text):
            scores = model(np.array([features(t) for t in texts]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, out])

    return docs.mapInArrow(run, schema)


def _strength(groups: DataFrame, total: str, n: str, above: str | None = None) -> tuple[float, float]:
    """(mean rate of all, documents the prior counts for) from the spread of groups around what is above.

    Groups shrink toward the rate of all, or with ``above`` toward that of their own parent; the
    spread is measured around the same centre.
    """
    around = groups.groupBy(*([above] if above else [])).agg(
        F.count("*").alias("k"), F.sum(n).alias("docs"), F.sum(total).alias("good"),
        F.sum(F.col(n) * F.col(n)).alias("squares"),
        F.sum(F.col(total) * F.col(total) / F.col(n)).alias("spread")).where("docs > 0")
    rate = F.least(F.greatest(F.col("good") / F.col("docs"), F.lit(EDGE)), F.lit(1 - EDGE))
    own = rate * (1 - rate)
    docs, good, effective, spread, chance, variance = around.agg(
        F.sum("docs"), F.sum("good"), F.sum(F.col("docs") - F.col("squares") / F.col("docs")),
        F.sum(F.col("spread") - F.col("docs") * rate * rate), F.sum((F.col("k") - 1) * own),
        F.sum(F.col("docs") * own)).first()
    if not docs:
        return 0.5, STRENGTH[1]
    mean = min(max(good / docs, EDGE), 1 - EDGE)
    between = (spread - chance) / effective if effective > 1e-9 else 0
    return mean, min(max(variance / docs / between - 1, STRENGTH[0]), STRENGTH[1]) if between > 0 else STRENGTH[1]


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, text: str = "text",
             doc_id: str = "doc_id", label: str = "quality", threshold: float = 0.5,
             whole_rows: bool = False) -> DataFrame:
    """One row per input row: doc_id, evidence, host_rate, path_rate, score, good.

    ``host`` and ``path`` name a document's site; null is a site of its own.  ``score`` is the
    posterior probability of good quality: the text's odds times the odds of its site over
    those of all documents.  Null and empty texts have the features of no words.  Labels that
    are null or neither 0 nor 1 are left out, of repeated ones the better counts; without labels
    of both kinds every text has the same evidence.  An empty table gives an empty result.
    With ``whole_rows`` the input row comes along as a struct ``row``.
    """
    model = fit(docs, labels, text, doc_id, label)
    sites = [docs[doc_id].alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path")]
    if whole_rows:
        rows = score_texts(docs.select(F.struct("*").alias("row"), *sites), model, f"row.{text}", "evidence")
    else:
        rows = score_texts(docs.select(docs[text].alias("text"), *sites), model, "text", "evidence").drop("text")
    rows = stored(rows, "evidence")
    paths = stored(rows.groupBy("host", "path").agg(F.count("*").cast("double").alias("n"),
                                                    F.sum("evidence").alias("good")), "paths")
    hosts = paths.groupBy(F.col("host").alias("site")).agg(
        F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    mean, weight = _strength(hosts, "host_good", "host_n")
    _, path_weight = _strength(paths, "good", "n", "host")
    sites = stored(paths.join(hosts, F.col("host").eqNullSafe(F.col("site"))).select(
        "site", F.col("path").alias("part"), "n", "good", "host_n", "host_good"), "sites")
    joined = rows.join(sites, F.col("host").eqNullSafe(F.col("site")) & F.col("path").eqNullSafe(F.col("part")))
    own = F.col("evidence")
    host_rate = (F.col("host_good") - own + weight * mean) / (F.col("host_n") - 1 + weight)
    path_rate = (F.col("good") - own + path_weight * F.col("host_rate")) / (F.col("n") - 1 + path_weight)
    bounded = F.greatest(F.lit(EDGE), F.least(F.lit(1 - EDGE), F.col("path_rate")))
    odds = _logit(own) + _logit(bounded) - float(np.log(mean / (1 - mean)))
    scored = (joined.withColumn("host_rate", host_rate).withColumn("path_rate", path_rate)
              .withColumn("score", 1 / (1 + F.exp(-odds))))
    return scored.select("doc_id", "evidence", "host_rate", "path_rate", "score",
                         (F.col("score") >= threshold).alias("good"), *(["row"] if whole_rows else []))
