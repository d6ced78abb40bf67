import math
from collections import defaultdict

from pyspark.sql import functions as F

from tidelog.llm.quality import STRENGTH, _strength, classify, fit

FOLDER = "/root/testdata/sf0.01"


def judge(docs, labels, **more):
    return classify(docs, labels, F.col("source"), F.col("lang"), **more)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = judge(docs, labels.where("doc_id % 3 != 0")).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    assert len(found) > 50
    assert sum(r.good == bool(r.quality) for r in found) >= 0.97 * len(found)
    assert sum(not r.good for r in found if r.quality) <= 0.02 * len(found)


def test_rates_are_shrunk_sums(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = {r.doc_id: r for r in documents.collect()}
    found = judge(documents, labels).collect()
    host, path = defaultdict(list), defaultdict(list)
    for r in found:
        d = rows[r.doc_id]
        host[d.source].append(r.evidence)
        path[d.source, d.lang].append(r.evidence)
    mean = sum(r.evidence for r in found) / len(found)
    for r in found:
        d = rows[r.doc_id]
        # Every rate lies between its group's own (without the document) and the level above.
        for rate, group, above in ((r.host_rate, host[d.source], mean),
                                   (r.path_rate, path[d.source, d.lang], r.host_rate)):
            own = (sum(group) - r.evidence) / (len(group) - 1) if len(group) > 1 else above
            assert min(own, above) - 1e-9 <= rate <= max(own, above) + 1e-9
        odds = sum(math.log(p / (1 - p)) for p in (r.evidence, r.path_rate)) - math.log(mean / (1 - mean))
        assert abs(r.score - 1 / (1 + math.exp(-odds))) < 1e-9


def test_a_repeated_id_counts_once_in_the_fit(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    once, often = fit(documents, labels), fit(documents.union(documents).union(documents), labels)
    assert once.weights is not None and (once.weights == often.weights).all()


def test_odd_rows(spark, odd):
    kinds = "doc_id long, quality int, text string"
    labels = spark.createDataFrame([(1, 0, "x"), (2, None, "x"), (None, 1, "x"), (4, 1, "x"), (4, 0, "x"), (5, 7, "x"),
                                    (9, 1, None)], kinds)
    for told in (labels, labels.limit(0), labels.where("quality = 1")):
        found = judge(odd, told, whole_rows=True)
        assert found.select("row.*").columns == odd.columns
        assert found.count() == odd.count() and found.where("score IS NULL").count() == 0
        assert judge(odd.limit(0), told).count() == 0


def test_paths_are_measured_around_their_hosts(spark):
    """Hosts far apart whose paths agree give paths a strong prior, and paths that differ a weak one."""
    def groups(rates):
        rows = [(h, 500.0, 500.0 * r) for h, some in rates.items() for r in some]
        return spark.createDataFrame(rows, "host string, n double, good double")

    agreeing = groups({"a": [0.9] * 6, "b": [0.1] * 6})
    differing = groups({"a": [0.9, 0.1] * 3, "b": [0.8, 0.2] * 3})
    assert _strength(agreeing, "good", "n")[1] == STRENGTH[0]
    assert _strength(agreeing, "good", "n", "host")[1] == STRENGTH[1]
    assert _strength(differing, "good", "n", "host")[1] == STRENGTH[0]
