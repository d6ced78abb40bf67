import hashlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from test_exact_dedup import brute  # noqa: E402
from test_simhash import slow_components, slow_print  # noqa: E402

from tidelog.llm.queries import WORD_BPE  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_every_stage_against_brute_force(spark, documents):
    docs, seen = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == documents.columns
        rows = after.collect()
        seen.append((name, docs.collect(), rows))
        docs = spark.createDataFrame(rows, documents.schema)
    (_, given, good), (_, _, exact), (_, _, near), (_, _, mixed) = seen
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    stays = {r.doc_id for r in good}
    assert all((r.doc_id in stays) == bool(labels[r.doc_id]) for r in given if r.doc_id in labels)
    assert {r.doc_id for r in exact} == {k[0] for k in brute(good) if k[3]}
    prints = {r.doc_id: slow_print(r.text) for r in exact}
    roots, least = slow_components(set(prints.values())), {}
    for i, p in sorted(prints.items()):
        least.setdefault(roots[p], i)
    assert {r.doc_id for r in near} == set(least.values())
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in near}
    plain = Tokenizer.from_file(WORD_BPE)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    texts = {r.doc_id: r.text for r in mixed}
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in mixed)
    for r in out:
        ids = " ".join(map(str, plain.encode(texts[r.doc_id], add_special_tokens=False).ids))
        assert r.ids_sha256 == hashlib.sha256(ids.encode()).hexdigest()


def test_run_is_the_stages(spark):
    first = corpus_pipeline.run(spark, FOLDER)
    again = corpus_pipeline.run(spark, FOLDER)
    mark = F.bit_xor(F.xxhash64("doc_id", "n_tokens", "ids_sha256"))
    assert first.count() == again.count() > 0 and first.agg(mark).first() == again.agg(mark).first()
