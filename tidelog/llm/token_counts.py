"""Token counts through a digest cache.

The cache is a table (content digest, tokenizer digest, tokens) in a folder.  Texts are joined
to it by the digest of their whole content and the digest of the tokenizer file; only distinct
texts that it does not hold are encoded, and their counts are appended.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import tokenizer as tk
from tidelog.llm.common import Memo, batches_of_texts, per_worker, stored, text_of
from tidelog.session import shared_folder

CACHE = "content binary, tokenizer string, n_tokens long"


def count_tokens(texts: DataFrame, path: str) -> DataFrame:
    """Rows (content, n_tokens) for rows (content, text); every text is encoded whole."""

    def run(batches):
        def fresh() -> Memo:
            loaded = tk.load(path)
            return Memo(lambda units: [len(e) for e in loaded.encode_batch_fast(units, add_special_tokens=False)],
                        tk.MEMO_UNITS)

        memo = per_worker("counts", path, fresh)
        for batch, chunk in batches_of_texts(batches, "text"):
            cut = [tk.space_led(t) for t in chunk]
            known = memo.learn(set().union(*cut))
            counts = [sum([known[u] for u in units]) for units in cut]
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(counts, pa.int64())],
                                             ["content", "n_tokens"])

    return texts.mapInArrow(run, "content binary, n_tokens long")


def token_counts(docs: DataFrame, path: str, cache: str | None = None, limit: int = 512,
                 text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit.

    Counts are those of the tokenizer file at ``path`` without added special tokens.  A null
    text counts as empty (0 tokens).  ``cache`` is a folder all executors share, kept between
    calls; without one the cache lives for this call.  Repeated texts, rows and ids are each
    answered; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    name = tk.version(path)
    content = F.unhex(F.sha2(text_of(text), 256))
    keyed = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"), content.alias("content"))
    folder = cache or shared_folder(spark, "token-cache")
    held = _cached(spark, folder).where(F.col("tokenizer") == name)
    fresh = keyed.join(held, "content", "left_anti") if cache else keyed
    # The first copy of a digest stands for all; copies fold before the shuffle.
    missing = fresh.select("content", "text").dropDuplicates(["content"])
    (count_tokens(missing, path).select("content", F.lit(name).alias("tokenizer"), "n_tokens")
     .write.mode("append").parquet(folder))
    held = _cached(spark, folder).where(F.col("tokenizer") == name).select("content", "n_tokens")
    # A writer that ran at the same time may have added the same text: its count is the same.
    # Stored, so that the join has its own shuffle, which can split a hot text's rows.
    held = stored(held.groupBy("content").agg(F.max("n_tokens").alias("n_tokens")), "counts")
    sized = keyed.select("doc_id", "content", F.octet_length("text").cast("long").alias("n_bytes"))
    return sized.join(held, "content").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _cached(spark, folder: str) -> DataFrame:
    """The cache as it stands; an empty folder is an empty cache."""
    spark.createDataFrame([], CACHE).write.mode("append").parquet(folder)
    return spark.read.schema(CACHE).parquet(folder)
