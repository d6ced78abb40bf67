"""Benchmark decontamination with a broadcast hash set of test n-grams, in built-in functions only.

The windows of the benchmark (runs of ``n`` normalised words; a shorter item is one window) are
folded into distinct n-grams and keyed by a hash.  Every window of every training text is hashed
inside its row, the hashes are exploded and probe the set in the same generated code, and what
they find is compared word by word before it counts as a hit.  Only hits, and one row for each
document, are shuffled.

The set is broadcast while its measured size stays under ``BROADCAST_BYTES``; beyond it the same
join shuffles by hash, with hot hashes split by AQE.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored, text_of

# N-grams and their items, as UTF-8 with an allowance for each row, that are still broadcast.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 96
# What separates words, after and before A-Z are lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
CASED_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

REMOVE = ("nothing", "spans", "documents")


def words_of(text: Column) -> Column:
    """Words of a text, A-Z in lower case; null has none."""
    # ``lower`` would change other letters, too; where there are none it is the faster way
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(lowered, f"{GAP}+"), "")


def _hash_at(hashes: str, i: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(F.col(hashes), i + k) for k in range(size)])


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _window_hashes(sizes: list[int]) -> Column:
    """The hash of every window of each size, size after size, over ``__wh`` of ``__nw`` words."""
    def of(size: int) -> Column:
        starts = F.sequence(F.lit(0), F.col("__nw") - size)
        return F.when(F.col("__nw") >= size, F.transform(
            starts, lambda i: _hash_at("__wh", i, size))).otherwise(F.array().cast("array<bigint>"))

    return F.concat(*[of(size) for size in sizes])


def test_ngrams(benchmark: DataFrame, n: int, text: str = "text", item_id: str = "item_id"
                ) -> tuple[DataFrame, DataFrame]:
    """(distinct n-grams: gram, words, size, hash; the items that hold each: gram, item)."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(text)).alias("__w"))
    items = items.withColumn("size", F.least(F.size("__w"), F.lit(n))).where("size > 0")
    windows = items.select("item", "size", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("__w") - F.col("size") + 1),
        lambda i: F.slice("__w", i, F.col("size")))).alias("words"))
    windows = stored(windows.distinct(), "test-windows")
    grams = windows.select("words", "size").distinct().withColumn("gram", F.monotonically_increasing_id())
    grams = stored(grams.withColumn("__wh", _hashed(F.col("words"))).withColumn(
        "hash", _gram_hash(n)).drop("__wh"), "test-ngrams")
    return grams, stored(windows.join(grams, ["words", "size"]).select("gram", "item"), "test-items")


def _gram_hash(n: int) -> Column:
    out = None
    for size in range(1, n + 1):
        made = _hash_at("__wh", F.lit(0), size)
        out = F.when(F.col("size") == size, made) if out is None else out.when(F.col("size") == size, made)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text",
                  doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
                  remove: str = "nothing", whole_rows: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items (ids as strings, sorted by
    code point), contaminated; ``row`` with ``whole_rows``.

    ``remove="spans"`` adds ``cleaned``, the text without its hit words and what stands before
    each of them; ``remove="documents"`` leaves contaminated documents out.

    Null and wordless texts have no hits, and items without words no windows.  An item without
    an id counts for hits, not among the items.  Repeated ids and rows are each answered; equal
    items are named together.  An empty benchmark hits nothing, empty documents give an empty
    result, and further columns travel in ``row`` only.
    """
    if remove not in REMOVE:
        raise ValueError(f"remove must be one of {REMOVE}, got {remove!r}")
    if n < 1:
        raise ValueError("windows need at least one word")
    grams, holders = test_ngrams(benchmark, n, item_text, item_id)
    # at most n sizes
    sizes = sorted((r[0] for r in grams.select("size").distinct().collect()), reverse=True)
    of_row = {"doc_id": F.col(doc_id)}
    if whole_rows:
        of_row["row"] = F.struct("*")
    if remove == "spans":
        of_row["text"] = text_of(text)
    rows = docs.select(F.monotonically_increasing_id().alias("n"),
                       F.struct(*[c.alias(k) for k, c in of_row.items()]).alias("__doc"),
                       words_of(text_of(text)).alias("__w"))
    rows = rows.withColumn("__nw", F.size("__w")).withColumn("__wh", _hashed(F.col("__w")))
    # one more entry, which meets the empty n-gram below, stands for the document itself
    hashes = F.concat(_window_hashes(sizes), F.array(F.lit(0).cast("long"))) if sizes else \
        F.array(F.lit(0).cast("long"))
    # never empty; the outer form keeps Catalyst from pushing a copy of the hashing below itself
    probes = rows.withColumn("__hashes", hashes).select(
        "n", "__doc", "__w", "__nw", F.size("__hashes").alias("__entries"),
        F.posexplode_outer("__hashes").alias("__at", "hash"))
    spark = docs.sparkSession
    whole = spark.range(1).select(F.lit(None).cast("array<string>").alias("words"), F.lit(0).alias("size"),
                                  F.lit(None).cast("long").alias("gram"), F.lit(0).cast("long").alias("hash"))
    held = grams.unionByName(whole)
    near = F.broadcast if _small(grams, holders) else lambda df: df
    met = probes.join(near(held), "hash").where(_same(sizes)).withColumn("__from", _start(sizes))
    itself = F.col("size") == 0
    found = met.groupBy("n").agg(
        F.first(F.when(itself, F.struct("__doc", F.col("__nw").cast("long").alias("n_words"))), True).alias("d"),
        F.collect_set(F.when(~itself, F.struct(F.col("__from").alias("from"),
                                               (F.col("__from") + F.col("size")).alias("to")))).alias("spans"),
        F.collect_set("gram").alias("grams"))
    found = found.withColumn("runs", _runs(F.array_sort("spans"))).drop("spans")
    # still partitioned by document: no shuffle in what follows
    named = found.select("n", "d", "runs", F.explode_outer("grams").alias("gram")).join(
        near(holders), "gram", "left")
    listed = named.groupBy("n").agg(F.first("d").alias("d"), F.first("runs").alias("runs"),
                                    F.array_sort(F.collect_set("item")).alias("items"))
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["to"] - r["from"])
    out = listed.select(
        F.col("d.__doc.doc_id").alias("doc_id"), F.col("d.n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), "items", (F.size("runs") > 0).alias("contaminated"),
        *([F.col("d.__doc.row").alias("row")] if whole_rows else []),
        *([_without(F.col("d.__doc.text"), F.col("runs")).alias("cleaned")] if remove == "spans" else []))
    return out.where(~F.col("contaminated")) if remove == "documents" else out


def _small(grams: DataFrame, holders: DataFrame) -> bool:
    """Whether the n-grams and their items may be broadcast, by their counted bytes."""
    letters = F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.octet_length(w) + 16)
    sizes = grams.agg(F.sum(letters + ROW_BYTES)).first()[0], holders.agg(
        F.sum(F.coalesce(F.octet_length("item"), F.lit(0)) + ROW_BYTES)).first()[0]
    return max(x or 0 for x in sizes) <= BROADCAST_BYTES


def _offset(sizes: list[int], size: int) -> Column:
    """Windows that stand before those of a size in the list of a document's hashes."""
    out = F.lit(0)
    for s in sizes[:sizes.index(size)]:
        out = out + F.greatest(F.col("__nw") - s + 1, F.lit(0))
    return out


def _start(sizes: list[int]) -> Column:
    """The word a probe's window starts with."""
    out = F.when(F.col("size") == 0, F.lit(0))
    for s in sizes:
        out = out.when(F.col("size") == s, F.col("__at") - _offset(sizes, s))
    return out


def _same(sizes: list[int]) -> Column:
    """The probe's window is the n-gram itself, not only of equal hash."""
    start = _start(sizes)
    inside = (start >= 0) & (start + F.col("size") <= F.col("__nw"))
    equal = F.slice("__w", F.greatest(start, F.lit(0)) + 1, F.col("size")) == F.col("words")
    return F.when(F.col("size") == 0, F.col("__at") == F.col("__entries") - 1).otherwise(
        F.when(inside, equal).otherwise(False))


def _runs(spans: Column) -> Column:
    """Sorted spans put together into maximal runs."""
    run = "struct<from:int,to:int>"
    start = F.struct(F.array().cast(f"array<{run}>").alias("done"), F.lit(None).cast(run).alias("now"))
    now = lambda a, b: F.struct(a.cast("int").alias("from"), b.cast("int").alias("to"))

    def take(acc, s):
        joined = acc["now"].isNotNull() & (s["from"] <= acc["now"]["to"])
        return F.when(joined, F.struct(acc["done"].alias("done"), now(
            acc["now"]["from"], F.greatest(acc["now"]["to"], s["to"])).alias("now"))).otherwise(F.struct(
                F.when(acc["now"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["now"]))).alias("done"),
                now(s["from"], s["to"]).alias("now")))

    return F.aggregate(spans, start, take, lambda acc: F.when(acc["now"].isNull(), acc["done"]).otherwise(
        F.concat(acc["done"], F.array(acc["now"]))))


def _without(text: Column, runs: Column) -> Column:
    """A text without the words of the runs, each with the gap before it."""
    pieces = F.regexp_extract_all(text, F.lit(f"{CASED_GAP}*{CASED_WORD}+"), 0)
    tail = F.substring(text, F.char_length(F.array_join(pieces, "")) + 1, F.lit(2**31 - 1))
    kept = F.filter(pieces, lambda p, i: ~F.exists(runs, lambda r: (i >= r["from"]) & (i < r["to"])))
    return F.when(F.size(runs) == 0, text).otherwise(F.concat(F.array_join(kept, ""), tail))
