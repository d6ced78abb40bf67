"""Exact dedup with an extendible-hash index kept on shared files.

Every text is normalised (white space ``[\\x20\\x09-\\x0D]`` deleted) and entered into an index
table under its 64-bit key.  A directory over the leading key bits is grown from the key
counts: a prefix that holds more than ``capacity`` entries is split by one more bit, so the
directory doubles until its buckets fit or ``MAX_DEPTH`` is reached.  What no further bit can
split (copies of one text) hangs in one chain.  Entries are shuffled by bucket and key; copies
are folded before the shuffle, and a chain is resolved by comparing the bytes of the texts
themselves, so two texts with one key stay apart.  Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import numbered, stored

# Entries one bucket may hold before it is split.
BUCKET_CAPACITY = 100_000
# The directory has at most 2 ** MAX_DEPTH entries of 16 bytes, which bounds its broadcast.
MAX_DEPTH = 20
WHITE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    for char in WHITE:
        text = F.replace(text, F.lit(char), F.lit(""))
    return text


def prefix(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int) -> DataFrame:
    """Rows (slot, bucket, depth): the bucket of every occupied slot at the full depth."""
    entries, full = keys.count(), 0
    while full < MAX_DEPTH and (capacity << full) < 16 * entries:
        full += 1
    slots = stored(keys.groupBy(prefix(F.col("key"), full).alias("slot")).count(), "slots")
    options = []
    for depth in range(full + 1):
        part = F.shiftright("slot", full - depth)
        options.append(slots.groupBy(F.lit(depth).alias("depth"), part.alias("part"))
                       .agg(F.sum("count").alias("held")))
    sized = options[0]
    for option in options[1:]:
        sized = sized.unionByName(option)
    # A slot belongs to the shallowest prefix that fits; the deepest is taken as it is.
    fits = sized.where((F.col("held") <= capacity) | (F.col("depth") == full))
    paths = slots.select("slot", F.explode(F.sequence(F.lit(0), F.lit(full))).alias("depth"))
    paths = paths.select("slot", "depth", F.expr(f"shiftright(slot, {full} - depth)").alias("part"))
    return (paths.join(fits, ["depth", "part"]).groupBy("slot")
            .agg(F.min(F.struct("depth", "part")).alias("bucket"))
            .select("slot", F.col("bucket.depth").alias("depth"),
                    F.col("bucket.part").alias("bucket"), F.lit(full).alias("full")))


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                capacity: int = BUCKET_CAPACITY, whole_rows: bool = False) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points in the original text stays, then the
    smallest ``doc_id`` (null last); of rows equal in these too, exactly one.  Ids are whole numbers or of
    any other type that sorts.  A null text
    counts as empty, and empty texts are equal to each other.  ``keep_id`` is null only if the
    row that stays has no id.  An empty table gives an empty result.  With ``whole_rows`` the
    input row comes along, as a struct ``row``; other columns never matter.
    """
    packed = numbered(docs)
    rank = _rank(docs.schema[doc_id].dataType)
    raw = F.coalesce(F.col("row")[text], F.lit(""))
    flat = packed.select("n", "row", F.col("row")[doc_id].alias("doc_id"), normalised(raw).alias("norm"),
                         F.length(raw).alias("chars"))
    # The index holds a text once: normalised, or in its row.
    index = stored(flat.select(
        "n", "doc_id", "chars", F.xxhash64("norm").alias("key"), F.unhex(F.sha2("norm", 256)).alias("digest"),
        "row" if whole_rows else "norm"), "index")
    slots = stored(directory(index.select("key"), capacity), "directory")
    depth = slots.select(F.max("full")).first()[0] or 0
    entries = index.withColumn("norm", normalised(raw)) if whole_rows else index
    entries = entries.drop("row").withColumn("slot", prefix(F.col("key"), depth)).join(
        F.broadcast(slots.select("slot", "depth", "bucket")), "slot")
    chains = (entries.groupBy("depth", "bucket", "key", "norm", "chars")
              .agg(F.count("*").alias("size"), F.min("doc_id").alias("first"),
                   F.min(rank).alias("best")))
    # Stored, so that the join below has its own shuffle, which can split a hot text's rows.
    groups = stored(chains.select("key", F.unhex(F.sha2("norm", 256)).alias("digest"), "chars", "size", "first", "best")
              .groupBy("key", "digest")
              .agg(F.sum("size").alias("group_size"), F.max("chars").alias("most"),
                   F.max_by("first", "chars").alias("keep_id"),
                   F.max_by("best", "chars").alias("best")), "groups")
    members = index.select("n", "doc_id", "chars", "key", "digest", *(["row"] if whole_rows else []))
    joined = members.join(groups, ["key", "digest"])
    return joined.select(
        "doc_id", "keep_id", "group_size",
        ((F.col("chars") == F.col("most")) & (rank == F.col("best"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), *(["row"] if whole_rows else []))


def _rank(kind: T.DataType) -> Column:
    """(doc_id, row number), null ids last.

    For whole numbers one number that sorts alike, of fixed width, so that it pre-aggregates in place.
    """
    if not isinstance(kind, T.IntegralType):
        return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n")
    last, span = F.lit((1 << 63) - 1), F.lit("1000000000000000000").cast("decimal(19,0)")
    return (F.coalesce(F.col("doc_id"), last).cast("decimal(19,0)") * span + F.col("n")).cast("decimal(38,0)")
