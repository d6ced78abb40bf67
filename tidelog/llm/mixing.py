"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Documents fall into blocks of their source.  A source's target is met by whole passes over its
blocks and one partial pass, which gives it an exact quota of block draws.  A binary tree over
the output shards splits the quotas: at each node the left half's share of every source is
drawn from the multivariate hypergeometric distribution, so each shard gets what a uniform
permutation of all draws would give it, and no two shards share a draw.  The shards take
disjoint runs of each source's permuted blocks and shuffle their documents locally.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import stored

WEIGHTS = (5.0, 2.0, 1.0)
# A document is taken this many times at most.
MOST = 3
# Words a block should hold; a source has MAX_BLOCKS blocks at most, so a quota stays small.
BLOCK_WORDS = 50_000
MAX_BLOCKS = 1_024
# Words an output shard should hold.
SHARD_WORDS = 20_000_000
SEED = 20


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sources`` (source, words) with place and target.

    Sources take the weights in turn, by code point, null last.  Targets share the words of all
    sources by weight; a target above ``most`` times its source's words stops there and the
    excess is shared anew by weight, until none is above.  Works on one row per source.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    placed = sources.withColumn("place", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    placed = stored(placed.withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
                    .withColumn("most", F.lit(float(most)) * F.col("words")), "sources")
    total, rate, before = placed.agg(F.sum("words")).first()[0] or 0, 0.0, None
    while True:
        full = F.col("weight") * F.lit(rate) >= F.col("most")
        spent, free, count = placed.agg(F.sum(F.when(full, F.col("most")).otherwise(0.0)),
                                        F.sum(F.when(~full, F.col("weight")).otherwise(0.0)),
                                        F.count_if(full)).first()
        if count == before or not free:
            break
        rate, before = (total - spent) / free, count
    share = F.col("weight") * F.lit(rate)
    return placed.withColumn("target", F.when(share >= F.col("most"), F.col("most")).otherwise(share))


@dataclass
class Mix:
    """``rows`` (one per document: place, block, copies …) and ``shards`` (place, block, turn, shard)."""

    rows: DataFrame
    shards: DataFrame

    def taken(self) -> DataFrame:
        """Per document: doc_id, size, source_size, target, taken, copies, and its ``row``."""
        return self.rows.withColumn("taken", F.col("size") * F.col("copies"))

    def mixed(self, seed: int = SEED) -> DataFrame:
        """The mix: (shard, position, row), a row for each copy, shuffled within its shard."""
        turns = self.rows.where("copies > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        dealt = turns.join(self.shards, ["place", "block", "turn"])
        mark = F.xxhash64(F.lit(seed), "shard", "turn", "mark")
        order = Window.partitionBy("shard").orderBy(mark, "n")
        return dealt.withColumn("position", F.row_number().over(order)).select("shard", "position", "row")


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
        weights: tuple[float, ...] = WEIGHTS, most: int = MOST, shard_words: int = SHARD_WORDS,
        seed: int = SEED, whole_rows: bool = False) -> Mix:
    """Mix ``docs`` so that each source's words come near its target.

    The partial pass ends short of the target by less than any document it leaves out.  Null texts hold no words; a
    null source is a source of its own, the last.  Null ids and repeated rows are documents like
    any other.  The draw depends on the seed, ids and texts only, so reruns agree.  An empty
    table gives an empty mix.
    """
    packed = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("n"))
    body = F.col("row")[text]
    rows = stored(packed.select(
        "n", F.col("row")[doc_id].alias("doc_id"), F.col("row")[source].alias("source"), words(body).alias("size"),
        F.xxhash64(F.lit(seed), F.col("row")[doc_id], body).alias("mark"), *(["row"] if whole_rows else [])), "sized")
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("words")), weights, most)
    passes = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0).cast("int")
    blocks = F.least(F.lit(MAX_BLOCKS), F.greatest(F.lit(1), F.ceil(F.col("words") / BLOCK_WORDS))).cast("int")
    sources = stored(sources.select(
        F.col("source").alias("of"), "place", F.col("words").alias("source_size"), "target", passes.alias("passes"),
        (F.col("target") - passes * F.col("words")).alias("rest"), blocks.alias("blocks")), "targets")
    placed = rows.join(sources, F.col("source").eqNullSafe(F.col("of"))).withColumn(
        "block", F.pmod(F.col("mark"), F.col("blocks").cast("long")).cast("int")).drop("of")
    quotas = stored(_partial_pass(placed.drop("row"), seed), "quotas")
    # The small tables are stored: Spark then knows their size, and shuffles the texts only if it must.
    ends = stored(_ends(placed.drop("row"), quotas), "ends")
    copies = F.col("passes") + (F.col("whole") | F.coalesce("last", F.lit(False))).cast("int")
    marked = (placed.join(quotas.select("place", "block", "whole"), ["place", "block"])
              .join(ends, "n", "left").withColumn("copies", copies))
    kept = ["n", "doc_id", "source", "size", "source_size", "target", "place", "block", "mark", "copies"]
    got = placed.select("n", "place", "block", "size").join(ends, "n").groupBy("place", "block").agg(F.sum("size").alias("got"))
    return Mix(marked.select(*kept, *(["row"] if whole_rows else [])),
               stored(_shards(quotas.join(got, ["place", "block"], "left"), shard_words, seed), "shards"))


def _turn(seed: int) -> Column:
    """Where a block stands in the permuted order of its source."""
    return F.xxhash64(F.lit(seed + 1), "place", "block")


def _partial_pass(placed: DataFrame, seed: int) -> DataFrame:
    """A row per block: its turn, whether the partial pass takes it whole, and what is left to take
    from the source where the whole blocks end (``left``, null in all other blocks)."""
    sized = placed.groupBy("place", "block").agg(
        F.sum("size").alias("held"), F.first("passes").alias("passes"), F.first("rest").alias("rest"))
    sized = sized.withColumn("at", _turn(seed))
    turn = Window.partitionBy("place").orderBy("at", "block")
    run = sized.withColumn("upto", F.sum("held").over(turn.rowsBetween(Window.unboundedPreceding, 0)))
    whole = F.col("upto") <= F.col("rest")
    end = ~whole & (F.col("upto") - F.col("held") < F.col("rest"))
    return run.select("place", "block", "at", "held", "passes", whole.alias("whole"),
                      F.when(end, F.col("rest") - F.col("upto") + F.col("held")).alias("left"))


def _ends(placed: DataFrame, quotas: DataFrame) -> DataFrame:
    """Rows (n, last): the documents the partial pass takes behind its whole blocks.

    Each round goes on through the blocks in their permuted order, takes the documents that
    still fit what is left until one no longer does, and drops those that have become too long.
    Each round takes a document of every source that has one that fits; it ends when none has.
    """
    left = quotas.where("left IS NOT NULL").select("place", "left")
    blocks = quotas.where("NOT whole").select("place", "block", "at").join(left, "place")
    rows = placed.select("n", "place", "block", "size", "mark").join(blocks, ["place", "block"])
    rows = stored(rows.where("size <= left"), "open")
    taken = rows.select("n", F.lit(True).alias("last")).limit(0)
    source = Window.partitionBy("place").orderBy("at", "block").rowsBetween(Window.unboundedPreceding, 0)
    inside = Window.partitionBy("place", "block").orderBy("mark", "n").rowsBetween(Window.unboundedPreceding, 0)
    while not rows.isEmpty():
        sums = rows.groupBy("place", "block", "at").agg(F.sum("size").alias("held"), F.first("left").alias("most"))
        rooms = sums.withColumn("room", F.col("most") - F.sum("held").over(source) + F.col("held"))
        rooms = rooms.where("room >= 0").select("place", "block", "room")
        run = F.sum("size").over(inside)
        rows = stored(rows.join(rooms, ["place", "block"], "left").withColumn(
            "last", F.coalesce(run <= F.col("room"), F.lit(False))).drop("room"), "round")
        taken = taken.unionByName(rows.where("last").select("n", "last"))
        spent = rows.where("last").groupBy("place").agg(F.sum("size").alias("spent"))
        rows = rows.where("NOT last").join(spent, "place").withColumn("left", F.col("left") - F.col("spent"))
        rows = stored(rows.where("size <= left").drop("last", "spent"), "open")
    return taken


def _shards(quotas: DataFrame, shard_words: int, seed: int) -> DataFrame:
    """Rows (place, block, turn, shard): which shard takes each draw of a block.

    The last draw of a block may be of some documents only, of ``got`` words.
    """
    partial = F.col("whole") | F.col("got").isNotNull()
    some = ~F.col("whole") & (F.col("turn") == F.col("passes"))
    draws = quotas.select("place", "block", "held", "passes", "whole", "got", F.explode(F.when(
        F.col("passes") + partial.cast("int") > 0,
        F.sequence(F.lit(0), F.col("passes") + partial.cast("int") - 1))).alias("turn"))
    draws = draws.withColumn("held", F.when(some, F.col("got")).otherwise(F.col("held"))).drop("passes", "whole", "got")
    order = Window.partitionBy("place").orderBy("turn", F.xxhash64(F.lit(seed + 2), "place", "turn", "block"), "block")
    draws = draws.withColumn("draw", F.row_number().over(order) - 1)
    total = draws.agg(F.sum("held")).first()[0] or 0
    count = max(1, -(-total // shard_words))
    nodes = draws.groupBy("place").agg(F.count("*").alias("quota")).select(
        F.lit(0).cast("long").alias("lo"), F.lit(count).cast("long").alias("hi"), "place", "quota")
    for _ in range((count - 1).bit_length()):
        nodes = nodes.groupBy("lo", "hi").applyInPandas(_splitter(seed), nodes.schema)
    runs = nodes.withColumn("upto", F.sum("quota").over(
        Window.partitionBy("place").orderBy("lo").rowsBetween(Window.unboundedPreceding, 0)))
    taken = runs.where("quota > 0").select("place", F.col("lo").alias("shard"), F.explode(
        F.sequence(F.col("upto") - F.col("quota"), F.col("upto") - 1)).alias("draw"))
    return draws.join(taken, ["place", "draw"]).select("place", "block", "turn", "shard")


def _splitter(seed: int):
    def split(node: pd.DataFrame) -> pd.DataFrame:
        lo, hi = int(node["lo"].iloc[0]), int(node["hi"].iloc[0])
        if hi - lo == 1:
            return node
        node = node.sort_values("place", ignore_index=True)
        middle, quota = (lo + hi) // 2, node["quota"].to_numpy()
        share = int(quota.sum()) * (middle - lo) // (hi - lo)
        left = np.random.default_rng([seed, lo, hi]).multivariate_hypergeometric(quota, share, method="marginals")
        return pd.concat([node.assign(hi=middle, quota=left), node.assign(lo=middle, quota=quota - left)])

    return split
