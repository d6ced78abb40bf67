"""Named tables: the state of an upsert table kept on storage, laid out by key.

A table is a base and deltas, each in folders by bucket of the key.  An upsert writes one delta
with the latest record of every key it touches, tombstones included; ``compact`` folds base and
deltas into a new base.  Each step commits by creating the next state file, which names the
folders that count, so readers see whole steps only and two writers cannot take the same one.
Upserts carry a batch number: a micro-batch that comes again changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import session
from tidelog.operators.log import KEY, VALUE, Log, need_type
from tidelog.sources.indexed import Files


class TableChanged(RuntimeError):
    """Another writer committed first."""


@dataclass(frozen=True)
class NamedTable:
    """``buckets`` bounds how much of the table a lookup of one key reads; it never changes."""

    path: str
    key_type: str
    value_type: str
    buckets: int = 64

    @property
    def _schema(self) -> str:
        return f"{KEY} {self.key_type}, {VALUE} {self.value_type}, ts timestamp, offset long, step int, bucket int"

    def _bucket(self, key):
        return F.pmod(F.xxhash64(key.cast(self.key_type)), F.lit(self.buckets)).cast("int")

    def _state(self, spark: SparkSession) -> dict:
        """Of the latest commit: its step, the folders that count, the last batch number."""
        names = [n for n in Files(spark, f"{self.path}/state").names() if n.endswith(".json")]
        if not names:
            return {"step": -1, "folders": [], "batch": None}
        return json.loads(spark.read.text(f"{self.path}/state/{names[-1]}").first()[0])

    def _commit(self, spark: SparkSession, state: dict) -> None:
        if not Files(spark, f"{self.path}/state").create(f"{state['step']:020d}.json", json.dumps(state)):
            raise TableChanged(f"step {state['step']} of {self.path} is taken")

    def _rows(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], self._schema)
        frames = [spark.read.schema(self._schema).parquet(f"{self.path}/{f}") for f in folders]
        out = frames[0]
        for df in frames[1:]:
            out = out.unionByName(df)
        return out

    def _latest(self, rows: DataFrame) -> DataFrame:
        newest = F.max_by(F.struct(VALUE, "ts", "offset", "step"), F.struct("step", "ts", "offset"))
        return rows.groupBy("bucket", KEY).agg(newest.alias("row")).select(KEY, "row.*", "bucket")

    def _write(self, rows: DataFrame) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        rows.write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        return folder

    def upsert(self, log: Log, batch: int | None = None) -> bool:
        """Take in a log's records; False if ``batch`` was taken in before."""
        need_type(log, Log, "log")
        spark = log.df.sparkSession
        state = self._state(spark)
        if batch is not None and state["batch"] is not None and batch <= state["batch"]:
            return False
        step = state["step"] + 1
        rows = log.df.where(F.col(KEY).isNotNull()).select(
            F.col(KEY).cast(self.key_type).alias(KEY), F.col(VALUE).cast(self.value_type).alias(VALUE),
            F.col("ts").cast("timestamp").alias("ts"), F.col("offset").cast("long").alias("offset"),
            F.lit(step).alias("step"), self._bucket(F.col(KEY)).alias("bucket"))
        folder = self._write(self._latest(rows))
        self._commit(spark, {"step": step, "folders": [*state["folders"], folder],
                             "batch": state["batch"] if batch is None else batch})
        return True

    def compact(self, spark: SparkSession) -> None:
        """Fold everything into one base; deleted keys leave it."""
        state = self._state(spark)
        live = self._latest(self._rows(spark, state["folders"])).where(F.col(VALUE).isNotNull())
        folder = self._write(live.repartition("bucket"))
        self._commit(spark, {**state, "step": state["step"] + 1, "folders": [folder]})

    def snapshot(self, spark: SparkSession) -> DataFrame:
        """One row per live key."""
        rows = self._latest(self._rows(spark, self._state(spark)["folders"]))
        return rows.where(F.col(VALUE).isNotNull()).select(KEY, VALUE)

    def lookup(self, spark: SparkSession, keys: Iterable) -> DataFrame:
        """The live rows of some keys; only folders of their buckets are read."""
        keys = list(keys)
        met = F.lit(False)
        for key in keys:
            met = met | ((F.col("bucket") == self._bucket(F.lit(key))) & (F.col(KEY) == F.lit(key)))
        rows = self._latest(self._rows(spark, self._state(spark)["folders"]).where(met))
        return rows.where(F.col(VALUE).isNotNull()).select(KEY, VALUE)

    def keep_up(self, log: Log, checkpoint: str | None = None, compact_after: int = 16):
        """Take in a stream, a delta per micro-batch and a compaction after some; the query is returned."""
        spark = log.df.sparkSession

        def take(df: DataFrame, batch: int) -> None:
            self.upsert(Log(df, log.order), batch)
            if len(self._state(spark)["folders"]) > compact_after:
                self.compact(spark)

        place = checkpoint or session.shared_folder(spark, "checkpoint")
        return (log.df.writeStream.foreachBatch(take).option("checkpointLocation", place)
                .trigger(availableNow=True).start())
