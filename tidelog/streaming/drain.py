"""Running a streaming plan over what is there, and reading the result back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidelog import session
from tidelog.operators.windows import SuppressBufferFull


def read_stream(spark: SparkSession, folder: str, table: str, **options: str) -> DataFrame:
    """One table of a folder of parquet files, as a stream of its files."""
    schema = spark.read.parquet(f"{folder}/{table}.parquet").schema
    return (spark.readStream.schema(schema).options(**options)
            .option("pathGlobFilter", f"{table}.parquet").parquet(folder))


def drain(df: DataFrame, mode: str = "append") -> DataFrame:
    """Run to the end of the input; the output is read back from the shared folder.

    In ``update`` mode every version of a row is kept, with the ``batch`` that gave it.
    """
    spark = df.sparkSession
    out = session.shared_folder(spark, "drained")
    place = session.shared_folder(spark, "checkpoint")
    if mode == "append":
        query = (df.writeStream.format("parquet").option("path", out)
                 .option("checkpointLocation", place).outputMode("append")
                 .trigger(availableNow=True).start())
        schema = df.schema
    else:
        def batch(rows: DataFrame, n: int) -> None:
            # a folder per batch makes a repeated batch replace itself
            rows.write.mode("overwrite").parquet(f"{out}/batch={n}")

        query = (df.writeStream.foreachBatch(batch).option("checkpointLocation", place)
                 .outputMode(mode).trigger(availableNow=True).start())
        schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema)}, batch long"
    query.awaitTermination()
    if mode == "append":
        return spark.read.schema(schema).parquet(out)
    return spark.read.schema(schema).option("basePath", out).parquet(out)


def newest(versions: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows drained in ``update`` mode, the last version per key."""
    rest = [c for c in versions.columns if c not in (*keys, "batch")]
    last = versions.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("row"))
    return last.select(*keys, "row.*")


class BufferGuard(StreamingQueryListener):
    """Stops a query whose state holds more rows than the suppress buffer may."""

    def __init__(self, spark: SparkSession, query: StreamingQuery, max_records: int):
        self.spark, self.id, self.max_records = spark, query.id, max_records
        self.failed: SuppressBufferFull | None = None

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        held = sum(op.numRowsTotal for op in event.progress.stateOperators)
        if str(event.progress.id) == str(self.id) and held > self.max_records:
            self.failed = SuppressBufferFull(
                f"buffer needs {held} records, limit is {self.max_records}")
            query = self.spark.streams.get(self.id)
            if query is not None:
                query.stop()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
