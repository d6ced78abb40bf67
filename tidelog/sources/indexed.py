"""Topics with a manifest: where each file's offsets and times lie.

Below the topic's path, ``data/batch=…/partition=…`` holds the records of one append under numbers
relative to it, and ``manifest`` one small file per append: for every log partition the first
offset, the records and the range of times of what was appended, and the offset that comes next.

An append writes its data first and then commits by creating the next manifest file, which only
one writer can do; the others look at what was committed meanwhile and try the next one.  Data is
never written anew for that, because its numbers are relative.  Nothing of an append is visible
before its commit, and an append reads the latest manifest file instead of the topic.  The topic's
file system must not replace files on rename, which streaming checkpoints need as well.

A read from an offset or a time opens the folders that can hold what is asked for.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.log import Log, need_type
from tidelog.operators.timeline import Timeline
from tidelog.sources.sinks import ReadOnlyTopic, placed, typed_rows
from tidelog.sources.topics import Topic

ENTRY = "batch string, partition int, base long, rows long, first_ts timestamp, last_ts timestamp"


class Files:
    """The few file operations a commit needs, by Hadoop's file system of the path."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        path = self._jvm.org.apache.hadoop.fs.Path(folder)
        self._fs = path.getFileSystem(self._conf)
        self._folder = self._fs.makeQualified(path)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._folder, name)

    def names(self) -> list[str]:
        if not self._fs.exists(self._folder):
            return []
        return sorted(f.getPath().getName() for f in self._fs.listStatus(self._folder))

    def create(self, name: str, text: str) -> bool:
        """Whole or not at all; False if there is such a file."""
        draft, target = self._path(f"_{uuid.uuid4().hex}"), self._path(name)
        out = self._fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf)
        kind = self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        try:
            context.rename(draft, target, self._jvm.java.lang.reflect.Array.newInstance(kind, 0))
        except Py4JJavaError as e:
            self._fs.delete(draft, False)
            if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False
        return True


def _latest(spark: SparkSession, topic: Topic) -> tuple[int, dict[int, int]]:
    """(number of the last commit or -1, the next offset of each partition)."""
    names = [n for n in Files(spark, f"{topic.path}/manifest").names() if n.endswith(".json")]
    if not names:
        return -1, {}
    # a line per log partition
    rows = spark.read.schema(ENTRY).json(f"{topic.path}/manifest/{names[-1]}").collect()
    return int(names[-1].removesuffix(".json")), {r["partition"]: r["base"] + r["rows"] for r in rows}


def append_indexed(log: Log, topic: Topic) -> DataFrame:
    """Append records, give each the next offset of its partition, return their metadata.

    Any number of writers may append at once; offsets of a partition have no gaps and no doubles.
    """
    need_type(topic, Topic, "topic")
    if topic.read_only:
        raise ReadOnlyTopic(f"topic {topic.name!r} is read-only")
    spark, batch = log.df.sparkSession, uuid.uuid4().hex
    line = Timeline.of(placed(log, topic), ("partition",), log.order).running("__n", "count", F.lit(1))
    rows = typed_rows(line.frame.withColumn("offset", F.col("__n") - 1), topic)
    folder = f"{topic.path}/data/batch={batch}"
    rows.write.partitionBy("partition").format(topic.format).save(folder)
    written = spark.read.schema(topic.schema).format(topic.format).load(folder)
    # a row per log partition
    stats = {r["partition"]: r for r in written.groupBy("partition").agg(
        F.count(F.lit(1)).alias("rows"), F.min("ts").cast("string").alias("first_ts"),
        F.max("ts").cast("string").alias("last_ts")).collect()}
    files = Files(spark, f"{topic.path}/manifest")
    while True:
        last, ends = _latest(spark, topic)
        entries = []
        for partition in sorted(ends.keys() | stats.keys()):
            new = stats[partition].asDict() if partition in stats else {"partition": partition, "rows": 0}
            entries.append({**new, "batch": batch, "base": ends.get(partition, 0)})
        if files.create(f"{last + 1:020d}.json", "".join(json.dumps(e) + "\n" for e in entries)):
            break
    bases = spark.createDataFrame([(e["partition"], e["base"]) for e in entries], "partition int, base long")
    return written.join(bases, "partition").select(
        F.lit(topic.name).alias("topic"), "partition", (F.col("offset") + F.col("base")).alias("offset"), "ts")


def manifest(spark: SparkSession, topic: Topic) -> DataFrame:
    """What each append put into each log partition: batch, partition, base, rows, first_ts, last_ts."""
    if _latest(spark, topic)[0] < 0:
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).json(f"{topic.path}/manifest").where("rows > 0")


def indexed_offsets(spark: SparkSession, topic: Topic) -> DataFrame:
    """Begin and end offset of each partition, from the manifest alone."""
    return (manifest(spark, topic).groupBy("partition").agg(
        F.min("base").alias("begin_offset"), F.max(F.col("base") + F.col("rows")).alias("end_offset"))
        .select(F.lit(topic.name).alias("topic"), "partition", "begin_offset", "end_offset"))


def read_indexed(spark: SparkSession, topic: Topic, starts: Mapping[int, int] | None = None,
                 since: datetime | None = None) -> Log:
    """The topic from given offsets (by partition; others are left out), or from a time.

    ``since`` starts each partition at its first offset with that time or a later one, and takes
    everything from there, as a seek does.  The manifest names the folders to open.
    """
    if starts is not None and since is not None:
        raise ValueError("give offsets or a time, not both")
    entries = manifest(spark, topic).withColumn("start", F.lit(None).cast("long"))
    if starts is not None:
        at = spark.createDataFrame(list(starts.items()), "partition int, start long")
        entries = entries.drop("start").join(at, "partition").where(F.col("base") + F.col("rows") > F.col("start"))
    elif since is not None:
        reach = entries.where(F.col("last_ts") >= F.lit(since))
        first = reach.groupBy("partition").agg(F.min("base").alias("start"))
        entries = entries.drop("start").join(first, "partition").where(F.col("base") >= F.col("start"))
    # a row per append and partition, as many as folders to be listed
    chosen = [tuple(r) for r in entries.select("batch", "partition", "base", "start").collect()]
    data = f"{topic.path}/data"
    schema = T.StructType([*topic.schema.fields, T.StructField("batch", T.StringType())])
    if not chosen:
        df = spark.createDataFrame([], schema)
    else:
        df = (spark.read.schema(schema).option("basePath", data).format(topic.format)
              .load([f"{data}/batch={batch}/partition={partition}" for batch, partition, *_ in chosen]))
    bases = spark.createDataFrame(chosen, "batch string, partition int, base long, start long")
    df = df.join(bases, ["batch", "partition"]).withColumn("offset", F.col("offset") + F.col("base"))
    if starts is not None:
        df = df.where(F.col("offset") >= F.col("start"))
    elif since is not None:
        # the record that decides lies in the first append that reaches the time
        heads = df.where((F.col("base") == F.col("start")) & (F.col("ts") >= F.lit(since)))
        heads = heads.groupBy("partition").agg(F.min("offset").alias("head"))
        df = df.join(heads, "partition").where(F.col("offset") >= F.col("head"))
    return Log(df.select(*topic.schema.names, F.lit(topic.name).alias("topic")))
