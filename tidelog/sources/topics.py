"""Topics: named logs on storage, and reading them."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.log import KEY, VALUE, Log
from tidelog.operators.table import GlobalTable, Table

HEADERS = T.ArrayType(T.StructType([T.StructField("key", T.StringType()),
                                    T.StructField("value", T.BinaryType())]))


@dataclass(frozen=True)
class Topic:
    """A log directory (``format`` names its file source) or a Kafka topic.

    Key and value types make the schema; ``partition_fn(key, value, n)`` overrides
    the default partitioner on write; a read-only topic refuses writes.
    """

    name: str
    key_type: str = "string"
    value_type: str = "string"
    path: str | None = None
    format: str = "parquet"
    partitions: int = 1
    partition_fn: Callable[[Column, Column, int], Column] | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    read_only: bool = False

    def __post_init__(self):
        if not isinstance(self.name, str) or not self.name:
            raise TypeError("a topic needs a name")
        if not isinstance(self.partitions, int) or self.partitions <= 0:
            raise ValueError("partitions must be a positive int")
        if self.partition_fn is not None and not callable(self.partition_fn):
            raise TypeError("partition_fn must be a function")
        if any(not isinstance(v, str) for kv in self.options.items() for v in kv):
            raise TypeError("topic options map strings to strings")
        if self.format != "kafka" and not self.path:
            raise ValueError(f"topic {self.name!r} needs a path")

    @property
    def schema(self) -> T.StructType:
        return T.StructType([
            T.StructField(KEY, T.DataType.fromDDL(self.key_type)),
            T.StructField(VALUE, T.DataType.fromDDL(self.value_type)),
            T.StructField("ts", T.TimestampType()), T.StructField("timestamp_type", T.StringType()),
            T.StructField("offset", T.LongType()), T.StructField("headers", HEADERS),
            T.StructField("partition", T.IntegerType())])


class Catalog:
    """The topics known by name."""

    def __init__(self, topics: Iterable[Topic] = ()):
        self._topics = {t.name: t for t in topics}

    def add(self, topic: Topic) -> Catalog:
        self._topics[topic.name] = topic
        return self

    def __getitem__(self, name: str) -> Topic:
        if name not in self._topics:
            raise KeyError(f"unknown topic {name!r}; known: {self.names()}")
        return self._topics[name]

    def exists(self, name: str) -> bool:
        return name in self._topics

    def names(self) -> list[str]:
        return sorted(self._topics)

    def matching(self, pattern: str) -> list[Topic]:
        return [self._topics[n] for n in self.names() if re.fullmatch(pattern, n)]


def read_log(spark: SparkSession, topic: Topic, streaming: bool = False, **options: str) -> Log:
    """Read one topic; partition filters prune directories, columns prune the scan."""
    if not isinstance(topic, Topic):
        raise TypeError(f"a topic is needed, got {type(topic).__name__}")
    reader = spark.readStream if streaming else spark.read
    reader = reader.options(**{**topic.options, **options})
    if topic.format == "kafka":
        return _kafka_log(reader, topic)
    df = reader.schema(topic.schema).format(topic.format).load(topic.path)
    return Log(df.withColumn("topic", F.lit(topic.name)))


def _kafka_log(reader, topic: Topic) -> Log:
    if "assign" not in topic.options and "subscribePattern" not in topic.options:
        reader = reader.option("subscribe", topic.name)
    df = reader.option("includeHeaders", "true").format("kafka").load()
    return Log(df.select(
        _decoded(F.col(KEY), topic.key_type).alias(KEY),
        _decoded(F.col(VALUE), topic.value_type).alias(VALUE),
        F.col("timestamp").alias("ts"), F.col("timestampType").cast("string").alias(
            "timestamp_type"), "offset", "headers", "partition", "topic"))


def _decoded(data: Column, ddl: str) -> Column:
    from tidelog.functions.scalars import bytes_to_long
    if ddl == "binary":
        return data
    if ddl in ("bigint", "long"):
        return bytes_to_long(data)
    text = F.decode(data, "UTF-8")
    return text if ddl == "string" else F.from_json(text, ddl)


def read_logs(spark: SparkSession, topics: Iterable[Topic], streaming: bool = False) -> Log:
    """Several topics as one log; their key and value types have to agree."""
    topics = list(topics)
    if not topics:
        raise ValueError("no topics given")
    first = topics[0]
    for t in topics[1:]:
        if (t.key_type, t.value_type) != (first.key_type, first.value_type):
            raise ValueError(f"topics {first.name!r} and {t.name!r} differ in key or value type")
    frames = [read_log(spark, t, streaming).df for t in topics]
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return Log(out, ("ts", "topic", "partition", "offset"))


def read_pattern(spark: SparkSession, catalog: Catalog, pattern: str,
                 streaming: bool = False) -> Log:
    """All topics whose whole name matches the pattern."""
    topics = catalog.matching(pattern)
    if not topics:
        raise ValueError(f"no topic matches {pattern!r}")
    return read_logs(spark, topics, streaming)


def read_matching(spark: SparkSession, root: str, pattern: str, like: Topic,
                  streaming: bool = False, **options: str) -> Log:
    """All topics below a folder whose whole name matches the pattern, told apart by their paths.

    The folder that holds a topic's partitions names it; ``like`` gives format, types and options.
    Topics are looked for on storage: a stream takes in those that appear after it was started, with
    the next micro-batch.  Files of other topics are listed, but not opened.  A file that lies in no
    partition folder belongs to partition 0.  For Kafka the pattern is subscribed to.
    """
    if not isinstance(like, Topic):
        raise TypeError(f"a topic is needed, got {type(like).__name__}")
    re.compile(pattern)
    order = ("ts", "topic", "partition", "offset")
    reader = spark.readStream if streaming else spark.read
    reader = reader.options(**{**like.options, **options})
    if like.format == "kafka":
        return Log(_kafka_log(reader.option("subscribePattern", pattern),
                              replace(like, options={"subscribePattern": pattern})).df, order)
    inside = T.StructType([f for f in like.schema if f.name != "partition"])
    df = reader.schema(inside).option("recursiveFileLookup", "true").format(like.format).load(root)
    # Paths come as URIs, where a plus sign stands for itself.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    place = r"/([^/]+)/(?:partition=(\d+)/)?[^/]+$"
    name, shard = F.regexp_extract(path, place, 1), F.regexp_extract(path, place, 2)
    partition = F.when(shard == "", F.lit(0)).otherwise(shard.cast("int"))
    found = df.where(name.rlike(f"^(?:{pattern})$")).withColumns({"partition": partition, "topic": name})
    return Log(found, order)


def subscribe(spark: SparkSession, catalog: Catalog, names: Iterable[str],
              streaming: bool = False) -> Log:
    names = [names] if isinstance(names, str) else list(names)
    if any(not isinstance(n, str) for n in names):
        raise TypeError("topic names are strings")
    return read_logs(spark, [catalog[n] for n in names], streaming)


def assign(log: Log, *shards: tuple[str, int]) -> Log:
    """Only the given (topic, partition) shards; pruned at the scan."""
    if not shards:
        raise ValueError("assign needs at least one (topic, partition)")
    met = None
    for topic, partition in shards:
        one = (F.col("topic") == topic) & (F.col("partition") == partition)
        met = one if met is None else met | one
    return Log(log.df.where(met), log.order)


def assign_all(log: Log, topics: Iterable[str]) -> Log:
    return Log(log.df.where(F.col("topic").isin(list(topics))), log.order)


def read_table(spark: SparkSession, topic: Topic, store: str | None = None,
               streaming: bool = False) -> Table:
    """Read a topic as an upsert table, optionally naming its state as a view."""
    table = read_log(spark, topic, streaming).to_table()
    return table.as_view(store) if store else table


def read_global_table(spark: SparkSession, topic: Topic) -> GlobalTable:
    return GlobalTable.of(read_table(spark, topic))


def topics_of(log: Log) -> DataFrame:
    """The topic names in a log, sorted."""
    return log.df.select("topic").distinct().orderBy("topic")
