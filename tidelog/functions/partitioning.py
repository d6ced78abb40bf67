"""Which partition a record goes to, and the key it is filed under."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.scalars import let, long_to_bytes, string_to_bytes
from tidelog.operators.log import KEY, VALUE, Log

# Fixed values of the 32-bit murmur2 hash the log format uses.
SEED = 0x9747B28C
MULTIPLIER = 0x5BD1E995
WORD = 0xFFFFFFFF


def _times(a: Column) -> Column:
    """a * MULTIPLIER modulo 2^32; the product of a word and a 31-bit number fits a long."""
    return (a * MULTIPLIER).bitwiseAND(WORD)


def _fold_right(a: Column, bits: int) -> Column:
    return a.bitwiseXOR(F.shiftright(a, bits))


def _mixed_in(h: Column, k: Column) -> Column:
    return _times(h).bitwiseXOR(_times(_fold_right(_times(k), 24)))


def _finished(h: Column) -> Column:
    """The last mixing, and the word as a signed int (shifting up and down keeps the sign)."""
    h = _fold_right(_times(_fold_right(h, 13)), 15)
    return F.shiftright(F.shiftleft(h, 32), 32).cast("int")


def murmur2(data: Column) -> Column:
    """Signed 32-bit murmur2 of a binary column, in built-in functions only."""
    def from_bytes(hexed, n):
        def little_endian(start, size):
            at = lambda i: F.substring(hexed, start * 2 + 1 + 2 * i, F.lit(2))
            return F.conv(F.concat(*[at(i) for i in reversed(range(size))]), 16, 10).cast("long")

        whole = F.floor(n / 4).cast("int")
        count = F.when(whole > 0, F.sequence(F.lit(0), whole - 1)).otherwise(
            F.array().cast("array<int>"))
        blocks = F.transform(count, lambda i: little_endian(i * 4, 4))
        start = F.lit(SEED).cast("long").bitwiseXOR(n.cast("long"))
        mixed = F.aggregate(blocks, start, _mixed_in)
        left = n % 4
        tail = F.when(left == 3, little_endian(whole * 4, 3)).when(
            left == 2, little_endian(whole * 4, 2)).when(left == 1, little_endian(whole * 4, 1))
        return let(let(mixed, lambda m: F.when(tail.isNull(), m).otherwise(
            _times(m.bitwiseXOR(tail)))), _finished)

    return let(F.hex(data), lambda h: from_bytes(h, F.floor(F.length(h) / 2).cast("int")))


def murmur2_of_long(number: Column) -> Column:
    """``murmur2`` of a long's eight bytes, as plain arithmetic that compiles to one loop."""
    def swapped(x: Column) -> Column:
        byte = lambda shift: F.shiftright(x, shift).bitwiseAND(0xFF)
        return (F.shiftleft(byte(0), 24).bitwiseOR(F.shiftleft(byte(8), 16))
                .bitwiseOR(F.shiftleft(byte(16), 8)).bitwiseOR(byte(24)))

    number = number.cast("long")
    h = F.lit(SEED ^ 8).cast("long")
    for word in (swapped(F.shiftright(number, 32)), swapped(number)):
        h = _mixed_in(h, word)
    return _finished(h)


def serialized(key: Column, key_type: T.DataType) -> Column:
    """The bytes of a string, long or binary key."""
    if isinstance(key_type, T.BinaryType):
        return key
    if isinstance(key_type, T.IntegralType):
        return long_to_bytes(key)
    if isinstance(key_type, T.StringType):
        return string_to_bytes(key)
    return string_to_bytes(F.to_json(key))


def default_partition(data: Column, partitions: int) -> Column:
    """The positive murmur2 of the serialized key, modulo the partition count."""
    return _partition(murmur2(data), partitions)


def partition_of(key: Column, key_type: T.DataType, partitions: int) -> Column:
    """``default_partition`` of a key by its type."""
    if isinstance(key_type, T.IntegralType):
        return _partition(murmur2_of_long(key), partitions)
    return default_partition(serialized(key, key_type), partitions)


def _partition(hashed: Column, partitions: int) -> Column:
    if not isinstance(partitions, int) or partitions <= 0:
        raise ValueError(f"partitions must be a positive int, got {partitions!r}")
    return hashed.bitwiseAND(0x7FFFFFFF) % partitions


def key_path(record_key: str) -> list[str]:
    """``$.foo``, ``foo_bar`` and ``foo.bar`` as a path; underscores read as dashes."""
    return record_key.replace("$.", "").replace("_", "-").split(".")


def key_from_json(payload: Column, record_key: str) -> Column:
    """The field of a JSON text that ``record_key`` names."""
    return F.get_json_object(payload, "$" + "".join(f"['{p}']" for p in key_path(record_key)))


def key_from_struct(value: Column, record_key: str) -> Column:
    for name in key_path(record_key):
        value = value.getField(name)
    return value


def addressed(df: DataFrame, partitions: int, key: Callable[[Column], Column] | None = None,
              partition: Callable[[Column, Column, int], Column] | None = None) -> DataFrame:
    """Fill in key and partition of records to be written.

    A key or partition the record already has wins; otherwise ``key(value)``
    (default: its ``id``) and ``partition(key, value, n)`` (default: murmur2) are
    used.  A partition outside 0 .. n-1 fails the job.
    """
    given_key = F.col(KEY) if KEY in df.columns else F.lit(None)
    made_key = (key or (lambda v: v["id"]))(F.col(VALUE))
    keyed = df.withColumn(KEY, F.coalesce(given_key, made_key))
    key_type = keyed.schema[KEY].dataType
    chosen = (partition(F.col(KEY), F.col(VALUE), partitions) if partition
              else partition_of(F.col(KEY), key_type, partitions))
    given = F.col("partition").cast("int") if "partition" in df.columns else F.lit(None).cast("int")
    out = keyed.withColumn("partition", F.coalesce(given, chosen.cast("int")))
    inside = F.col("partition").between(0, partitions - 1)
    return out.withColumn("partition", F.when(inside, F.col("partition")).otherwise(F.raise_error(
        F.concat(F.lit("invalid partition for topic: "), F.col("partition").cast("string"))
    ).cast("int")))


def repartitioned(log: Log, partitions: int,
                  partition: Callable[[Column, Column, int], Column] | None = None) -> Log:
    """The log with its ``partition`` column computed by the topic's partition function."""
    made = (partition(F.col(KEY), F.col(VALUE), partitions) if partition
            else partition_of(F.col(KEY), log.key_type, partitions))
    return log._with(log.df.withColumn("partition", made.cast("int")))
