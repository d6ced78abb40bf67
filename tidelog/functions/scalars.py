"""Scalar functions on columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the canonical spelling of a UUID.
UUID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
# Fixed value: the nil UUID.
NIL_UUID = "00000000-0000-0000-0000-000000000000"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Lower-case words split at non-word characters.

    A leading empty word stays and trailing ones go; a text without any separator
    is one word, even when empty.
    """
    def trimmed(parts):
        n = F.size(parts)
        ends_empty = (n > 1) & (parts[n - 1] == "")
        only_empty = (n == 2) & (parts[0] == "")
        none = F.slice(parts, 1, 0)
        return F.when(ends_empty & only_empty, none).when(
            ends_empty, F.slice(parts, F.lit(1), n - 1)).otherwise(parts)

    return let(F.split(F.lower(text), r"\W+", -1), trimmed)


def uuid_v5(namespace: Column, name: Column) -> Column:
    """The name-based (version 5) UUID of ``name`` in ``namespace``.

    The hash appears several times below; in a projection it is computed once.
    """
    h = F.sha1(F.concat(F.unhex(F.replace(namespace, F.lit("-"), F.lit(""))),
                        F.encode(name, "UTF-8")))
    # the two highest bits of this digit say which kind of UUID it is
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"),
                    F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"),
                    F.substring(h, 21, 12))


def is_uuid(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(text)).rlike(UUID_PATTERN), F.lit(False))


def canonical_uuid(text: Column) -> Column:
    """Lower-case canonical form; what cannot be a UUID stays as it is."""
    return F.when(is_uuid(text), F.lower(F.trim(text))).otherwise(text)


def string_to_bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def bytes_to_string(data: Column) -> Column:
    return F.decode(data, "UTF-8")


def long_to_bytes(number: Column) -> Column:
    """Eight bytes, big-endian, two's complement."""
    return F.unhex(F.lpad(F.hex(number.cast("long")), 16, "0"))


def bytes_to_long(data: Column) -> Column:
    unsigned = F.conv(F.hex(data), 16, 10).cast("decimal(20,0)")
    wrap = F.lit("18446744073709551616").cast("decimal(20,0)")
    limit = F.lit("9223372036854775807").cast("decimal(20,0)")
    return let(unsigned, lambda n: F.when(n > limit, n - wrap).otherwise(n)).cast("long")


def headers_map(headers: Column) -> Column:
    """Headers as a map; of several with one name the last counts."""
    names = F.transform(headers, lambda h: h["key"])

    def last_value(name):
        return F.element_at(F.filter(headers, lambda h: h["key"] == name), -1)["value"]

    return F.map_from_arrays(F.array_distinct(names),
                             F.transform(F.array_distinct(names), last_value))


def pair_sums(pairs: Column) -> Column:
    """The sum of each inner array."""
    return F.transform(pairs, lambda p: F.aggregate(p, F.lit(0).cast("long"),
                                                    lambda acc, x: acc + x))


def at_path(value: Column, path: str) -> Column:
    """A nested field of a struct, ``a.b`` or ``$.a.b``."""
    for name in path.removeprefix("$.").split("."):
        value = value[name]
    return value
