"""Checking every record against named rules."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.operators.log import KEY, VALUE, Log, holds, need_callable

Rules = Mapping[str, Callable[[Column, Column], Column]]


def with_errors(log: Log, rules: Rules) -> Log:
    """Adds ``errors``: the names of the rules a record breaks."""
    if not rules:
        raise ValueError("validation needs at least one rule")
    for name, rule in rules.items():
        need_callable(rule, f"rule {name!r}")
    broken = [F.when(~holds(rule(F.col(KEY), F.col(VALUE))), F.lit(name))
              for name, rule in rules.items()]
    return log._with(log.df.withColumn("errors", F.array_compact(F.array(*broken))))


def validate(log: Log, rules: Rules, mode: str = "fail"):
    """``fail`` stops the job at the first bad record, ``drop`` leaves bad records out,
    ``quarantine`` gives (valid, invalid with their errors)."""
    checked = with_errors(log, rules)
    good = F.size("errors") == 0
    if mode == "fail":
        text = F.concat(F.lit("record breaks "), F.array_join("errors", ", "), F.lit(": "),
                        F.to_json(F.struct(KEY, VALUE)))
        return log._with(checked.df.where(F.when(good, F.lit(True)).otherwise(
            F.raise_error(text).cast("boolean"))).drop("errors"))
    valid = log._with(checked.df.where(good).drop("errors"))
    if mode == "drop":
        return valid
    if mode == "quarantine":
        return valid, log._with(checked.df.where(~good))
    raise ValueError(f"mode must be fail, drop or quarantine, got {mode!r}")


def to_validated(log: Log, topic, rules: Rules) -> None:
    """Write to a topic; a bad record fails the write with its explanation."""
    return validate(log, rules, "fail").to(topic)


def through_validated(log: Log, topic, rules: Rules) -> Log:
    return validate(log, rules, "fail").through(topic)
