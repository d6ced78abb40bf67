"""The registered queries, one module per family."""

from tidelog.plans import (aggregates, examples, joins, logs, payloads, stateless, streams,
                           transforms, windows)
from tidelog.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "aggregates", "examples", "joins", "logs", "payloads",
           "stateless", "streams", "transforms", "windows"]
