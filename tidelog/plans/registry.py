"""The registered queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import session
from tidelog.operators.log import Log
from tidelog.operators.table import Table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The events table as every oracle reads it: amounts as exact decimals.
EVENTS = ("SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(12,2)) AS v, props, "
          "CAST(user_id % 4 AS INTEGER) AS part FROM events")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(session.prepare(spark), folder)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def exact(amount: Column | str) -> Column:
    return (F.col(amount) if isinstance(amount, str) else amount).cast("decimal(12,2)")


def as_double(amount: Column | str) -> Column:
    return (F.col(amount) if isinstance(amount, str) else amount).cast("double")


def events_log(df: DataFrame) -> Log:
    """Events as a log: keyed by user, the value a struct, four partitions."""
    value = F.struct(exact("value").alias("amount"), "event_type", "props")
    return Log.of(df, "user_id", value, "ts", "event_id",
                  partition=(F.col("user_id") % 4).cast("int"), topic=F.col("event_type"))


def events(spark: SparkSession, folder: str) -> Log:
    return events_log(table(spark, folder, "events"))


def amounts(spark: SparkSession, folder: str) -> Log:
    """Events as a log of plain amounts."""
    return events(spark, folder).map_values(lambda v: v["amount"])


def typed(log: Log, event_type: str) -> Log:
    return Log(log.df.where(F.col("topic") == event_type), log.order)


def accounts_log(spark: SparkSession, folder: str) -> Log:
    """Upserts from purchases, deletes from signups."""
    log = events(spark, folder)
    log = Log(log.df.where(F.col("topic").isin("purchase", "signup")), log.order)
    return log.map_values(lambda v: F.when(v["event_type"] == "purchase", v["amount"]))


def accounts(spark: SparkSession, folder: str) -> Table:
    return accounts_log(spark, folder).to_table()


# The same two, for oracles.
ACCOUNTS = (f"SELECT user_id, ts, event_id, CASE WHEN event_type = 'purchase' THEN v END AS v "
            f"FROM ({EVENTS}) WHERE event_type IN ('purchase', 'signup')")
ACCOUNT_STATE = (f"SELECT user_id, v FROM (SELECT *, row_number() OVER "
                 f"(PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM ({ACCOUNTS})) "
                 f"WHERE rn = 1 AND v IS NOT NULL")
