"""Joins of logs and tables."""

from pyspark.sql import functions as F

from tidelog.operators.log import Log
from tidelog.operators.table import GlobalTable
from tidelog.operators.windows import JoinWindows
from tidelog.plans.registry import (ACCOUNTS, EVENTS, as_double, events, exact, query, table,
                                    typed)

ROUND = "CAST({} AS DOUBLE)"


def add(a, b):
    """Sum in which a missing side counts as nought."""
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))


def by_user(spark, d, event_type):
    return typed(events(spark, d), event_type).map_values(lambda v: v["amount"])


def balances(spark, d):
    """Purchases and deletes, as in ACCOUNTS."""
    from tidelog.plans.registry import accounts
    return accounts(spark, d)


def out(log, *names):
    return log.df.select(F.col("key").alias("user_id"), as_double("value").alias("value"),
                         *[F.col(c).alias(n) for c, n in names])


VIEWS = f"SELECT user_id, ts, event_id, v FROM ({EVENTS}) WHERE event_type = 'view'"
AS_OF = f"""
SELECT l.user_id, l.event_id, CAST(l.v + coalesce(r.v, 0) AS DOUBLE) AS value
FROM ({VIEWS}) l ASOF {{how}} JOIN ({ACCOUNTS}) r ON l.user_id = r.user_id AND l.ts >= r.ts {{where}}"""


@query("stream_table_join", AS_OF.format(how="", where="WHERE r.v IS NOT NULL"))
def stream_table_join(spark, d):
    """Views with the user's balance at that time."""
    return out(by_user(spark, d, "view").join(balances(spark, d), lambda a, b: a + b),
               ("offset", "event_id"))


@query("stream_table_left_join", AS_OF.format(how="LEFT", where=""))
def stream_table_left_join(spark, d):
    return out(by_user(spark, d, "view").left_join(balances(spark, d), add),
               ("offset", "event_id"))


def orders_log(spark, d):
    return Log.of(table(spark, d, "orders"), "o_orderkey", F.struct(
        "o_custkey", exact("o_totalprice").alias("price")), "o_orderdate", "o_orderkey")


def customers(spark, d):
    log = Log.of(table(spark, d, "customer"), "c_custkey", F.struct("c_name", exact("c_acctbal").alias("balance")),
                 F.lit(0).cast("timestamp"), "c_custkey")
    return GlobalTable.of(log.to_table())


def _priced(a, b):
    return F.struct(a["price"].alias("price"), b["c_name"].alias("name"),
                    b["balance"].alias("balance"))


def _orders_out(log):
    return log.df.select(F.col("key").alias("o_orderkey"), as_double("value.price").alias("price"),
                         F.col("value.name").alias("name"),
                         as_double("value.balance").alias("balance"))


@query("global_join", """
SELECT o_orderkey, o_totalprice AS price, c_name AS name, c_acctbal AS balance
FROM orders JOIN customer ON o_custkey = c_custkey""")
def global_join(spark, d):
    log = orders_log(spark, d).join_global(
        customers(spark, d), lambda k, v: v["o_custkey"], _priced)
    return _orders_out(log)


@query("global_left_join", """
SELECT o_orderkey, o_totalprice AS price, c_name AS name, c_acctbal AS balance
FROM orders LEFT JOIN customer ON o_custkey * 2 = c_custkey""")
def global_left_join(spark, d):
    log = orders_log(spark, d).left_join_global(
        customers(spark, d), lambda k, v: v["o_custkey"] * 2, _priced)
    return _orders_out(log)


@query("global_join_as_of", AS_OF.format(how="", where="WHERE r.v IS NOT NULL"))
def global_join_as_of(spark, d):
    log = by_user(spark, d, "view").join_global(
        GlobalTable.of(balances(spark, d)), lambda k, v: k, lambda a, b: a + b, as_of=True)
    return out(log, ("offset", "event_id"))


# -- two tables: balances (with deletes) and the last click of each user --------------------

CLICKS = f"SELECT user_id, ts, event_id, v FROM ({EVENTS}) WHERE event_type = 'click'"
STATE = """SELECT user_id, v FROM (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY ts DESC, event_id DESC) AS rn FROM ({})) WHERE rn = 1 AND v IS NOT NULL"""
SNAPSHOTS = (f"SELECT user_id, CAST(coalesce(l.v, 0) + coalesce(r.v, 0) AS DOUBLE) AS value "
             f"FROM ({STATE.format(ACCOUNTS)}) l {{how}} JOIN ({STATE.format(CLICKS)}) r "
             f"USING (user_id)")
CHANGES = f"""
WITH merged AS (
  SELECT user_id, ts, event_id, 0 AS side, {{{{'v': v}}}} AS l, NULL AS r FROM ({ACCOUNTS})
  UNION ALL BY NAME
  SELECT user_id, ts, event_id, 1 AS side, {{{{'v': v}}}} AS r FROM ({CLICKS})),
now AS (
  SELECT *, (last_value(l IGNORE NULLS) OVER w).v AS lv, (last_value(r IGNORE NULLS) OVER w).v AS rv
  FROM merged WINDOW w AS (PARTITION BY user_id ORDER BY ts, side, event_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
joined AS (
  SELECT *, CASE WHEN {{live}} THEN coalesce(lv, 0) + coalesce(rv, 0) END AS v FROM now),
moved AS (
  SELECT *, lag(v) OVER (PARTITION BY user_id ORDER BY ts, side, event_id) AS before FROM joined)
SELECT user_id, event_id, side, CAST(v AS DOUBLE) AS value FROM moved
WHERE v IS NOT NULL OR before IS NOT NULL"""
LIVE = {"inner": "lv IS NOT NULL AND rv IS NOT NULL", "left": "lv IS NOT NULL",
        "outer": "lv IS NOT NULL OR rv IS NOT NULL"}


def _tables(spark, d):
    return balances(spark, d), by_user(spark, d, "click").to_table()


def _register(kind, how):
    def joined(spark, d):
        left, right = _tables(spark, d)
        return {"inner": left.join, "left": left.left_join, "outer": left.outer_join}[kind](
            right, add)

    @query(f"table_{kind}_join", SNAPSHOTS.format(how=how))
    def snapshot(spark, d):
        return joined(spark, d).snapshot().select(
            F.col("key").alias("user_id"), as_double("value").alias("value"))

    @query(f"table_{kind}_join_changelog", CHANGES.format(live=LIVE[kind]))
    def changelog(spark, d):
        return out(joined(spark, d).updates(), ("offset", "event_id"), ("side", "side"))


for _kind, _how in (("inner", "INNER"), ("left", "LEFT"), ("outer", "FULL")):
    _register(_kind, _how)


# -- foreign keys ---------------------------------------------------------------------------


@query("fk_join", """
SELECT o_orderkey, o_totalprice AS price, c_name AS name, c_acctbal AS balance
FROM orders JOIN customer ON o_custkey = c_custkey""")
def fk_join(spark, d):
    joined = orders_log(spark, d).to_table().join(
        customers(spark, d), lambda v: v["o_custkey"], _priced)
    df = joined.snapshot()
    return df.select(F.col("key").alias("o_orderkey"), as_double("value.price").alias("price"),
                     F.col("value.name").alias("name"),
                     as_double("value.balance").alias("balance"))


# A view refers to a neighbouring user; users' balances come and go.
FK = "user_id // 2 + event_id % 3"
FK_CHANGES = f"""
WITH l AS (
  SELECT user_id, v, {FK} AS fk, {{'ts': ts, 'side': 0, 'id': event_id}} AS a,
    lead({{'ts': ts, 'side': 0, 'id': event_id}}) OVER (
      PARTITION BY user_id ORDER BY ts, event_id) AS b FROM ({VIEWS})),
r AS (
  SELECT * FROM (
    SELECT user_id, v, {{'ts': ts, 'side': 1, 'id': event_id}} AS a,
      lead({{'ts': ts, 'side': 1, 'id': event_id}}) OVER (
        PARTITION BY user_id ORDER BY ts, event_id) AS b FROM ({ACCOUNTS})) WHERE v IS NOT NULL),
pairs AS (
  SELECT l.user_id, l.v + r.v AS v, greatest(l.a, r.a) AS a,
    CASE WHEN l.b IS NULL THEN r.b WHEN r.b IS NULL THEN l.b ELSE least(l.b, r.b) END AS b
  FROM l JOIN r ON l.fk = r.user_id
  WHERE (l.b IS NULL OR r.a < l.b) AND (r.b IS NULL OR l.a < r.b)),
moves AS (
  SELECT user_id, a AS p, v FROM pairs
  UNION ALL SELECT user_id, b, NULL FROM pairs WHERE b IS NOT NULL)
SELECT user_id, p.id AS event_id, p.side AS side, CAST(max(v) AS DOUBLE) AS value
FROM moves GROUP BY user_id, p"""


def referring(views, accounts):
    left = Log(views.df.withColumn("value", F.struct(
        F.col("value").alias("amount"), F.expr("key div 2 + offset % 3").alias("fk"))), views.order)
    return left.to_table().join(accounts, lambda v: v["fk"], lambda a, b: a["amount"] + b)


@query("fk_join_changelog", FK_CHANGES)
def fk_join_changelog(spark, d):
    return out(referring(by_user(spark, d, "view"), balances(spark, d)).updates(), ("offset", "event_id"), ("side", "side"))


# -- two logs, within a time window ------------------------------------------------------------

NEAR = JoinWindows(before_ms=12 * 3_600_000, after_ms=24 * 3_600_000)
PURCHASES = f"SELECT user_id, ts, event_id, v FROM ({EVENTS}) WHERE event_type = 'purchase'"
WINDOWED = f"""
SELECT coalesce(l.user_id, r.user_id) AS user_id, l.event_id AS event_id,
  r.event_id AS other_id, CAST(coalesce(l.v, 0) + coalesce(r.v, 0) AS DOUBLE) AS value
FROM ({VIEWS}) l {{how}} JOIN ({PURCHASES}) r ON l.user_id = r.user_id
  AND r.ts BETWEEN l.ts - INTERVAL '12 hours' AND l.ts + INTERVAL '24 hours'"""
EAGER = f"""
{WINDOWED.format(how='INNER')}
UNION ALL
SELECT user_id, event_id, NULL, CAST(v AS DOUBLE) FROM ({VIEWS}) l WHERE NOT EXISTS (
  SELECT 1 FROM ({PURCHASES}) r WHERE l.user_id = r.user_id
    AND r.ts >= l.ts - INTERVAL '12 hours' AND r.ts < l.ts)
UNION ALL
SELECT user_id, NULL, event_id, CAST(v AS DOUBLE) FROM ({PURCHASES}) r WHERE NOT EXISTS (
  SELECT 1 FROM ({VIEWS}) l WHERE l.user_id = r.user_id
    AND l.ts >= r.ts - INTERVAL '24 hours' AND l.ts <= r.ts)"""


def _near(spark, d):
    return by_user(spark, d, "view"), by_user(spark, d, "purchase")


def _pairs(log):
    return out(log, ("offset", "event_id"), ("other_offset", "other_id"))


@query("windowed_join", WINDOWED.format(how="INNER"))
def windowed_join(spark, d):
    left, right = _near(spark, d)
    return _pairs(left.join_windowed(right, add, NEAR))


@query("windowed_left_join", WINDOWED.format(how="LEFT"))
def windowed_left_join(spark, d):
    left, right = _near(spark, d)
    return _pairs(left.left_join_windowed(right, add, NEAR))


@query("windowed_outer_join", WINDOWED.format(how="FULL"))
def windowed_outer_join(spark, d):
    left, right = _near(spark, d)
    return _pairs(left.outer_join_windowed(right, add, NEAR))


@query("windowed_outer_join_eager", EAGER)
def windowed_outer_join_eager(spark, d):
    left, right = _near(spark, d)
    return _pairs(left.outer_join_windowed(right, add, NEAR, eager=True))
