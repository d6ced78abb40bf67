"""Whole applications: word count, ledger, pipe."""

from dataclasses import replace

from pyspark.sql import functions as F

from tidelog import session
from tidelog.functions.scalars import NIL_UUID, uuid_v5, words
from tidelog.operators.log import Log
from tidelog.operators.reducers import total
from tidelog.operators.validate import validate
from tidelog.plans.registry import EVENTS, amounts, as_double, query, table
from tidelog.sources.sinks import write_log
from tidelog.sources.topics import Topic, read_log


def word_count(lines: Log):
    """How often each word came so far."""
    return lines.flat_map_values(words).group_by(lambda k, v: v).count()


WORDS = r"""
SELECT *, unnest(w) AS word, unnest(range(len(w))) AS pos FROM (
  SELECT *, CASE WHEN len(p) > 1 AND p[len(p)] = ''
    THEN CASE WHEN len(p) = 2 AND p[1] = '' THEN [] ELSE p[1:len(p) - 1] END ELSE p END AS w
  FROM (SELECT *, regexp_split_to_array(lower(text), '\W+') AS p FROM {}))"""


@query("word_count", f"SELECT word, count(*) AS n FROM ({WORDS.format('documents')}) GROUP BY word")
def word_count_documents(spark, d):
    lines = Log.of(table(spark, d, "documents"), "doc_id", "text", F.lit(0), "doc_id")
    return word_count(lines).snapshot().select(F.col("key").alias("word"),
                                               F.col("value").alias("n"))


@query("word_count_changelog", f"""
SELECT word, conv_id, turn, CAST(pos AS INTEGER) AS pos, row_number() OVER (
  PARTITION BY word ORDER BY conv_id, turn, pos) AS n FROM ({WORDS.format('conversations')})""")
def word_count_conversations(spark, d):
    lines = Log.of(table(spark, d, "conversations"), "conv_id", "text", "conv_id", "turn")
    log = word_count(lines).updates()
    return log.df.select(F.col("key").alias("word"), F.col("ts").alias("conv_id"),
                         F.col("offset").alias("turn"), F.col(log.order[-1]).alias("pos"),
                         F.col("value").alias("n"))


# -- ledger ---------------------------------------------------------------------------------

ENTRY_RULES = {
    "entries": lambda k, v: F.size(v["entries"]) > 0,
    "accounts": lambda k, v: F.forall(
        v["entries"], lambda e: e["debit_account_name"] != e["credit_account_name"]),
    "amount": lambda k, v: F.forall(v["entries"], lambda e: e["amount"] > 0),
}


# Rows of an account that a task may hold: a row takes some 170 bytes there.
ACCOUNT_ROWS = 2_000_000


def ledger(requests: Log) -> Log:
    """Turn entry requests into account transactions with running balances.

    A request's entries each debit one account and credit another; invalid
    requests are left out.  An account that takes part in a large share of all
    entries is no hot spot: the running sum splits its history.
    """
    valid = validate(requests, ENTRY_RULES, "drop")
    side = lambda e, name, sign: F.struct(e[name].alias("key"), (e["amount"] * sign).alias("value"))
    sides = lambda k, v: F.flatten(F.transform(v["entries"], lambda e: F.array(
        side(e, "debit_account_name", -1), side(e, "credit_account_name", 1))))
    # ids are made from whole rows, after the arrays are taken apart
    flat = valid._with(valid.df.withColumn("causation_id", F.col("value.id"))).flat_map(sides)
    place = flat.order[-1]
    # several passes follow: entries are taken apart in one of their own
    rows = flat.df if flat.streaming else session.pinned(flat.df)
    # the running sum replaces the value, so the amount rides along beside it; rows of an account are
    # sorted together, and hold nothing that their other columns give
    riding = flat._with(rows.withColumn("amount", F.col("value")))
    balances = replace(riding.group_by_key(), most=ACCOUNT_ROWS).reduce(total()).updates()
    before = F.col("value") - F.col("amount")
    value = F.struct(
        F.col("key").alias("account_name"), "amount",
        uuid_v5(F.col("causation_id"), F.col(place).cast("string")).alias("id"), "causation_id",
        before.alias("starting_balance"), F.col("value").alias("current_balance"))
    out = balances.df.withColumn("value", value).drop("amount", "causation_id")
    return balances._with(out)


REQUESTS = """
SELECT o_orderkey, o_orderdate, CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS cents,
  'customer ' || o_custkey AS customer, o_orderpriority, 'status ' || o_orderstatus AS status
FROM orders"""
LEDGER = f"""
WITH sides AS (
  SELECT o_orderkey, o_orderdate, 0 AS pos, customer AS account, -cents AS amount FROM ({REQUESTS})
  UNION ALL SELECT o_orderkey, o_orderdate, 1, o_orderpriority, cents FROM ({REQUESTS})
  UNION ALL SELECT o_orderkey, o_orderdate, 2, o_orderpriority, -(o_orderkey % 7) FROM ({REQUESTS})
  UNION ALL SELECT o_orderkey, o_orderdate, 3, status, o_orderkey % 7 FROM ({REQUESTS})),
ids AS (
  SELECT o_orderkey, substr(h, 1, 8) || substr(h, 9, 4) || '5' || substr(h, 14, 3)
    || substr('89ab', (('0x' || substr(h, 17, 1))::INTEGER % 4) + 1, 1) || substr(h, 18, 3)
    || substr(h, 21, 12) AS x
  FROM (SELECT o_orderkey, sha1(unhex(repeat('0', 32)) || encode(CAST(o_orderkey AS VARCHAR))) AS h
        FROM orders)),
named AS (
  SELECT s.*, x, sha1(unhex(x) || encode(CAST(pos AS VARCHAR))) AS h
  FROM sides s JOIN ids USING (o_orderkey) WHERE o_orderkey % 7 > 0)
SELECT o_orderkey, account, CAST(amount AS BIGINT) AS amount,
  substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
    || substr('89ab', (('0x' || substr(h, 17, 1))::INTEGER % 4) + 1, 1) || substr(h, 18, 3) || '-'
    || substr(h, 21, 12) AS id,
  substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-' || substr(x, 13, 4) || '-' || substr(x, 17, 4)
    || '-' || substr(x, 21, 12) AS causation_id,
  CAST(sum(amount) OVER w - amount AS BIGINT) AS starting_balance,
  CAST(sum(amount) OVER w AS BIGINT) AS current_balance
FROM named WINDOW w AS (PARTITION BY account ORDER BY o_orderdate, o_orderkey, pos
                        ROWS UNBOUNDED PRECEDING)"""


def requests(spark, d) -> Log:
    """Each order as a request of two entries; those with an empty second amount are invalid."""
    df = table(spark, d, "orders")
    cents = (F.col("o_totalprice").cast("decimal(12,2)") * 100).cast("long")
    entry = lambda debit, credit, amount: F.struct(
        debit.alias("debit_account_name"), credit.alias("credit_account_name"),
        amount.alias("amount"))
    customer = F.concat(F.lit("customer "), F.col("o_custkey").cast("string"))
    status = F.concat(F.lit("status "), F.col("o_orderstatus"))
    value = F.struct(
        uuid_v5(F.lit(NIL_UUID), F.col("o_orderkey").cast("string")).alias("id"),
        F.array(entry(customer, F.col("o_orderpriority"), cents),
                entry(F.col("o_orderpriority"), status, F.col("o_orderkey") % 7)).alias("entries"))
    return Log.of(df, "o_orderkey", value, "o_orderdate", "o_orderkey")


@query("ledger_balances", LEDGER)
def ledger_balances(spark, d):
    log = ledger(requests(spark, d))
    return log.df.select(F.col("offset").alias("o_orderkey"), F.col("value.account_name").alias(
        "account"), "value.amount", "value.id", "value.causation_id", "value.starting_balance",
        "value.current_balance")


# -- pipe -------------------------------------------------------------------------------------


@query("pipe_copy", f"""
SELECT user_id, event_id, CAST(v AS DOUBLE) AS value FROM ({EVENTS})""")
def pipe_copy(spark, d):
    """Copy one topic to another unchanged, measuring what passes."""
    topics = [Topic(n, "bigint", "decimal(12,2)", path=session.shared_folder(spark, n))
              for n in ("input", "output")]
    write_log(amounts(spark, d), topics[0])
    log = read_log(spark, topics[0]).peek("passed")
    return log.through(topics[1]).df.select(F.col("key").alias("user_id"), F.col("offset").alias(
        "event_id"), as_double("value").alias("value"))


@query("pipe_mixed_formats", f"""
SELECT user_id, event_id, CAST(v AS DOUBLE) AS value FROM ({EVENTS})""")
def pipe_mixed_formats(spark, d):
    """From a JSON topic to an ORC topic."""
    folder = lambda n: session.shared_folder(spark, n)
    source = Topic("json", "bigint", "decimal(12,2)", path=folder("json"), format="json")
    sink = Topic("orc", "bigint", "decimal(12,2)", path=folder("orc"), format="orc")
    write_log(amounts(spark, d), source)
    return read_log(spark, source).through(sink).df.select(
        F.col("key").alias("user_id"), F.col("offset").alias("event_id"),
        as_double("value").alias("value"))
