"""Newest versions, client dimension, per-seller metrics, upserts and updates."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.catalog import testbed as tb
from weirflow.catalog.testbed import comparable, sql, table
from weirflow.functions import rules
from weirflow.functions.dates import ts
from weirflow.operators.joins import with_client
from weirflow.operators.versions import (
    close_and_open, newest, recent_open, replace_into, update_from,
)
from weirflow.plans.sellers import ORDER_TYPES, seller_metrics

QUERIES: dict = {}


def latest_version(spark, d):
    return comparable(tb.items(spark, d))


QUERIES["latest_version"] = (
    latest_version,
    sql(tb.ITEMS, """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
      l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
      CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM items"""),
)


def client_enrich(spark, d):
    return comparable(
        with_client(tb.raw_users(spark, d).select("client", "tree_user_id", "email"), tb.clients(spark, d))
    )


QUERIES["client_enrich"] = (
    client_enrich,
    sql(tb.RAW_USERS, tb.CLIENTS, """SELECT c.client, c.client_partition_id, c.client_score_id, u.tree_user_id, u.email
      FROM raw_users u JOIN clients c ON u.client = c.client"""),
)

# --- metrics per seller ----------------------------------------------------------------------

REVISION_ORDER = ["l_linenumber", "l_shipdate", *[c for c in tb.ITEM_ORDER if c != "l_shipdate"]]


def revised_orders(spark, d):
    """Orders whose total is that of their newest revision in the item log."""
    log = newest(table(spark, d, "lineitem"), ["l_orderkey"], REVISION_ORDER)
    revised = log.select(F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").cast(tb.MONEY).alias("total"))
    keyed = tb.raw_orders(spark, d).drop("total").join(revised, "order_id")
    return keyed.join(tb.users(spark, d).select("tree_user_id", "client"), "tree_user_id")


def distributor_order_metrics(spark, d):
    people = tb.users(spark, d).select("client", "tree_user_id", "created", "client_status", F.col("type").alias("client_type"))
    return comparable(seller_metrics(people, revised_orders(spark, d), tb.clients(spark, d), ts(tb.AS_OF)))


def _metrics_sql() -> str:
    out = []
    for name, kind in ORDER_TYPES.items():
        counted = "1" if name in ("wholesale", "retail") else "total"
        own = f"type = '{kind}'"
        recent = f"{own} AND order_date >= TIMESTAMP '{tb.AS_OF}' - INTERVAL 1 YEAR"
        out.append(f"""
          CASE WHEN count(CASE WHEN {own} THEN 1 END) > 0 THEN count(CASE WHEN {own} THEN {counted} END) END AS lifetime_total_{name}_count,
          sum(total) FILTER ({own}) AS lifetime_total_{name}_amount,
          sum(total) FILTER ({own}) AS la_{name}, count(*) FILTER ({own}) AS ln_{name},
          CASE WHEN count(CASE WHEN {recent} THEN 1 END) > 0 THEN count(CASE WHEN {recent} THEN total END) END AS rolling_12_month_total_{name}_count,
          sum(total) FILTER ({recent}) AS rolling_12_month_total_{name}_amount,
          count(*) FILTER ({recent}) AS rn_{name},
          min(order_date) FILTER ({own}) AS f_{name}, max(order_date) FILTER ({own}) AS l_{name}""")
    outer = []
    for name in ORDER_TYPES:
        outer.append(f"""
          m.lifetime_total_{name}_count, CAST(m.lifetime_total_{name}_amount AS DOUBLE) AS lifetime_total_{name}_amount,
          round(CAST(m.la_{name} AS DOUBLE) / NULLIF(m.ln_{name}, 0), 6) AS lifetime_avg_{name}_amount,
          m.rolling_12_month_total_{name}_count,
          CAST(m.rolling_12_month_total_{name}_amount AS DOUBLE) AS rolling_12_month_total_{name}_amount,
          round(CAST(m.rolling_12_month_total_{name}_amount AS DOUBLE) / NULLIF(m.rn_{name}, 0), 6) AS rolling_12_month_avg_{name}_amount,
          date_diff('day', CAST(u.created AS DATE), CAST(m.f_{name} AS DATE)) AS days_to_first_{name}_order,
          date_diff('day', CAST(m.l_{name} AS DATE), DATE '{tb.AS_OF[:10]}') AS days_since_last_{name}_order""")
    order = ", ".join(f"{c} DESC" for c in REVISION_ORDER)
    return sql(
        *tb.PEOPLE, tb.RAW_ORDERS,
        f"""revision AS (SELECT l_orderkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS total FROM (
             SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {order}) AS rn FROM lineitem) WHERE rn = 1)""",
        f"""m AS (SELECT o.tree_user_id, {', '.join(out)}
             FROM (SELECT o.* EXCLUDE (total), r.total FROM raw_orders o JOIN revision r ON o.order_id = r.l_orderkey) o
             GROUP BY o.tree_user_id)""",
        f"""SELECT u.client_partition_id, u.client_score_id, u.client, u.tree_user_id, {', '.join(outer)}
            FROM users u LEFT JOIN m ON u.tree_user_id = m.tree_user_id
            WHERE u.type = 'Distributor' AND lower(u.client_status) IN ('active', 'grace')""",
    )


QUERIES["distributor_order_metrics"] = (distributor_order_metrics, _metrics_sql())

# --- upserts ---------------------------------------------------------------------------------


def replace_into_query(spark, d):
    """The line table as of a shipping date, upserted with the later revisions of its lines."""
    log = table(spark, d, "lineitem")
    split = ts("1999-01-01 00:00:00")
    target = newest(log.filter(F.col("l_shipdate") < split), tb.ITEM_KEYS, tb.ITEM_ORDER)
    changes = log.filter(F.col("l_shipdate") >= split)
    out = replace_into(target, changes, tb.ITEM_KEYS, tb.ITEM_ORDER)
    return comparable(out.select(*tb.ITEM_KEYS, "l_shipdate", "l_extendedprice", "l_suppkey"))


QUERIES["replace_into"] = (
    replace_into_query,
    sql(tb.ITEMS, """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
      CAST(l_shipdate AS VARCHAR) AS l_shipdate, l_extendedprice, l_suppkey FROM items"""),
)


def update_from_join(spark, d):
    """Type and owner of orders set from their buyer, as in UPDATE ... FROM."""
    target = tb.raw_orders(spark, d).withColumn("commission_user_id", F.lit(None).cast("long"))
    source = tb.users(spark, d).select("tree_user_id", "type", "sponsor_id", "coded")
    kind, coded, day = F.col("src_type"), F.col("coded"), F.col("order_date")
    out = update_from(
        target, source, ["tree_user_id"],
        {
            "type": rules.staged_order_type(kind, coded, day),
            "commission_user_id": rules.commission_owner(kind, F.col("tree_user_id"), F.col("sponsor_id"), coded, day),
        },
        only=F.col("status") != "Cancelled",
    )
    return comparable(out.select("order_id", "tree_user_id", "type", "status", "commission_user_id"))


QUERIES["update_from_join"] = (
    update_from_join,
    sql(*tb.PEOPLE, tb.RAW_ORDERS, """SELECT o.order_id, o.tree_user_id, o.status,
      CASE WHEN o.status = 'Cancelled' THEN o.type
           WHEN u.type = 'Distributor' AND u.coded <= o.order_date THEN 'Wholesale'
           WHEN u.type = 'Distributor' THEN 'Autoship'
           WHEN u.type = 'Autoship' THEN 'Autoship' END AS type,
      CASE WHEN o.status = 'Cancelled' THEN NULL
           WHEN u.type <> 'Distributor' OR u.coded > o.order_date THEN u.sponsor_id
           ELSE u.tree_user_id END AS commission_user_id
      FROM raw_orders o JOIN users u ON o.tree_user_id = u.tree_user_id"""),
)


def runs(spark, d):
    """Orders as runs of a job: P still running, the urgent of them already ended."""
    o = table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("run_id"),
        F.concat(F.lit("f"), F.col("o_custkey").cast("string")).alias("file"),
        F.when(F.col("o_orderstatus") == "P", "running").otherwise("uploaded").alias("status"),
        F.col("o_orderdate").alias("start_date"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderdate")).alias("end_date"),
    )


RUNS = """runs AS (
  SELECT o_orderkey AS run_id, 'f' || o_custkey AS file,
         CASE WHEN o_orderstatus = 'P' THEN 'running' ELSE 'uploaded' END AS status,
         o_orderdate AS start_date,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate END AS end_date FROM orders)"""


def status_history(spark, d):
    """Open runs closed with the state their newest line reports, unless it still runs."""
    log = newest(table(spark, d, "lineitem"), ["l_orderkey"], REVISION_ORDER)
    states = log.select(
        F.col("l_orderkey").alias("run_id"),
        F.when(F.col("l_linestatus") == "O", "RUNNING").otherwise("SUCCEEDED").alias("status"),
    )
    return comparable(close_and_open(runs(spark, d), states, ts(tb.AS_OF), ["run_id"]))


QUERIES["status_history"] = (
    status_history,
    sql(
        RUNS,
        f"""states AS (SELECT l_orderkey AS run_id FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
              ORDER BY {', '.join(f'{c} DESC' for c in REVISION_ORDER)}) AS rn FROM lineitem)
            WHERE rn = 1 AND l_linestatus <> 'O')""",
        f"""SELECT r.run_id, r.file, r.status, CAST(r.start_date AS VARCHAR) AS start_date,
              CAST(CASE WHEN r.status = 'running' AND r.end_date IS NULL AND s.run_id IS NOT NULL
                   THEN TIMESTAMP '{tb.AS_OF}' ELSE r.end_date END AS VARCHAR) AS end_date
            FROM runs r LEFT JOIN states s ON r.run_id = s.run_id
            UNION ALL
            SELECT r.run_id, r.file, 'succeeded', '{tb.AS_OF}', NULL
            FROM runs r JOIN states s ON r.run_id = s.run_id
            WHERE r.status = 'running' AND r.end_date IS NULL""",
    ),
)


def open_recent(spark, d):
    return comparable(recent_open(runs(spark, d), ts(tb.AS_OF), 24 * 365))


QUERIES["open_recent"] = (
    open_recent,
    sql(RUNS, f"""SELECT run_id, file, status, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date
      FROM runs WHERE status = 'running' AND end_date IS NULL
      AND date_diff('hour', start_date, TIMESTAMP '{tb.AS_OF}') <= {24 * 365}"""),
)
