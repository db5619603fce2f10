"""Windows, changed keys, checkpoints, increments, file order and key ranges."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from weirflow.catalog import testbed as tb
from weirflow.catalog.testbed import comparable, sql, table
from weirflow.functions.dates import ts
from weirflow.lineage import work_folder
from weirflow.operators.increments import (
    FIRST_MARK, advance, all_versions_of, changed_keys, in_window, next_window,
    not_yet_scored,
)
from weirflow.operators.keyed_log import append_log, range_size, versions_of
from weirflow.operators.versions import newest
from weirflow.plans.refine import leads, people
from weirflow.sources.readers import key_ranges, profile, select_files

QUERIES: dict = {}


def register(name, sql_text):
    def add(fn):
        QUERIES[name] = (lambda spark, d: comparable(fn(spark, d)), sql_text)
        return fn
    return add


# --- windows ---------------------------------------------------------------------------------

FIRST, MIDDLE, LAST = "1997-01-01 00:00:00", "1998-06-01 00:00:00", "2000-01-01 00:00:00"


def lead_log(spark, d):
    """Orders as versions of a lead: the buyer is the lead, bought leads are the F orders."""
    o = table(spark, d, "orders")
    people_ = tb.raw_users(spark, d).select("tree_user_id", "client", "email")
    log = o.select(
        F.col("o_custkey").alias("id"),
        # order key breaks ties in the ingestion time: later keys a microsecond later
        (F.col("o_orderdate") + F.expr("make_dt_interval(0, 0, 0, CAST(o_orderkey AS DECIMAL(18,6)) / 1000000)")).alias("ingestion_timestamp"),
        (F.col("o_orderstatus") == "F").alias("purchased"),
        F.col("o_orderpriority").alias("message"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
    )
    return log.join(people_, log.id == F.col("tree_user_id")).drop("tree_user_id")


LEAD_LOG = """lead_log AS (
  SELECT o_custkey AS id, o_orderdate + to_microseconds(o_orderkey) AS ingestion_timestamp,
         o_orderstatus = 'F' AS purchased, o_orderpriority AS message, o_orderdate AS created_at,
         o_orderdate AS updated_at, u.client, u.email
  FROM orders o JOIN raw_users u ON o.o_custkey = u.tree_user_id)"""


def _newest_lead(first: str, last: str) -> str:
    return f"""picked AS (SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY client, id ORDER BY ingestion_timestamp DESC) AS rn
      FROM lead_log WHERE ingestion_timestamp >= TIMESTAMP '{first}' AND ingestion_timestamp < TIMESTAMP '{last}') WHERE rn = 1)"""


@register("staging_contacts", sql(tb.RAW_USERS, LEAD_LOG, tb.CLIENTS, _newest_lead(FIRST, LAST), f"""
  SELECT p.client, c.client_partition_id, p.id, p.email, p.message, p.purchased,
    CAST(p.created_at AS VARCHAR) AS created_at, CAST(p.updated_at AS VARCHAR) AS updated_at,
    '{LAST}' AS ingestion_timestamp
  FROM picked p JOIN clients c ON p.client = c.client"""))
def staging_contacts(spark, d):
    return people(lead_log(spark, d), tb.clients(spark, d), FIRST, LAST, LAST)


@register("window_filter", sql(tb.RAW_USERS, LEAD_LOG, tb.CLIENTS, _newest_lead(FIRST, LAST), f"""
  SELECT p.client, c.client_partition_id, p.id AS lead_id, p.email, p.message, p.purchased,
    CAST(p.created_at AS VARCHAR) AS created, CAST(p.updated_at AS VARCHAR) AS modified,
    '{LAST}' AS ingestion_timestamp
  FROM picked p JOIN clients c ON p.client = c.client WHERE NOT purchased"""))
def window_filter(spark, d):
    return leads(lead_log(spark, d), tb.clients(spark, d), FIRST, LAST, LAST)


@register("adjacent_windows", f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CASE WHEN l_shipdate < TIMESTAMP '{MIDDLE}' THEN 1::BIGINT ELSE 2::BIGINT END AS part
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '{FIRST}' AND l_shipdate < TIMESTAMP '{LAST}'""")
def adjacent_windows(spark, d):
    log = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    one = in_window(log, FIRST, MIDDLE, "l_shipdate").withColumn("part", F.lit(1))
    two = in_window(log, MIDDLE, LAST, "l_shipdate").withColumn("part", F.lit(2))
    return one.unionByName(two).drop("l_shipdate")


@register("changed_keys", sql(
    f"""touched AS (
      SELECT o_orderkey AS order_id FROM orders WHERE o_orderdate >= TIMESTAMP '{MIDDLE}' AND o_orderdate < TIMESTAMP '{LAST}'
      UNION SELECT l_orderkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '{MIDDLE}' AND l_shipdate < TIMESTAMP '{LAST}')""",
    tb.ITEMS,
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_shipdate AS VARCHAR) AS l_shipdate, l_extendedprice
       FROM items WHERE l_orderkey IN (SELECT order_id FROM touched)"""))
def changed(spark, d):
    """Newest lines of every order touched in a window, itself or through a line."""
    log, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    touched = changed_keys(
        (in_window(orders, MIDDLE, LAST, "o_orderdate"), {"order_id": "o_orderkey"}),
        (in_window(log, MIDDLE, LAST, "l_shipdate"), {"order_id": "l_orderkey"}),
    )
    versions = all_versions_of(log, touched, {"order_id": "l_orderkey"})
    return newest(versions, tb.ITEM_KEYS, tb.ITEM_ORDER).select(*tb.ITEM_KEYS, "l_shipdate", "l_extendedprice")


KEYED = {"size": 2_000, "buckets": 4}  # of the log below while it is small


@register("keyed_log", QUERIES["changed_keys"][1])
def keyed(spark, d):
    """The same from a log laid out by key, appended to twice: only ranges that hold a changed key are read."""
    name, folder = f"weirflow_{uuid.uuid4().hex}", work_folder(spark)
    log, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    layout = KEYED | {"size": range_size(log, "l_orderkey", KEYED["size"])}
    for late in (False, True):
        append_log(log.filter((F.col("l_shipdate") >= ts(MIDDLE)) == late), name, ["l_orderkey"], **layout)
    touched = changed_keys(
        (in_window(orders, MIDDLE, LAST, "o_orderdate"), {"l_orderkey": "o_orderkey"}),
        (in_window(log, MIDDLE, LAST, "l_shipdate"), {"l_orderkey": "l_orderkey"}),
    )
    versions = versions_of(spark, name, touched, ["l_orderkey"], layout["size"])
    newest(versions, tb.ITEM_KEYS, tb.ITEM_ORDER).select(*tb.ITEM_KEYS, "l_shipdate", "l_extendedprice").write.parquet(folder)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(folder)


# --- checkpoints -----------------------------------------------------------------------------

CAP = 1000
MARKS = [("refine", "orders", MIDDLE), ("refine", "late", "2030-01-01 00:00:00")]
TARGETS = ["orders", "first_run", "late"]


def checkpoints(spark):
    return spark.createDataFrame(MARKS, "job string, target string, mark string").select(
        "job", "target", ts(F.col("mark").cast("timestamp_ntz")).alias("mark")
    )


def windows(spark, d):
    sources = {
        "orders": table(spark, d, "orders").select(F.col("o_orderdate").alias("ingestion_timestamp")),
        "items": table(spark, d, "lineitem").select(F.col("l_shipdate").alias("ingestion_timestamp")),
    }
    out = None
    for target in TARGETS:
        part = next_window(checkpoints(spark), "refine", target, sources, cap=CAP)
        out = part if out is None else out.unionByName(part)
    return out


def _window_sql(select: str) -> str:
    parts = []
    marks = {t: m for _, t, m in MARKS}
    for target in TARGETS:
        mark = marks.get(target, FIRST_MARK)
        parts.append(f"""SELECT 'refine' AS job, '{target}' AS target, TIMESTAMP '{mark}' AS "first", max(tm) + INTERVAL 1 MICROSECOND AS until,
          count(*) > 0 AS has_data FROM (SELECT tm, src FROM pairs WHERE tm >= TIMESTAMP '{mark}' ORDER BY tm LIMIT {CAP})""")
    return sql(
        "pairs AS (SELECT DISTINCT o_orderdate AS tm, 'orders' AS src FROM orders UNION SELECT DISTINCT l_shipdate, 'items' FROM lineitem)",
        f"windows AS ({' UNION ALL '.join(parts)})",
        select,
    )


@register("checkpoint_next", _window_sql("""SELECT job, target, CAST(first AS VARCHAR) AS first,
  CAST(until AS VARCHAR) AS until, has_data FROM windows"""))
def checkpoint_next(spark, d):
    return windows(spark, d)


@register("checkpoint_upsert", _window_sql(f"""SELECT job, target, CAST(until AS VARCHAR) AS mark
  FROM windows WHERE has_data
  UNION ALL SELECT 'refine', 'late', '{MARKS[1][2]}'"""))
def checkpoint_upsert(spark, d):
    return advance(checkpoints(spark), windows(spark, d))


# --- increments ------------------------------------------------------------------------------


def scored(spark, d):
    """Suppliers with a returned line count as scored."""
    lines = table(spark, d, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 50))
    return lines.select(F.concat(F.lit("e"), F.col("l_suppkey").cast("string")).alias("entity_id")).distinct()


@register("anti_unscored", sql(tb.ENTITIES, f"""SELECT DISTINCT entity_id FROM entities
  WHERE date_sub('hour', ingestion_timestamp, TIMESTAMP '{tb.AS_OF}') <= 480
  AND entity_id NOT IN (SELECT 'e' || l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 50)"""))
def anti_unscored(spark, d):
    return not_yet_scored(tb.entities(spark, d), scored(spark, d), ts(tb.AS_OF), 480)


# --- files, ranges, profile ------------------------------------------------------------------


@register("file_order", """SELECT path, TRY_CAST(regexp_extract(path, '-(\\d+)$', 1) AS BIGINT) AS file_seq FROM (
   SELECT 'in/' || o_orderstatus || '/cdc_' || o_orderpriority || '-' || o_orderkey AS path FROM orders)
   WHERE regexp_extract(path, '([^/]+)$', 1) LIKE 'cdc\\_5%' ESCAPE '\\' AND regexp_extract(path, '([^/]+)$', 1) LIKE '%LOW%'""")
def file_order(spark, d):
    listing = table(spark, d, "orders").select(
        F.concat(F.lit("in/"), F.col("o_orderstatus"), F.lit("/cdc_"), F.col("o_orderpriority"), F.lit("-"),
                 F.col("o_orderkey").cast("string")).alias("path")
    )
    return select_files(listing, "path", "cdc_5", "LOW").orderBy("file_seq", "path")


@register("range_plan", """SELECT r.low, LEAST(r.low + 999, b.hi) AS high, COUNT(o.o_orderkey) AS n
  FROM (SELECT MIN(o_orderkey) AS lo, MAX(o_orderkey) AS hi FROM orders) b, range(b.lo, b.hi + 1, 1000) r(low)
  LEFT JOIN orders o ON o.o_orderkey BETWEEN r.low AND LEAST(r.low + 999, b.hi) GROUP BY ALL""")
def range_plan(spark, d):
    """Key ranges of the orders and the rows each would read."""
    orders = table(spark, d, "orders").select("o_orderkey")
    ranges = key_ranges(orders, "o_orderkey", 1000)
    low = orders.agg(F.min("o_orderkey")).scalar()
    per_range = orders.groupBy((F.floor((F.col("o_orderkey") - low) / 1000) * 1000 + low).alias("low")).agg(F.count("*").alias("n"))
    return ranges.join(per_range, "low", "left").select("low", "high", F.coalesce("n", F.lit(0)).alias("n"))


PROFILED = [
    ("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"), ("customer", None),
    ("supplier", None), ("part", None), ("documents", None), ("labels", None), ("pages", None), ("conversations", None),
    ("region", None), ("nation", None), ("embeddings", None), ("benchmark", None),
]


def _profile_sql() -> str:
    parts = []
    for name, at in PROFILED:
        low = f"CAST(min({at}) AS VARCHAR)" if at else "CAST(NULL AS VARCHAR)"
        high = f"CAST(max({at}) AS VARCHAR)" if at else "CAST(NULL AS VARCHAR)"
        parts.append(f"SELECT '{name}' AS tbl, count(*) AS cnt, {low} AS min, {high} AS max FROM {name}")
    return " UNION ALL ".join(parts)


@register("data_profile", _profile_sql())
def data_profile(spark, d):
    return profile([(name, table(spark, d, name), at) for name, at in PROFILED])
