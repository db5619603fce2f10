"""Refinement into staging, one window and window after window, over change logs of the whole tables.

The logs hold several versions of a key, many rows at one ingestion time, and times on the windows' ends.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from weirflow.catalog import testbed as tb
from weirflow.catalog.testbed import comparable, sql, table
from weirflow.functions import fixed
from weirflow.lineage import drop_folder, work_folder
from weirflow.operators.increments import CHECKPOINT_SCHEMA, advance, next_window
from weirflow.operators.versions import newest
from weirflow.plans import refine

QUERIES: dict = {}


def register(name, sql_text):
    def add(fn):
        QUERIES[name] = (lambda spark, d: comparable(fn(spark, d)), sql_text)
        return fn
    return add


HOUSE, PLAIN = "EUROPE", "ASIA"
FIRST, UNTIL = "1996-02-01 00:00:00", "1998-06-01 00:00:00"
ALWAYS = ("1900-01-01 00:00:00", "2100-01-01 00:00:00")
BATCH = "2001-08-01 00:00:00"
KINDS = ["Distributor", "Customer", "Employee", "Pending Transfer", ""]
ORDER_KINDS = ["web", "phone", "mail"]
STATES = ["Shipped", "CC Declined", "Accepted"]
LEVELS = ["Star", "Gold", "Ruby", "Pearl", "Onyx"]


def _log(df, *columns: str):
    """A change log: client, event and time of ingestion, then the record's own columns."""
    return df.selectExpr("client", "event_eid", "ingestion_timestamp", *columns)


PEOPLE = [
    "c_custkey AS id", "CAST(c_custkey % 6 + 1 AS BIGINT) AS user_type_id", "CAST(c_nationkey % 4 + 1 AS BIGINT) AS user_status_id",
    "CASE WHEN c_custkey % 11 > 0 THEN c_custkey % 5 + 1 END AS rank_id", "c_custkey % 7 + 1 AS paid_rank_id",
    "CASE WHEN c_custkey > 0 THEN (c_custkey - 1) {div} 3 END AS sponsor_id", "c_custkey % 100 AS parent_id",
    "concat(CAST(c_nationkey AS {text}), '-', CAST(v AS {text})) AS zip", "{created} AS created_date",
    "ingestion_timestamp AS updated_date", "concat('first', CAST(v AS {text})) AS first_name", "c_name AS last_name",
    "CASE WHEN c_custkey % 9 = 0 THEN 'Acme' END AS company_name", "concat(CAST(c_custkey AS {text}), ' Road') AS address1",
    "CASE WHEN c_custkey % 2 = 0 THEN concat('Flat ', CAST(c_nationkey AS {text})) WHEN c_custkey % 3 = 0 THEN '' END AS address2",
    "'Town' AS city", "'ST' AS state", "c_mktsegment AS country", "concat('p', CAST(c_custkey AS {text}), '@mail.test') AS email",
    "CAST(c_acctbal AS {text}) AS phone", "CAST(NULL AS {text}) AS mobile_phone",
    "CASE c_custkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'male' WHEN 2 THEN 'x' END AS gender", "CAST({created} AS DATE) AS birth_date",
]
ORDERS = [
    "o_orderkey AS id", "o_custkey AS tree_user_id", "o_orderkey % 3 + 1 AS order_type_id", "o_orderkey % 4 + 1 AS order_status_id",
    "o_orderkey % 3 - 1 AS autoship_template_id", "o_orderdate AS order_date",
    "CAST(o_totalprice + v AS DECIMAL(18,2)) AS total",
]
ITEMS = [
    "l_orderkey * 10 + l_linenumber AS id", "l_orderkey AS order_id", "l_partkey AS product_id",
    "concat('P', CAST(l_partkey % 50 AS {text})) AS product_code", "l_returnflag AS product_description",
    "CAST(l_quantity AS BIGINT) AS quantity", "CAST(l_discount AS DECIMAL(18,2)) AS price_each",
    "CAST(l_extendedprice AS DECIMAL(18,2)) AS price_total",
]
SPARK = {"div": "div", "text": "STRING", "created": "TIMESTAMP_NTZ'1995-01-01 00:00:00' + make_dt_interval(CAST(c_custkey % 730 AS INT))"}
DUCK = {"div": "//", "text": "VARCHAR", "created": "TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(c_custkey % 730 AS INTEGER))"}
EVENT = "concat('z/', CAST(v AS {text})) AS event_eid"


def _columns(columns, words) -> list[str]:
    return [c.format(**words) for c in columns]


def owners(spark, d):
    return table(spark, d, "customer").join(tb.nations(spark, d), F.col("c_nationkey") == F.col("n_nationkey"))


def _versions(df, second: str):
    """Every row as version 0, and as version 1 too where ``second`` holds."""
    return df.withColumn("v", F.explode(F.when(F.expr(second), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))


def _stamped(df, at: str, later: str):
    return df.selectExpr("*", EVENT.format(**SPARK), f"{at} + v * {later} AS ingestion_timestamp")


def tree_users(spark, d):
    rows = _versions(owners(spark, d), "c_custkey % 3 = 0")
    stamped = _stamped(rows, "TIMESTAMP_NTZ'1996-01-01 00:00:00' + make_dt_interval(CAST(c_custkey % 40 AS INT) * 31)", "INTERVAL 40 DAYS")
    return _log(stamped, *_columns(PEOPLE, SPARK))


def accounts(spark, d):
    rows = _versions(owners(spark, d).filter("c_custkey % 4 > 0"), "c_custkey % 5 = 0")
    stamped = _stamped(rows, "TIMESTAMP_NTZ'1997-01-01 00:00:00' + make_dt_interval(CAST(c_custkey % 30 AS INT) * 31)", "INTERVAL 0 DAYS")
    return _log(stamped, "c_custkey * 10 + v AS id", "c_custkey AS tree_user_id")


def _owned_orders(spark, d):
    return table(spark, d, "orders").join(owners(spark, d).select("c_custkey", "client"), F.col("o_custkey") == F.col("c_custkey"))


def orders_log(spark, d):
    stamped = _stamped(_versions(_owned_orders(spark, d), "o_orderkey % 7 = 0"), "date_trunc('month', o_orderdate)", "INTERVAL 40 DAYS")
    return _log(stamped, *_columns(ORDERS, SPARK))


def items_log(spark, d):
    # by the key of the join that follows, so that the pairs are moved once
    clients = _owned_orders(spark, d).select("client", F.col("o_orderkey").alias("l_orderkey")).repartition("l_orderkey").distinct()
    rows = table(spark, d, "lineitem").join(clients, "l_orderkey").withColumn("v", F.lit(0))
    return _log(_stamped(rows, "date_trunc('month', l_shipdate)", "INTERVAL 0 DAYS"), *_columns(ITEMS, SPARK))


def _lookup(spark, d, names, *columns):
    """A lookup log: an outdated and a current version of each name of each client."""
    listed = F.posexplode(F.array(*[F.lit(n) for n in names])).alias("at", "name")
    rows = tb.clients(spark, d).select("client", listed).withColumn("v", F.explode(F.array(F.lit(0), F.lit(1))))
    return _log(_stamped(rows, "TIMESTAMP_NTZ'1990-01-01 00:00:00'", "INTERVAL 0 DAYS"), "CAST(at + 1 AS BIGINT) AS id",
                "CASE WHEN v = 1 THEN name ELSE 'outdated' END AS " + columns[0], *columns[1:])


def _duck_lookup(name, names, column) -> str:
    return f"{name} AS (SELECT r_name AS client, i AS id, ({names})[i] AS {column} FROM region, range(1, {len(names) + 1}) t(i))"


def _duck_log(name, source, second, at, later, columns) -> str:
    return f"""{name} AS (
      WITH versions AS (SELECT *, unnest(CASE WHEN {second} THEN [0, 1] ELSE [0] END) AS v FROM {source}),
      stamped AS (SELECT *, {EVENT.format(**DUCK)}, {at} + v * INTERVAL {later} DAY AS ingestion_timestamp FROM versions)
      SELECT client, event_eid, ingestion_timestamp, {', '.join(_columns(columns, DUCK))} FROM stamped)"""


OWNERS = "owners AS (SELECT c.*, r_name AS client FROM customer c JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
TREE = _duck_log("tree_users", "owners", "c_custkey % 3 = 0",
                 "TIMESTAMP '1996-01-01 00:00:00' + to_days(CAST(c_custkey % 40 AS INTEGER) * 31)", 40, PEOPLE)
ACCOUNTS = _duck_log("accounts", "(SELECT * FROM owners WHERE c_custkey % 4 > 0)", "c_custkey % 5 = 0",
                     "TIMESTAMP '1997-01-01 00:00:00' + to_days(CAST(c_custkey % 30 AS INTEGER) * 31)", 0,
                     ["c_custkey * 10 + v AS id", "c_custkey AS tree_user_id"])
ORDER_LOG = _duck_log("orders_log", "(SELECT o.*, client FROM orders o JOIN owners ON o_custkey = c_custkey)", "o_orderkey % 7 = 0",
                      "CAST(date_trunc('month', o_orderdate) AS TIMESTAMP)", 40, ORDERS)
ITEM_LOG = _duck_log("items_log", "(SELECT l.*, client FROM lineitem l JOIN (SELECT DISTINCT client, id FROM orders_log) o ON l_orderkey = id)",
                     "false", "CAST(date_trunc('month', l_shipdate) AS TIMESTAMP)", 0, ITEMS)
LOOKUPS = [_duck_lookup("kinds", KINDS, "description"), _duck_lookup("user_states", tb.STATUSES, "description"),
           _duck_lookup("levels", LEVELS, "name"), _duck_lookup("order_states", STATES, "description")]


def _names(columns) -> list[str]:
    return [c.rsplit(" AS ", 1)[1] for c in columns]


def _newest(log: str, keys: str, columns, where: str = "true") -> str:
    ties = [c for c in _names(columns) if c not in keys.split(", ")]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["event_eid", "ingestion_timestamp", *ties])
    return f"""(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn
      FROM {log} WHERE {where}) WHERE rn = 1)"""


def _inside(first: str, until: str) -> str:
    return f"ingestion_timestamp >= TIMESTAMP '{first}' AND ingestion_timestamp < TIMESTAMP '{until}'"


TYPED = """CASE {c} WHEN 'Distributor' THEN 'Distributor' WHEN 'Customer' THEN 'Autoship' WHEN 'Employee' THEN 'Autoship'
  WHEN 'Pending Transfer' THEN 'Distributor' END"""
PERSON = ["first_name", "last_name", "company_name", "city", "state", "country", "email", "phone", "mobile_phone"]


@register("pii_users", sql(OWNERS, TREE, tb.CLIENTS, f"""SELECT u.client, client_partition_id, client_score_id, event_eid,
  '{BATCH}' AS ingestion_timestamp, id AS tree_user_id, {', '.join(PERSON)},
  address1 || CASE WHEN address2 <> '' THEN ' ' || address2 ELSE '' END AS street,
  CASE WHEN gender IN ('F', 'female') THEN 'female' WHEN gender IN ('M', 'male') THEN 'male' ELSE 'none' END AS gender,
  CAST(birth_date AS VARCHAR) AS birth_date, CAST(created_date AS VARCHAR) AS created
  FROM {_newest('tree_users', 'client, id', PEOPLE, _inside(FIRST, UNTIL))} u JOIN clients c ON u.client = c.client
  WHERE sponsor_id IS NOT NULL AND user_type_id IS NOT NULL AND rank_id IS NOT NULL"""))
def pii_users(spark, d):
    return refine.pii_users(tree_users(spark, d), tb.clients(spark, d), FIRST, UNTIL, BATCH)


@register("staging_users", sql(OWNERS, TREE, ACCOUNTS, *LOOKUPS, tb.CLIENTS, f"""SELECT u.client, client_partition_id,
  client_score_id, u.event_eid, CAST(u.ingestion_timestamp AS VARCHAR) AS ingestion_timestamp, u.id AS tree_user_id,
  a.id AS user_id, sponsor_id, parent_id, zip, CAST(created_date AS VARCHAR) AS created,
  CAST(updated_date AS VARCHAR) AS modified, k.description AS client_type, s.description AS client_status,
  '' AS paid_rank, CAST(NULL AS BIGINT) AS paid_rank_level, p.name AS client_paid_rank, p.id AS client_paid_rank_level,
  '' AS lifetime_rank, CAST(NULL AS BIGINT) AS lifetime_rank_level, l.name AS client_lifetime_rank, l.id AS client_lifetime_rank_level,
  CASE u.client WHEN '{HOUSE}' THEN {TYPED.format(c='k.description')} ELSE k.description END AS type,
  CASE u.client WHEN '{HOUSE}' THEN CASE WHEN lower(s.description) IN ('active','grace','hold') THEN 'Active'
    WHEN s.description IS NOT NULL THEN 'Inactive' END END AS status
  FROM {_newest('tree_users', 'client, id', PEOPLE)} u JOIN clients c ON u.client = c.client
  LEFT JOIN {_newest('accounts', 'client, tree_user_id', ['x AS id', 'x AS tree_user_id'])} a ON a.client = u.client AND a.tree_user_id = u.id
  LEFT JOIN kinds k ON k.client = u.client AND k.id = user_type_id
  LEFT JOIN user_states s ON s.client = u.client AND s.id = user_status_id
  LEFT JOIN levels p ON p.client = u.client AND p.id = paid_rank_id
  LEFT JOIN levels l ON l.client = u.client AND l.id = rank_id
  WHERE sponsor_id IS NOT NULL AND user_type_id IS NOT NULL AND rank_id IS NOT NULL
    AND (u.client = '{PLAIN}' OR (u.client = '{HOUSE}' AND k.description <> ''))
    AND (EXISTS (SELECT 1 FROM tree_users t WHERE t.client = u.client AND t.id = u.id AND {_inside(FIRST, UNTIL).replace('ingestion', 't.ingestion')})
      OR EXISTS (SELECT 1 FROM accounts t WHERE t.client = u.client AND t.tree_user_id = u.id AND {_inside(FIRST, UNTIL).replace('ingestion', 't.ingestion')}))"""))
def staging_users(spark, d):
    return refine.staging_users(
        tree_users(spark, d), accounts(spark, d), _lookup(spark, d, KINDS, "description"),
        _lookup(spark, d, tb.STATUSES, "description"), _lookup(spark, d, LEVELS, "name", "CAST(at + 1 AS BIGINT) AS level"),
        tb.clients(spark, d), FIRST, UNTIL, HOUSE, PLAIN)


BUCKET_ROWS = 1_000_000  # item rows of a bucket of the logs, about
ITEM_ORDER = ["product_id", "product_code", "product_description", "quantity", "price_each", "price_total"]


def _orders_sql(first: str, until: str, limit: int = 0) -> str:
    """Orders with their items listed; with a limit, the slices of so many items instead."""
    inside = _inside(first, until)
    listing = f"string_agg(product_code || ':' || quantity || ':' || price_total, ',' ORDER BY {', '.join(ITEM_ORDER)}) AS listing"
    inactive = ", ".join(f"'{s}'" for s in fixed.INACTIVE_ORDER_STATUSES)
    shown = f"""SELECT client, order_id, slice, count(*) AS n_products, {listing}
        FROM (SELECT i.*, (row_number() OVER (PARTITION BY i.client, i.order_id ORDER BY {', '.join(ITEM_ORDER)}) - 1) // {limit} AS slice
          FROM {_newest('items_log', 'client, id', ITEMS)} i JOIN found f ON i.client = f.client AND i.order_id = f.id) GROUP BY ALL"""
    return sql(OWNERS, TREE, ORDER_LOG, ITEM_LOG, *LOOKUPS, tb.CLIENTS, f"""touched AS (
      SELECT client, id FROM orders_log WHERE {inside} UNION SELECT client, order_id FROM items_log WHERE {inside})""",
      f"""products AS (SELECT client, order_id, count(*) AS n_products,
        {listing} FROM {_newest('items_log', 'client, id', ITEMS)} GROUP BY ALL)""",
      f"""found AS (SELECT o.*, client_partition_id, client_score_id, n_products, listing, u.sponsor_id, u.created_date AS coded,
        k.description AS client_user_type, t.name AS client_type, s.description AS client_status, {TYPED.format(c='k.description')} AS kind
        FROM {_newest('orders_log', 'client, id', ORDERS)} o JOIN touched USING (client, id) JOIN clients USING (client)
        LEFT JOIN products p ON p.client = o.client AND p.order_id = o.id
        LEFT JOIN {_newest('tree_users', 'client, id', PEOPLE)} u ON u.client = o.client AND u.id = o.tree_user_id
        LEFT JOIN kinds k ON k.client = o.client AND k.id = u.user_type_id
        LEFT JOIN (SELECT r_name AS client, i AS id, ({ORDER_KINDS})[i] AS name FROM region, range(1, 4) t(i)) t
          ON t.client = o.client AND t.id = order_type_id
        LEFT JOIN order_states s ON s.client = o.client AND s.id = order_status_id
        WHERE o.client = '{PLAIN}' OR (o.client = '{HOUSE}' AND k.description <> ''))""",
      shown if limit else f"""SELECT client, client_partition_id, client_score_id, event_eid, CAST(ingestion_timestamp AS VARCHAR) AS ingestion_timestamp,
        id AS order_id, tree_user_id, CAST(order_date AS VARCHAR) AS order_date, CAST(total AS DOUBLE) AS total, n_products, listing,
        client_type, client_status, autoship_template_id > 0 AS is_autoship,
        CASE WHEN client = '{PLAIN}' THEN 'Customer' WHEN kind = 'Distributor' AND coded <= order_date THEN 'Wholesale'
          WHEN kind = 'Distributor' AND coded > order_date THEN 'Autoship' WHEN kind = 'Autoship' THEN 'Autoship' ELSE kind END AS type,
        CASE WHEN client = '{PLAIN}' THEN 'Active' WHEN lower(client_status) IN ({inactive}) THEN 'Inactive'
          WHEN client_status IS NOT NULL THEN 'Active' END AS status,
        CASE WHEN client = '{PLAIN}' THEN tree_user_id WHEN kind <> 'Distributor' OR coded > order_date THEN sponsor_id
          WHEN kind = 'Distributor' THEN tree_user_id END AS commission_user_id
        FROM found""")


def _lake(df, buckets: int, *keys: str):
    """A log as the lake has it: a stored table, bucketed by the keys under which its versions are looked up."""
    name, folder = f"lake_{uuid.uuid4().hex}", work_folder(df.sparkSession)
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).option("path", folder).saveAsTable(name)
    return name, folder


@contextmanager
def _order_logs(spark, d):
    """The logs of orders and their items, stored while orders are refined from them."""
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-table(spark, d, "lineitem").count() // BUCKET_ROWS))
    stored = [_lake(orders_log(spark, d), buckets, "client", "id"), _lake(items_log(spark, d), buckets, "client", "order_id")]
    try:
        yield tuple(spark.table(name) for name, _ in stored)
    finally:
        for name, folder in stored:
            spark.sql(f"DROP TABLE {name}")
            drop_folder(spark, folder)


def _staged_orders(spark, d, logs, first, until, **options):
    return refine.staged_orders(
        *logs, tree_users(spark, d), _lookup(spark, d, KINDS, "description"),
        _lookup(spark, d, ORDER_KINDS, "description"), _lookup(spark, d, STATES, "description"), tb.clients(spark, d),
        first, until, HOUSE, PLAIN, **options)


def _listed(orders):
    line = lambda p: F.concat_ws(":", p["product_code"], p["quantity"].cast("string"), p["price_total"].cast("string"))
    return orders.withColumn("n_products", F.when(F.col("products").isNotNull(), F.size("products").cast("long"))).withColumn(
        "listing", F.array_join(F.transform("products", line), ",")).drop("products")


def _whole(orders, rest):
    """Orders with all their items listed: what goes on behind an array's limit follows, slice by slice."""
    listed = _listed(orders)
    if rest.isEmpty():
        return listed
    following = F.transform(F.array_sort(F.collect_list(F.struct("slice", "listing"))), lambda s: s["listing"])
    more = _listed(rest).groupBy("client", "order_id").agg(F.sum("n_products").alias("_more"), F.array_join(following, ",").alias("_rest"))
    joined = listed.join(more, ["client", "order_id"], "left")
    goes_on = F.col("_more").isNotNull()
    return joined.withColumns({
        "n_products": F.when(goes_on, F.col("n_products") + F.col("_more")).otherwise(F.col("n_products")),
        "listing": F.when(goes_on, F.concat_ws(",", "listing", "_rest")).otherwise(F.col("listing"))}).drop("_more", "_rest")


@register("staging_orders", _orders_sql(FIRST, UNTIL))
def staging_orders(spark, d):
    with _order_logs(spark, d) as logs:
        return _whole(*_staged_orders(spark, d, logs, FIRST, UNTIL))


SLICE = 3  # items in one slice of the query below


@register("staging_order_slices", _orders_sql(FIRST, UNTIL, SLICE))
def staging_order_slices(spark, d):
    """Staged orders and their continuation with three items a slice, put together again: every item once."""
    with _order_logs(spark, d) as logs:
        orders, rest = _staged_orders(spark, d, logs, FIRST, UNTIL, limit=SLICE)
    own = orders.filter("products IS NOT NULL").select("client", "order_id", F.lit(0).alias("slice"), "products")
    return _listed(own.unionByName(rest)).select("client", "order_id", "slice", "n_products", "listing")


WINDOW_PAIRS = 60
WINDOW_SCHEMA = "job string, target string, first timestamp_ntz, until timestamp_ntz, has_data boolean"


@register("refine_cycle", _orders_sql(*ALWAYS))
def refine_cycle(spark, d):
    """Orders refined window after window until nothing is left, the newest result of each key."""
    marks = spark.createDataFrame([], CHECKPOINT_SCHEMA)
    folder, windows = work_folder(spark), 0
    with _order_logs(spark, d) as logs:
        sources = dict(zip(("orders", "items"), logs))
        while (edge := next_window(marks, "refine", "orders", sources, cap=WINDOW_PAIRS).first()).has_data:
            part = _whole(*_staged_orders(spark, d, logs, str(edge["first"]), str(edge["until"])))
            part.write.parquet(f"{folder}/window={windows}")
            # one row a job and target
            marks = spark.createDataFrame(advance(marks, spark.createDataFrame([edge], WINDOW_SCHEMA)).collect(), CHECKPOINT_SCHEMA)
            windows += 1
    if windows < 3:
        raise ValueError(f"the tables gave {windows} windows only")
    return newest(spark.read.parquet(folder), ["client", "order_id"], ["window"]).drop("window")
