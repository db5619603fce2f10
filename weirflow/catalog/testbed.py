"""The domain relations, derived from the driver's tables: in Spark, and as SQL for the check.

Every relation covers its whole source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weirflow.functions import fixed, rules
from weirflow.operators.joins import with_client
from weirflow.operators.nesting import nest
from weirflow.operators.versions import newest

AS_OF = "2001-08-01 00:00:00"
EVENTS_AS_OF = "2024-02-01 00:00:00"
MONEY = "decimal(18,2)"

# text added to a part's name so that every product rule has parts; position = p_size % length
PRODUCT_TEXTS = [
    "Monthly DTP", "Reactivation", "Activation fee DTG", "dt plus gold month", "Sales Tax",
    "Initial month free", "initial box free", "get4discount RBS", "Event DTS", "Boot Camp",
    "Momentum DTU", "preview", "acceleration RBS", "Pick your product", "College WVA month",
    "RBS month", "RBS fee", "plain",
]

SEGMENT_TYPES = {
    "BUILDING": "Distributor", "AUTOMOBILE": "Customer", "MACHINERY": "Employee",
    "HOUSEHOLD": "Pending Transfer", "FURNITURE": "Freemium",
}
STATUSES = ["Active", "Grace", "Hold", "Terminated"]
EVENT_PLATFORMS = {
    "click": "Android 12", "view": "iPad OS", "signup": "Mac OS X 14", "purchase": "Windows",
}


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its footer is read for the schema once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def comparable(df: DataFrame) -> DataFrame:
    """Types both engines share: decimals and floats as double, ints as long, times as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def sql(*parts: str) -> str:
    """CTE texts and, last, the select."""
    *ctes, select = parts
    return f"WITH {', '.join(ctes)} {select}" if ctes else select


# --- clients and users -----------------------------------------------------------------------


def clients(spark, d) -> DataFrame:
    return table(spark, d, "region").select(
        F.col("r_name").alias("client"),
        F.col("r_regionkey").cast("long").alias("client_partition_id"),
        F.concat(F.lit("s"), F.col("r_regionkey").cast("string")).alias("client_score_id"),
    )


CLIENTS = """clients AS (
  SELECT r_name AS client, CAST(r_regionkey AS BIGINT) AS client_partition_id,
         's' || r_regionkey AS client_score_id FROM region)"""


def nations(spark, d) -> DataFrame:
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", F.col("r_name").alias("client")
    )


def raw_users(spark, d) -> DataFrame:
    """Customers as users before any rule."""
    c = table(spark, d, "customer")
    key = F.col("c_custkey")
    kinds = [(F.col("c_mktsegment") == k, F.lit(v)) for k, v in SEGMENT_TYPES.items()]
    # dealt out to the clients by their number; sponsors are of the same client
    regions = table(spark, d, "region").select(F.col("r_name").alias("client"), F.col("r_regionkey").alias("_region"))
    return c.join(regions, key % 5 == F.col("_region")).select(
        "client",
        key.alias("tree_user_id"),
        key.alias("user_id"),
        F.when(key > 4, F.expr("((c_custkey div 5 - 1) div 3) * 5 + c_custkey % 5")).alias("sponsor_id"),
        F.expr("TIMESTAMP_NTZ'1995-01-01 00:00:00' + make_dt_interval(CAST(c_custkey % 730 AS INT))").alias("created"),
        rules.first_match(kinds, F.lit(None).cast("string")).alias("client_type"),
        F.element_at(F.array(*[F.lit(s) for s in STATUSES]), (F.col("c_nationkey") % 4 + 1).cast("int")).alias("client_status"),
        F.concat(F.lit("person"), key.cast("string"), F.lit("@mail.test")).alias("email"),
        F.col("c_acctbal").alias("balance"),
    )


def users(spark, d) -> DataFrame:
    typed = rules.normalize_user_type(raw_users(spark, d)).withColumn(
        "status", rules.user_status(F.col("client_status"))
    )
    return with_client(typed.withColumn("coded", F.col("created")), clients(spark, d))


def _case(column: str, table_: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table_.items()) + " END"


RAW_USERS = f"""raw_users AS (
  SELECT r.r_name AS client, CAST(r.r_regionkey AS BIGINT) AS client_partition_id,
         's' || r.r_regionkey AS client_score_id,
         c_custkey AS tree_user_id, c_custkey AS user_id,
         CASE WHEN c_custkey > 4 THEN ((c_custkey // 5 - 1) // 3) * 5 + c_custkey % 5 END AS sponsor_id,
         TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(c_custkey % 730 AS INTEGER)) AS created,
         {_case('c_mktsegment', SEGMENT_TYPES)} AS client_type,
         (['Active','Grace','Hold','Terminated'])[c_nationkey % 4 + 1] AS client_status,
         'person' || c_custkey || '@mail.test' AS email, c_acctbal AS balance
  FROM customer c JOIN region r ON c_custkey % 5 = r.r_regionkey)"""

USERS = """users AS (
  SELECT *, created AS coded,
    CASE """ + " ".join(
    [f"WHEN lower(client_type) LIKE '%{text}%' THEN '{kind}'" for text, kind in fixed.USER_TYPE_CONTAINS]
    + [f"WHEN lower(client_type) = '{raw}' THEN '{kind}'" for raw, kind in fixed.USER_TYPE_LOOKUP.items()]) + f""" END AS type,
    CASE WHEN lower(client_status) IN ({', '.join(repr(x) for x in fixed.ACTIVE_USER_STATUSES)}) THEN 'Active' ELSE 'Inactive' END AS status
  FROM raw_users)"""

PEOPLE = [RAW_USERS, USERS]


# --- orders ----------------------------------------------------------------------------------


def raw_orders(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    priority = F.col("o_orderpriority")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("tree_user_id"),
        F.when(priority.like("1%") | priority.like("2%"), "Retail")
        .when(priority.like("3%") | priority.like("4%"), "Wholesale")
        .otherwise("Autoship").alias("type"),
        F.when(F.col("o_orderstatus") == "P", "Cancelled").otherwise("Active").alias("status"),
        rules.is_autoship(F.col("o_orderkey") % 3 - 1).alias("is_autoship"),
        F.col("o_totalprice").cast(MONEY).alias("total"),
        F.col("o_orderdate").alias("order_date"),
    )


def orders(spark, d) -> DataFrame:
    """Orders with client and commission owner."""
    buyers = users(spark, d).select(
        "client", "client_partition_id", "tree_user_id", "sponsor_id", "coded", F.col("type").alias("user_type")
    )
    owner = rules.commission_owner(
        F.col("user_type"), F.col("tree_user_id"), F.col("sponsor_id"), F.col("coded"), F.col("order_date")
    )
    return (
        raw_orders(spark, d).join(buyers, "tree_user_id")
        .withColumn("commission_user_id", owner).drop("sponsor_id", "coded")
    )


RAW_ORDERS = """raw_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS tree_user_id,
         CASE WHEN o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' THEN 'Retail'
              WHEN o_orderpriority LIKE '3%' OR o_orderpriority LIKE '4%' THEN 'Wholesale'
              ELSE 'Autoship' END AS type,
         CASE WHEN o_orderstatus = 'P' THEN 'Cancelled' ELSE 'Active' END AS status,
         (o_orderkey % 3 - 1) > 0 AS is_autoship,
         CAST(o_totalprice AS DECIMAL(18,2)) AS total, o_orderdate AS order_date
  FROM orders)"""

ORDERS = """sales_orders AS (
  SELECT o.*, u.client, u.client_partition_id, u.type AS user_type,
         CASE WHEN u.type <> 'Distributor' THEN u.sponsor_id
              WHEN u.coded > o.order_date THEN u.sponsor_id
              ELSE u.tree_user_id END AS commission_user_id
  FROM raw_orders o JOIN users u ON o.tree_user_id = u.tree_user_id)"""

SALES = [*PEOPLE, RAW_ORDERS, ORDERS]


# --- items -----------------------------------------------------------------------------------

ITEM_KEYS = ["l_orderkey", "l_linenumber"]
ITEM_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]


def items(spark, d) -> DataFrame:
    """Newest version of each order line."""
    return newest(table(spark, d, "lineitem"), ITEM_KEYS, ITEM_ORDER)


ITEMS = f"""items AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {', '.join(ITEM_KEYS)}
      ORDER BY {', '.join(c + ' DESC NULLS LAST' for c in ITEM_ORDER)}) AS rn FROM lineitem)
  WHERE rn = 1)"""


def parts(spark, d) -> DataFrame:
    texts = F.array(*[F.lit(t) for t in PRODUCT_TEXTS])
    at = (F.col("p_size") % len(PRODUCT_TEXTS) + 1).cast("int")
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_brand").alias("product_code"),
        F.concat(F.col("p_name"), F.lit(" "), F.element_at(texts, at)).alias("product_description"),
    )


PARTS = f"""parts AS (
  SELECT p_partkey AS product_id, p_brand AS product_code,
         p_name || ' ' || ({[t for t in PRODUCT_TEXTS]})[p_size % {len(PRODUCT_TEXTS)} + 1] AS product_description
  FROM part)"""


def order_lines(spark, d) -> DataFrame:
    """Newest lines with product text and amounts."""
    return items(spark, d).join(parts(spark, d), F.col("l_partkey") == F.col("product_id")).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("long").alias("line_id"),
        "product_id", "product_code", "product_description",
        F.col("l_quantity").cast("long").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("price_total"),
    )


LINES = """lines AS (
  SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_id, product_id, product_code,
         product_description, CAST(l_quantity AS BIGINT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price_total
  FROM items JOIN parts ON l_partkey = product_id)"""

LINE_CTES = [ITEMS, PARTS, LINES]
PRODUCT_FIELDS = ["line_id", "product_id", "product_code", "product_description", "quantity", "price_total"]


def line_keys(spark, d) -> DataFrame:
    """The order of every line version: where to count lines per order."""
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("order_id"))


def nested_orders(spark, d) -> DataFrame:
    """Orders with their lines as an array."""
    nested = nest(order_lines(spark, d), ["order_id"], PRODUCT_FIELDS, "products", counted=line_keys(spark, d))
    return orders(spark, d).join(nested, "order_id")


# --- people with scores ----------------------------------------------------------------------


def entities(spark, d) -> DataFrame:
    """Suppliers as scored entities; their e-mail matches every third person's."""
    s = table(spark, d, "supplier")
    key = F.col("s_suppkey")
    return s.join(nations(spark, d), s.s_nationkey == F.col("n_nationkey")).select(
        "client",
        F.concat(F.lit("e"), key.cast("string")).alias("entity_id"),
        F.concat(F.lit("f"), F.col("s_nationkey").cast("string")).alias("file"),
        F.concat(F.lit("person"), (key * 3).cast("string"), F.lit("@mail.test")).alias("email"),
        F.concat(F.lit("+1-"), key.cast("string")).alias("phone"),
        F.col("s_name").alias("twitter"),
        F.expr("TIMESTAMP_NTZ'2001-07-01 00:00:00' + make_dt_interval(CAST(s_suppkey % 40 AS INT))").alias("ingestion_timestamp"),
    )


ENTITIES = """entities AS (
  SELECT r.r_name AS client, 'e' || s_suppkey AS entity_id, 'f' || s_nationkey AS file,
         'person' || (s_suppkey * 3) || '@mail.test' AS email, '+1-' || s_suppkey AS phone, s_name AS twitter,
         TIMESTAMP '2001-07-01 00:00:00' + to_days(CAST(s_suppkey % 40 AS INTEGER)) AS ingestion_timestamp
  FROM supplier JOIN nation n ON s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""


# --- the tree --------------------------------------------------------------------------------


def tree_attributes(spark, d) -> DataFrame:
    return users(spark, d).select(
        "client_partition_id", F.col("tree_user_id").alias("user_id"), "client", F.col("created").alias("signup")
    )


CLOSURE = """closure AS (
  WITH RECURSIVE walk(upline_id, user_id, depth) AS (
    SELECT sponsor_id, tree_user_id, CAST(1 AS BIGINT) FROM users WHERE sponsor_id IS NOT NULL
    UNION ALL
    SELECT u.sponsor_id, w.user_id, w.depth + 1
    FROM walk w JOIN users u ON w.upline_id = u.tree_user_id WHERE u.sponsor_id IS NOT NULL)
  SELECT * FROM walk)"""
