"""Column rules on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from weirflow.catalog import testbed as tb
from weirflow.catalog.testbed import comparable, sql, table
from weirflow.functions import conform, fixed, rules
from weirflow.functions.dates import days_between, ts

QUERIES: dict = {}


def register(name, sql_text):
    def add(fn):
        QUERIES[name] = (lambda spark, d: comparable(fn(spark, d)), sql_text)
        return fn
    return add


def like_case(column: str, patterns, default: str) -> str:
    whens = " ".join(f"WHEN {column} LIKE '{p}' THEN '{v}'" for p, v in patterns)
    return f"CASE {whens} ELSE {default} END"


# --- clients ---------------------------------------------------------------------------------


@register("route_clients", sql(*tb.PEOPLE, """SELECT client, tree_user_id,
  CASE client WHEN 'ASIA' THEN type WHEN 'EUROPE' THEN client_type END AS type,
  CASE client WHEN 'ASIA' THEN status END AS status
  FROM users WHERE client IN ('ASIA', 'EUROPE')"""))
def route_clients(spark, d):
    raw = tb.raw_users(spark, d)
    return rules.route_clients(
        raw,
        {
            "asia": {"type": rules.user_type(F.col("client_type")), "status": rules.user_status(F.col("client_status"))},
            "Europe": {"type": F.col("client_type")},
        },
    ).select("client", "tree_user_id", "type", "status")


@register("merge_branches", sql(*tb.PEOPLE, """
  SELECT client, tree_user_id, type, CAST(NULL AS BIGINT) AS sponsor_id FROM users WHERE client = 'ASIA'
  UNION ALL SELECT client, tree_user_id, NULL, sponsor_id FROM users WHERE client <> 'ASIA'"""))
def merge_branches(spark, d):
    users = tb.users(spark, d)
    asia = users.filter(F.col("client") == "ASIA").select("client", "tree_user_id", "type")
    rest = users.filter(F.col("client") != "ASIA").select("client", "tree_user_id", "sponsor_id")
    return rules.merge_branches(asia, rest)


@register("normalize_user_type", sql(*tb.PEOPLE, "SELECT tree_user_id, client_type, type FROM users"))
def normalize_user_type(spark, d):
    return rules.normalize_user_type(tb.raw_users(spark, d)).select("tree_user_id", "client_type", "type")


@register("member_user_type", sql("""SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Distributor'
  WHEN 'AUTOMOBILE' THEN 'Customer' WHEN 'MACHINERY' THEN 'Distributor' WHEN 'HOUSEHOLD' THEN 'Autoship' END AS type
  FROM customer"""))
def member_user_type(spark, d):
    codes = {"BUILDING": "MEMBER", "AUTOMOBILE": "RETAIL", "MACHINERY": "BA", "HOUSEHOLD": "PC"}
    code = rules.by_lookup(F.col("c_mktsegment"), codes, F.col("c_mktsegment"))
    return table(spark, d, "customer").select("c_custkey", rules.member_user_type(code).alias("type"))


STAGED = " ".join(
    f"WHEN client_type LIKE '{pattern}' OR client_type IN ({', '.join(repr(t) for t in types)}) THEN '{kind}'"
    for pattern, types, kind in fixed.STAGED_USER_TYPES)


@register("staged_user_type", sql(tb.RAW_USERS, f"SELECT tree_user_id, CASE {STAGED} END AS type FROM raw_users"))
def staged_user_type(spark, d):
    return tb.raw_users(spark, d).select("tree_user_id", rules.staged_user_type(F.col("client_type")).alias("type"))


@register("normalize_user_status", sql(*tb.PEOPLE, "SELECT tree_user_id, client_status, status FROM users"))
def normalize_user_status(spark, d):
    return tb.raw_users(spark, d).select(
        "tree_user_id", "client_status", rules.user_status(F.col("client_status")).alias("status")
    )


@register("active_distributors", sql(*tb.PEOPLE, """SELECT client, tree_user_id, email FROM users
  WHERE lower(client_type) = 'distributor' AND lower(client_status) IN ('active', 'grace')"""))
def active_distributors(spark, d):
    raw = tb.raw_users(spark, d).select("client", "tree_user_id", "email", "client_type", "client_status")
    return rules.active_distributors(raw)


# --- orders ----------------------------------------------------------------------------------



@register("normalize_order_type", sql(*tb.SALES, """SELECT o.order_id,
  CASE WHEN u.type = 'Distributor' AND u.created <= o.order_date THEN 'Wholesale'
       WHEN u.type = 'Distributor' THEN 'Autoship'
       WHEN u.type = 'Autoship' THEN 'Autoship' ELSE u.type END AS type
  FROM raw_orders o JOIN users u ON o.tree_user_id = u.tree_user_id"""))
def normalize_order_type(spark, d):
    buyers = tb.users(spark, d).select("tree_user_id", "created", F.col("type").alias("user_type"))
    joined = tb.raw_orders(spark, d).join(buyers, "tree_user_id")
    return joined.select("order_id", rules.order_type(F.col("user_type"), F.col("created"), F.col("order_date")).alias("type"))




@register("normalize_order_status", """SELECT o_orderkey,
  CASE WHEN o_orderstatus IN ('P', 'O') THEN 'Inactive' ELSE 'Active' END AS status FROM orders""")
def normalize_order_status(spark, d):
    raw = rules.by_lookup(F.col("o_orderstatus"), {"P": "ACH Declined", "O": "CC Declined", "F": "Shipped"})
    return table(spark, d, "orders").select("o_orderkey", rules.order_status(raw).alias("status"))


@register("commission_owner", sql(*tb.SALES, """SELECT o.order_id, o.commission_user_id, u.sponsor_id AS legacy_owner
  FROM sales_orders o JOIN users u ON o.tree_user_id = u.tree_user_id"""))
def commission_owner(spark, d):
    buyers = tb.users(spark, d).select("tree_user_id", "sponsor_id", "coded", F.col("type").alias("user_type"))
    joined = tb.raw_orders(spark, d).join(buyers, "tree_user_id")
    args = [F.col(c) for c in ("user_type", "tree_user_id", "sponsor_id", "coded", "order_date")]
    return joined.select(
        "order_id",
        rules.commission_owner(*args).alias("commission_user_id"),
        rules.commission_owner(*args, legacy=True).alias("legacy_owner"),
    )


@register("order_code_names", """SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1)
  WHEN '1' THEN 'Backorder Cancelled' WHEN '2' THEN 'Credit/RMA' WHEN '3' THEN 'Retail'
  WHEN '4' THEN 'Point Redemption' END AS name FROM orders""")
def order_code_names(spark, d):
    codes = {"1": "B", "2": "C", "3": "D", "4": "Y", "5": "?"}
    code = rules.by_lookup(F.substring("o_orderpriority", 1, 1), codes)
    return table(spark, d, "orders").select("o_orderkey", rules.order_code_name(code).alias("name"))


# --- people ----------------------------------------------------------------------------------


@register("gender_fold", """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'female' WHEN 'AUTOMOBILE' THEN 'male'
  WHEN 'MACHINERY' THEN 'female' WHEN 'HOUSEHOLD' THEN 'male' ELSE 'none' END AS gender FROM customer""")
def gender_fold(spark, d):
    raw = rules.by_lookup(
        F.col("c_mktsegment"), {"BUILDING": "F", "AUTOMOBILE": "M", "MACHINERY": "female", "HOUSEHOLD": "male"}
    )
    return table(spark, d, "customer").select("c_custkey", rules.gender(raw).alias("gender"))


@register("street_concat", """SELECT c_custkey, CASE WHEN c_nationkey % 5 = 4 THEN NULL ELSE
  c_name || CASE c_nationkey % 5 WHEN 0 THEN '' WHEN 1 THEN '' ELSE ' ' || c_mktsegment END END AS street FROM customer""")
def street_concat(spark, d):
    kind = F.col("c_nationkey") % 5
    first = F.when(kind != 4, F.col("c_name"))
    second = F.when(kind == 1, F.lit("")).when(kind > 1, F.col("c_mktsegment"))
    return table(spark, d, "customer").select("c_custkey", rules.street(first, second).alias("street"))


@register("product_class", sql(tb.PARTS, f"""SELECT product_id,
  {like_case('lower(product_description)', fixed.PRODUCT_TYPE_PATTERNS, 'product_description')} AS product_type,
  lower(product_description) LIKE '%college%' AS is_college FROM parts"""))
def product_class(spark, d):
    text = F.col("product_description")
    return tb.parts(spark, d).select(
        "product_id", rules.product_type(text).alias("product_type"), rules.is_college(text).alias("is_college")
    )


@register("membership_class", sql(tb.PARTS, f"""SELECT product_id,
  {like_case('lower(product_description)', fixed.MEMBERSHIP_PATTERNS, "'none'")} AS membership FROM parts"""))
def membership_class(spark, d):
    return tb.parts(spark, d).select("product_id", rules.membership_type(F.col("product_description")).alias("membership"))


def bucket_case(days: str, edges, at: int) -> str:
    whens = []
    for low, high, *labels in edges:
        test = f"{days} >= {low}" if high is None else f"{days} BETWEEN {low} AND {high}"
        whens.append(f"WHEN {test} THEN '{labels[at]}'")
    return f"CASE {' '.join(whens)} END"


DAYS_SQL = "date_diff('day', CAST(u.created AS DATE), CAST(o.order_date AS DATE))"


@register("day_bucket", sql(*tb.PEOPLE, tb.RAW_ORDERS, f"""SELECT order_id, days,
  {bucket_case('days', fixed.DAY_BUCKETS, 0)} AS bucket, {bucket_case('days', fixed.DAY_BUCKETS, 1)} AS bucket_order,
  {bucket_case('days', fixed.FINE_DAY_BUCKETS, 0)} AS fine_bucket, {bucket_case('days', fixed.FINE_DAY_BUCKETS, 1)} AS fine_order
  FROM (SELECT o.order_id, {DAYS_SQL} AS days FROM raw_orders o JOIN users u ON o.tree_user_id = u.tree_user_id)"""))
def day_bucket(spark, d):
    joined = tb.raw_orders(spark, d).join(tb.users(spark, d).select("tree_user_id", "created"), "tree_user_id")
    days = F.col("days")
    return joined.select("order_id", days_between(F.col("created"), F.col("order_date")).alias("days")).select(
        "order_id", "days",
        rules.day_bucket(days).alias("bucket"), rules.day_bucket_rank(days).alias("bucket_order"),
        rules.day_bucket(days, fixed.FINE_DAY_BUCKETS).alias("fine_bucket"),
        rules.day_bucket_rank(days, fixed.FINE_DAY_BUCKETS).alias("fine_order"),
    )


PLATFORM_SQL = f"""CASE WHEN platform IS NULL THEN 'unknown' ELSE {like_case('platform', fixed.PLATFORM_PATTERNS, "'other'")} END"""
EVENT_PLATFORM_SQL = tb._case("event_type", tb.EVENT_PLATFORMS)


@register("platform_class", f"""SELECT event_id, {PLATFORM_SQL} AS platform_class
  FROM (SELECT event_id, {EVENT_PLATFORM_SQL} AS platform FROM events)""")
def platform_class(spark, d):
    platform = rules.by_lookup(F.col("event_type"), tb.EVENT_PLATFORMS)
    return table(spark, d, "events").select("event_id", rules.platform_class(platform).alias("platform_class"))


# --- conversions -----------------------------------------------------------------------------


@register("zero_date_null", """SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS ship_text,
  CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS parsed
  FROM orders""")
def zero_date_null(spark, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    status = F.col("o_orderstatus")
    text = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(status == "P", "0000-00-00 00:00:00").otherwise(day).alias("ship_text"),
        # an offset behind the date, a zero date, and text that is no date
        F.when(status == "F", F.concat(day, F.lit("T23:00:00+05:00")))
        .when(status == "P", fixed.ZERO_DATE).otherwise("soon").alias("parsed"),
    )
    target = T.StructType([T.StructField("parsed", T.DateType())])
    return conform.zero_dates_to_null(conform.parse_dates(text, target))


@register("null_to_empty", """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS priority,
  CASE WHEN o_orderstatus = 'O' THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS buyer FROM orders""")
def null_to_empty(spark, d):
    status = F.col("o_orderstatus")
    return conform.nulls_to_empty(
        table(spark, d, "orders").select(
            "o_orderkey", F.when(status != "P", F.col("o_orderpriority")).alias("priority"),
            F.when(status != "O", F.col("o_custkey")).alias("buyer"),
        )
    )


@register("bool_to_int", """SELECT o_orderkey, CAST(o_orderstatus = 'P' AS BIGINT) AS cancelled,
  CAST(CASE WHEN o_orderstatus = 'O' THEN false ELSE o_custkey % 2 = 1 END AS BIGINT) AS is_autoship FROM orders""")
def bool_to_int(spark, d):
    template = F.when(F.col("o_orderstatus") != "O", F.col("o_custkey") % 2)
    return conform.booleans_to_ints(
        table(spark, d, "orders").select(
            "o_orderkey", (F.col("o_orderstatus") == "P").alias("cancelled"),
            rules.is_autoship(template).alias("is_autoship"),
        )
    )


@register("decimal_to_string", """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total FROM orders""")
def decimal_to_string(spark, d):
    return conform.stringify_decimals(
        table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast(tb.MONEY).alias("total"))
    )


@register("conform_schema", """SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderkey,
  TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority_code, TRY_CAST(o_orderstatus AS BIGINT) AS o_orderstatus,
  CAST(NULL AS VARCHAR) AS paid_rank, '' AS lifetime_rank FROM orders""")
def conform_schema(spark, d):
    target = T.StructType(
        [
            T.StructField("o_custkey", T.StringType()),
            T.StructField("o_orderkey", T.LongType(), False),
            T.StructField("priority_code", T.IntegerType()),
            T.StructField("o_orderstatus", T.IntegerType()),
            T.StructField("paid_rank", T.StringType()),
            T.StructField("lifetime_rank", T.StringType()),
        ]
    )
    rows = table(spark, d, "orders").withColumns(
        {"priority_code": F.substring("o_orderpriority", 1, 1), "lifetime_rank": F.lit("")}
    )
    return conform.conform(rows.drop("o_orderdate"), target)


# --- lists, paths, posted records ------------------------------------------------------------


@register("path_date_retention", f"""SELECT o_orderkey, path FROM (
  SELECT o_orderkey, o_orderdate, 'logs/' || o_custkey || '/' || strftime(o_orderdate, '%Y-%m-%d') ||
    CASE WHEN o_orderstatus = 'P' THEN '/run.txt' ELSE '/run.log' END AS path FROM orders)
  WHERE path LIKE '%.log' AND CAST(o_orderdate AS DATE) <= DATE '{tb.AS_OF[:10]}' - 30""")
def path_date_retention(spark, d):
    end = F.when(F.col("o_orderstatus") == "P", "/run.txt").otherwise("/run.log")
    paths = table(spark, d, "orders").select(
        "o_orderkey",
        F.concat(F.lit("logs/"), F.col("o_custkey").cast("string"), F.lit("/"), F.date_format("o_orderdate", "yyyy-MM-dd"), end).alias("path"),
    )
    return rules.expired_paths(paths, "path", ts(tb.AS_OF), 30)


@register("id_list_filter", """SELECT tree_user_id, email FROM (
   SELECT c_custkey AS tree_user_id, 'person' || c_custkey || '@mail.test' AS email FROM customer)
   WHERE tree_user_id IN (SELECT l_suppkey FROM lineitem UNION SELECT l_linenumber FROM lineitem)""")
def id_list_filter(spark, d):
    lists = table(spark, d, "lineitem").select(
        F.concat_ws(",", F.col("l_suppkey").cast("string"), F.lit(""), F.col("l_linenumber").cast("string"),
                    F.col("l_suppkey").cast("string")).alias("ids")
    )
    return rules.in_id_list(tb.raw_users(spark, d).select("tree_user_id", "email"), "tree_user_id", lists, "ids")


@register("required_fields", """SELECT user_id, event_id, CASE WHEN event_type = 'error' AND value < 10 THEN 'value,kind'
   WHEN event_type = 'error' THEN 'kind' WHEN value < 10 THEN 'value' ELSE '' END AS missing FROM events""")
def required_fields(spark, d):
    posted = table(spark, d, "events").select(
        "event_id", "user_id", F.when(F.col("value") >= 10, F.col("value")).alias("value"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"),
    )
    valid, rejected = rules.require_fields(posted, ["event_id", "value", "kind"])
    return valid.withColumn("missing", F.lit("")).unionByName(
        rejected.withColumn("missing", F.concat_ws(",", "missing_fields")).drop("missing_fields")
    ).select("event_id", "user_id", "missing")
