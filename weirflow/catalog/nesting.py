"""Nested arrays, first and last rows, lookups, links, profiles and flat marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.catalog import testbed as tb
from weirflow.catalog.testbed import comparable, sql, table
from weirflow.functions.dates import ts
from weirflow.operators.joins import enrich, link_entities, person_profiles, polymorphic_lookup, with_lookup
from weirflow.operators.nesting import first_of, last_of, nest, nest_many, scores_from_json, scores_from_wide, unnest
from weirflow.operators.shares import top_n
from weirflow.plans import marts

QUERIES: dict = {}


def register(name, sql_text):
    def add(fn):
        QUERIES[name] = (lambda spark, d: comparable(fn(spark, d)), sql_text)
        return fn
    return add


# --- arrays ----------------------------------------------------------------------------------


@register("nest_items", sql(*tb.LINE_CTES, """SELECT order_id, count(*) AS n, sum(price_total)::DOUBLE AS total,
  string_agg(product_code || ':' || quantity, ',' ORDER BY line_id, product_id) AS listing FROM lines GROUP BY order_id"""))
def nest_items(spark, d):
    """Lines nested per order, listed back in array order."""
    nested = nest(tb.order_lines(spark, d), ["order_id"], tb.PRODUCT_FIELDS, "products", counted=tb.line_keys(spark, d))
    listing = F.transform("products", lambda p: F.concat(p["product_code"], F.lit(":"), p["quantity"].cast("string")))
    total = F.aggregate("products", F.lit(0).cast("decimal(28,2)"), lambda a, p: (a + p["price_total"]).cast("decimal(28,2)"))
    return nested.select(
        "order_id", F.size("products").alias("n"), total.alias("total"), F.array_join(listing, ",").alias("listing")
    )


@register("unnest_items", sql(*tb.SALES, *tb.LINE_CTES, """SELECT o.order_id, o.client, l.line_id, l.product_id,
  l.product_code, l.product_description, l.quantity, l.price_total::DOUBLE AS price_total
  FROM sales_orders o JOIN lines l ON o.order_id = l.order_id"""))
def unnest_items(spark, d):
    return unnest(tb.nested_orders(spark, d), "products", ["order_id", "client"])


@register("nest_many", """SELECT l_suppkey, count(*) AS n_lines,
  count(*) FILTER (l_returnflag = 'R') AS n_returns, count(*) FILTER (l_tax = 0) AS n_taxfree,
  CAST(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = 'R') AS BIGINT) AS returned FROM lineitem GROUP BY l_suppkey""")
def nested_parts(spark, d):
    """Three arrays per supplier, grouped in one pass; hot suppliers in slices of 500."""
    log = table(spark, d, "lineitem").withColumn("quantity", F.col("l_quantity").cast("long"))
    fields = ["l_orderkey", "l_linenumber", "quantity", "l_partkey", "l_shipdate"]
    parts = {
        "lines": (log, fields),
        "returns": (log.filter(F.col("l_returnflag") == "R"), fields),
        "taxfree": (log.filter(F.col("l_tax") == 0), fields),
    }
    nested = nest_many(parts, ["l_suppkey"], limit=500)
    per_slice = nested.select(
        "l_suppkey", *[F.size(n).cast("long").alias(n) for n in parts],
        F.aggregate("returns", F.lit(0).cast("long"), lambda a, r: a + r["quantity"]).alias("returned"),
    )
    return per_slice.groupBy("l_suppkey").agg(
        F.sum("lines").alias("n_lines"), F.sum("returns").alias("n_returns"), F.sum("taxfree").alias("n_taxfree"),
        F.when(F.sum("returns") > 0, F.sum("returned")).alias("returned"),
    )


# --- first and last --------------------------------------------------------------------------

EDGE = ["order_date", "order_id"]


@register("first_last", sql(*tb.SALES, """SELECT commission_user_id, arg_min(order_id, (order_date, order_id)) AS first_id,
  min(order_date)::VARCHAR AS first_date, arg_min(total, (order_date, order_id))::DOUBLE AS first_total,
  arg_max(order_id, (order_date, order_id)) AS last_id, max(order_date)::VARCHAR AS last_date,
  arg_max(total, (order_date, order_id))::DOUBLE AS last_total
  FROM sales_orders WHERE commission_user_id IS NOT NULL GROUP BY commission_user_id"""))
def first_last(spark, d):
    whole = F.struct("order_id", "order_date", "total")
    owned = tb.orders(spark, d).filter(F.col("commission_user_id").isNotNull())
    picked = owned.groupBy("commission_user_id").agg(first_of(whole, EDGE).alias("a"), last_of(whole, EDGE).alias("z"))
    return picked.select(
        "commission_user_id",
        *[F.col(f"{s}.{c}").alias(f"{n}_{o}") for s, n in (("a", "first"), ("z", "last"))
          for c, o in (("order_id", "id"), ("order_date", "date"), ("total", "total"))],
    )


@register("typed_first_last", sql(tb.RAW_ORDERS, """SELECT tree_user_id,
  arg_min(order_id, (order_date, order_id)) FILTER (type = 'Retail') AS first_retail,
  arg_max(order_id, (order_date, order_id)) FILTER (type = 'Retail') AS last_retail,
  CASE WHEN arg_max(type, (order_date, order_id)) = 'Retail' THEN arg_max(order_id, (order_date, order_id)) END AS legacy_last_retail,
  arg_min(order_id, (order_date, order_id)) FILTER (type = 'Wholesale') AS first_wholesale,
  arg_max(order_id, (order_date, order_id)) FILTER (type = 'Wholesale') AS last_wholesale
  FROM raw_orders GROUP BY tree_user_id"""))
def typed_first_last(spark, d):
    o, i = tb.raw_orders(spark, d), F.col("order_id")
    retail, wholesale = F.col("type") == "Retail", F.col("type") == "Wholesale"
    return o.groupBy("tree_user_id").agg(
        first_of(i, EDGE, retail).alias("first_retail"), last_of(i, EDGE, retail).alias("last_retail"),
        last_of(i, EDGE, retail, legacy=True).alias("legacy_last_retail"),
        first_of(i, EDGE, wholesale).alias("first_wholesale"), last_of(i, EDGE, wholesale).alias("last_wholesale"),
    )


# --- lookups and links -----------------------------------------------------------------------


@register("newest_lookup", sql(tb.RAW_USERS, tb.ITEMS, """pick AS (
    SELECT l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC,
      l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) AS rn FROM lineitem) WHERE rn = 1)""",
    """SELECT p.p_partkey, p.p_name, k.l_suppkey AS last_supplier FROM part p LEFT JOIN pick k ON p.p_partkey = k.l_partkey"""))
def newest_lookup(spark, d):
    """Parts with the supplier of their newest line."""
    return with_lookup(
        table(spark, d, "part").select("p_partkey", "p_name"), table(spark, d, "lineitem"),
        {"p_partkey": "l_partkey"}, {"l_suppkey": "last_supplier"},
        ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey"],
    )


def event_links(spark, d):
    """Events as links: the event type says which table the key means."""
    return table(spark, d, "events").select(
        F.col("event_id").alias("link_id"), F.col("user_id").alias("link_sharer_id"), F.col("ts").alias("created_at"),
        F.get_json_object("props", "$.k").cast("long").alias("asset_id"), F.col("event_type").alias("asset_type"),
    )


EVENT_LINKS = """links AS (SELECT event_id AS link_id, user_id AS link_sharer_id, ts AS created_at,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS asset_id, event_type AS asset_type FROM events)"""


@register("polymorphic_lookup", sql(EVENT_LINKS, """SELECT l.link_id, l.asset_type, l.asset_id,
  CASE WHEN l.asset_type = 'click' THEN p.url WHEN l.asset_type = 'view' THEN c.c_name
       WHEN l.asset_type = 'purchase' THEN t.p_name END AS target
  FROM links l LEFT JOIN pages p ON l.asset_type = 'click' AND l.asset_id = p.page_id
  LEFT JOIN customer c ON l.asset_type = 'view' AND l.asset_id = c.c_custkey
  LEFT JOIN part t ON l.asset_type = 'purchase' AND l.asset_id = t.p_partkey"""))
def polymorphic(spark, d):
    lookups = {
        "click": (table(spark, d, "pages"), "page_id", "url"),
        "view": (table(spark, d, "customer"), "c_custkey", "c_name"),
        "purchase": (table(spark, d, "part"), "p_partkey", "p_name"),
    }
    links = event_links(spark, d).select("link_id", "asset_type", "asset_id")
    return polymorphic_lookup(links, "asset_type", "asset_id", lookups, "target")


@register("link_structs", sql(*tb.PEOPLE, EVENT_LINKS, """SELECT l.link_id, l.link_sharer_id, l.created_at::VARCHAR AS created_at,
  l.asset_type, l.asset_id, p.p_name AS title, p.p_size > 25 AS can_email, s.s_suppkey AS resource_id, s.s_name AS resource_title
  FROM links l JOIN users u ON l.link_sharer_id = u.user_id
  LEFT JOIN part p ON l.asset_type = 'asset' AND l.asset_id = p.p_partkey
  LEFT JOIN supplier s ON p.p_size = s.s_suppkey""").replace("l.asset_type = 'asset'", "l.asset_type = 'view'")
  .replace("l.asset_type, l.asset_id", "CASE l.asset_type WHEN 'view' THEN 'asset' ELSE l.asset_type END AS asset_type, l.asset_id"))
def link_structs(spark, d):
    links = event_links(spark, d).withColumn(
        "asset_type", F.when(F.col("asset_type") == "view", "asset").otherwise(F.col("asset_type"))
    )
    assets = table(spark, d, "part").select(
        F.col("p_partkey").alias("asset_id"), F.col("p_size").cast("long").alias("resource_id"),
        F.col("p_name").alias("title"), F.when(F.col("p_size") > 25, 1).otherwise(0).alias("can_email"),
    )
    resources = table(spark, d, "supplier").select(F.col("s_suppkey").alias("resource_id"), F.col("s_name").alias("title"))
    out = marts.links_mart(links, assets, resources, tb.users(spark, d))
    return out.select(
        "link_id", "link_sharer_id", "created_at", "asset_type", "asset_id", "resource_asset.title",
        "resource_asset.can_email", "resource_asset.resource.resource_id",
        F.col("resource_asset.resource.title").alias("resource_title"),
    )


def file_states(spark, d):
    """One state per client and uploaded file, from the newest line of its nation's suppliers."""
    s = table(spark, d, "supplier").join(tb.nations(spark, d), F.col("s_nationkey") == F.col("n_nationkey"))
    shipped = table(spark, d, "lineitem").join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    per_file = shipped.groupBy("client", F.concat(F.lit("f"), F.col("s_nationkey").cast("string")).alias("file")).agg(
        F.sum(F.col("l_quantity").cast("long")).alias("q")
    )
    return per_file.select(
        "client", "file", F.lit("people").alias("table"),
        F.when(F.col("q") % 4 > 0, "processed").otherwise("running").alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("end_date"),
    )


FILE_STATES = """file_states AS (SELECT r.r_name AS client, 'f' || s_nationkey AS file,
    CASE WHEN sum(CAST(l_quantity AS BIGINT)) % 4 > 0 THEN 'processed' ELSE 'running' END AS status
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation n ON s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY ALL)"""


def existing_links(spark, d):
    lines = table(spark, d, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 50) & (F.col("l_discount") > 0.09))
    return lines.select(F.concat(F.lit("e"), F.col("l_suppkey").cast("string")).alias("entity_id")).distinct().withColumn(
        "person_id", F.lit(-1).cast("long")
    )


@register("entity_link", sql(*tb.PEOPLE, tb.ENTITIES, FILE_STATES, """SELECT e.entity_id, u.tree_user_id AS person_id
  FROM entities e JOIN file_states f ON e.client = f.client AND e.file = f.file AND f.status = 'processed'
  JOIN users u ON e.client = u.client AND e.email = u.email
  WHERE e.entity_id NOT IN (SELECT 'e' || l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 50 AND l_discount > 0.09)"""))
def entity_link(spark, d):
    people = tb.raw_users(spark, d).select("client", "email", F.col("tree_user_id").alias("person_id"))
    return link_entities(
        tb.entities(spark, d), file_states(spark, d), people, existing_links(spark, d), "person_id", "people"
    )


SCORE_FLAGS = ["A", "N", "R"]


def wide_scores(spark, d):
    """One row per supplier with a score per return flag."""
    log = table(spark, d, "lineitem")
    return log.groupBy(F.concat(F.lit("e"), F.col("l_suppkey").cast("string")).alias("entity_id")).agg(
        *[F.sum(F.when(F.col("l_returnflag") == f, F.col("l_quantity").cast("long"))).alias(f) for f in SCORE_FLAGS]
    )


def _wide_sql() -> str:
    sums = ", ".join(f"sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = '{f}') AS \"{f}\"" for f in SCORE_FLAGS)
    return f"wide AS (SELECT 'e' || l_suppkey AS entity_id, {sums} FROM lineitem GROUP BY l_suppkey)"


@register("unpivot_scores", sql(_wide_sql(), " UNION ALL ".join(
    f"SELECT entity_id, '{f}' AS client, CAST(\"{f}\" AS BIGINT) AS score FROM wide" for f in SCORE_FLAGS)))
def unpivot_scores(spark, d):
    nested = scores_from_wide(wide_scores(spark, d), "entity_id", "client", "score", "int")
    return unnest(nested, "scores", ["entity_id"])


@register("json_scores", """SELECT CAST(event_id AS VARCHAR) AS event_id, f AS corpus,
  CASE f WHEN 'event_type' THEN event_type ELSE json_extract_string(props, '$.k') END AS score
  FROM events, (VALUES ('event_type'), ('k')) t(f)""")
def json_scores(spark, d):
    """Events as JSON answers with an open set of fields, reshaped to (field, value) rows."""
    answers = table(spark, d, "events").select(
        F.to_json(F.struct(F.col("event_id"), F.col("event_type"), F.get_json_object("props", "$.k").alias("k"))).alias("answer")
    )
    nested = scores_from_json(answers, "answer", "event_id", "corpus", "score")
    return unnest(nested, "scores", ["event_id"])


LINE_STATES = ["F", "O"]


def _supplied(spark, d, what: str, value: str, where: str):
    return table(spark, d, "supplier").filter(where).selectExpr("concat('e', s_suppkey) AS entity_id", f"{value} AS {what}")


#: of each single-valued score: its column, its value, and which entities have one
SINGLE_SCORES = {
    "persuasion": ("persuasion", "CASE WHEN s_nationkey % 2 = 0 THEN 'logic' ELSE 'story' END", "s_nationkey % 3 > 0"),
    "channel": ("preferences", "CASE WHEN s_acctbal < 0 THEN 'mail' ELSE 'phone' END", "s_suppkey % 7 > 0"),
    "relationship_fit": ("prediction", "CASE WHEN s_acctbal > 3000 THEN 'fit' ELSE 'unfit' END", "s_suppkey % 4 = 1"),
    "archetype": ("archetype", "CASE s_nationkey % 3 WHEN 0 THEN 'hero' WHEN 1 THEN 'sage' ELSE 'ruler' END", "s_suppkey % 5 > 0"),
    "lcv_level": ("prediction", "'high'", "s_acctbal > 5000"),
    "days_to_first_sale_level": ("prediction", "CASE WHEN s_suppkey % 6 = 0 THEN 'fast' ELSE 'slow' END", "s_suppkey % 2 = 0"),
}


@register("profile_wide", sql(*tb.PEOPLE, tb.ENTITIES, _wide_sql(), """states AS (SELECT 'e' || l_suppkey AS entity_id,
    sum(CAST(l_quantity AS BIGINT)) FILTER (l_linestatus = 'F') AS f, sum(CAST(l_quantity AS BIGINT)) FILTER (l_linestatus = 'O') AS o
    FROM lineitem GROUP BY l_suppkey)""", """SELECT u.tree_user_id AS person_id, e.entity_id, e.email, e.phone,
  e.twitter, CAST(w."A" AS BIGINT) AS match_a, CAST(w."R" AS BIGINT) AS match_r, CAST(a.f AS BIGINT) AS adopt_f, CAST(a.o AS BIGINT) AS adopt_o,
  """ + ", ".join(f"CASE WHEN {where} THEN {value} END AS {name}" for name, (_, value, where) in SINGLE_SCORES.items()) + """
  FROM entities e JOIN users u ON e.client = u.client AND e.email = u.email JOIN supplier ON e.entity_id = 'e' || s_suppkey
  JOIN (SELECT DISTINCT user_id FROM events) ids ON u.tree_user_id = ids.user_id
  LEFT JOIN wide w ON e.entity_id = w.entity_id AND w."R" > 300
  LEFT JOIN states a ON e.entity_id = a.entity_id AND a.f > 100"""))
def profile_wide(spark, d):
    """Profiles with all eight scores: two arrays and six single values, each missing for some."""
    people = tb.raw_users(spark, d).select("client", "email", F.col("tree_user_id").alias("person_id"))
    links = tb.entities(spark, d).join(people, ["client", "email"]).select("entity_id", "person_id")
    matches = scores_from_wide(wide_scores(spark, d).filter(F.col("R") > 300), "entity_id", "client", "score", "int")
    states = table(spark, d, "lineitem").groupBy(F.concat(F.lit("e"), F.col("l_suppkey").cast("string")).alias("entity_id")).agg(
        *[F.sum(F.when(F.col("l_linestatus") == f, F.col("l_quantity").cast("long"))).alias(f) for f in LINE_STATES])
    adopted = scores_from_wide(states.filter(F.col("F") > 100), "entity_id", "corpus", "score", "int")
    single = {name: (_supplied(spark, d, column, value, where), column) for name, (column, value, where) in SINGLE_SCORES.items()}
    ids = table(spark, d, "events").select(F.col("user_id").alias("person_id"))
    out = person_profiles(
        tb.entities(spark, d), links,
        {"match_score": (matches, "scores"), "adopt_curve": (adopted, "scores"), **single}, "person_id", ids=ids,
    )
    score = lambda column, label, key: F.element_at(F.filter(column, lambda s: s[label] == key), 1)["score"]
    return out.select(
        "person_id", "entity.*", *[score("match_score", "client", f).alias(f"match_{f.lower()}") for f in ("A", "R")],
        *[score("adopt_curve", "corpus", f).alias(f"adopt_{f.lower()}") for f in LINE_STATES], *SINGLE_SCORES)


@register("broadcast_enrich", """SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, p.p_name AS name, s.s_name
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey""")
def broadcast_enrich(spark, d):
    """Lines with part and supplier; the part's name replaces the line's own."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_returnflag").alias("name"))
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("name"))
    suppliers = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return enrich(lines, (parts, "l_partkey"), (suppliers, "l_suppkey"), strict=True)


# --- marts -----------------------------------------------------------------------------------


def accounts(spark, d):
    return tb.raw_users(spark, d).select("tree_user_id", "user_id")


@register("users_mart", sql(*tb.PEOPLE, f"""SELECT u.tree_user_id, u.email, u.created::DATE::VARCHAR AS birth_date, e.user_id,
  u.client_type AS type, u.client_status AS status,
  date_sub('year', CAST(u.created::DATE AS TIMESTAMP), TIMESTAMP '{tb.AS_OF}') AS age
  FROM users u LEFT JOIN (SELECT DISTINCT user_id FROM events) e ON u.tree_user_id = e.user_id
  WHERE u.client_status <> 'Terminated'"""))
def users_mart(spark, d):
    raw = tb.raw_users(spark, d)
    users = raw.select("tree_user_id", "email", F.to_date("created").alias("birth_date"),
                       F.col("client_type").alias("type_id"), F.col("client_status").alias("status_id"))
    seen = table(spark, d, "events").select("user_id").distinct().withColumn("tree_user_id", F.col("user_id"))
    types = raw.select(F.col("client_type").alias("type_id")).distinct().withColumn("description", F.col("type_id"))
    statuses = raw.select(F.col("client_status").alias("status_id")).filter(F.col("status_id") != "Terminated").distinct()
    return marts.users_mart(users, seen, types, statuses.withColumn("description", F.col("status_id")), ts(tb.AS_OF))


@register("commissions_mart", sql(*tb.SALES, """SELECT o.commission_user_id AS tree_user_id, o.order_id AS run_id,
  o.order_date::VARCHAR AS run_date, CAST(year(o.order_date) * 100 + month(o.order_date) AS BIGINT) AS period_id,
  CAST(year(o.order_date) AS BIGINT) AS period_type_id, strftime(o.order_date, '%Y-%m') AS period,
  strftime(o.order_date, '%Y') AS period_type, 'USD' AS currency_code, o.total::DOUBLE AS earnings
  FROM sales_orders o WHERE o.commission_user_id IS NOT NULL"""))
def commissions_mart(spark, d):
    """Order totals as commissions of a run (the order) in a period (the month) of a type (the year)."""
    o = tb.orders(spark, d)
    month = F.year("order_date") * 100 + F.month("order_date")
    commissions = o.select(F.col("commission_user_id").alias("tree_user_id"), F.col("order_id").alias("run_id"),
                           F.lit("USD").alias("currency_code"), F.col("total").alias("earnings"))
    raw = tb.raw_orders(spark, d)
    runs = raw.select(F.col("order_id").alias("run_id"), F.col("order_date").alias("run_date"), month.alias("period_id"))
    periods = raw.select(month.alias("period_id"), F.year("order_date").alias("period_type_id"),
                         F.date_format("order_date", "yyyy-MM").alias("period")).distinct()
    kinds = raw.select(F.year("order_date").alias("period_type_id"), F.date_format("order_date", "yyyy").alias("period_type")).distinct()
    return marts.commissions_mart(tb.raw_users(spark, d), commissions, runs, periods, kinds)


@register("order_lines_mart", sql(tb.RAW_ORDERS, *tb.LINE_CTES, """SELECT o.order_id, o.tree_user_id, o.order_date::VARCHAR AS order_date,
  o.total::DOUBLE AS total, o.type, o.status, CAST(o.is_autoship AS BIGINT) AS is_autoship, l.line_id, l.product_id, l.product_code,
  l.product_description, l.quantity, l.price_total::DOUBLE AS price_total
  FROM raw_orders o JOIN lines l ON o.order_id = l.order_id"""))
def order_lines_mart(spark, d):
    raw = tb.raw_orders(spark, d).withColumnsRenamed({"type": "type_id", "status": "status_id"})
    raw = raw.withColumn("autoship_template_id", F.col("order_id") % 3 - 1).drop("is_autoship")
    types = raw.select("type_id").distinct().withColumn("description", F.col("type_id"))
    statuses = raw.select("status_id").distinct().withColumn("description", F.col("status_id"))
    return marts.order_lines_mart(raw, tb.order_lines(spark, d), types, statuses)


@register("site_visitors_mart", """SELECT c.c_custkey AS user_id, c.c_custkey AS tree_user_id, p.page_id AS site_id,
  e.event_id AS visitor_id, e.ts::VARCHAR AS last_visit_date, s.s_name AS third_party_tracking_company, s.s_suppkey AS tracking_code
  FROM pages p LEFT JOIN events e ON p.page_id = e.user_id JOIN customer c ON p.page_id = c.c_custkey
  LEFT JOIN supplier s ON c.c_custkey = s.s_suppkey""")
def site_visitors_mart(spark, d):
    sites = table(spark, d, "pages").select(F.col("page_id").alias("site_id"), F.col("page_id").cast("string").alias("user_id"))
    visitors = table(spark, d, "events").select(
        F.col("user_id").alias("site_id"), F.col("event_id").alias("visitor_id"), F.col("ts").alias("last_visit_date")
    )
    tracking = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("third_party_tracking_company"), F.col("s_suppkey").alias("tracking_code")
    )
    return marts.site_visitors_mart(sites, visitors, accounts(spark, d), tracking)


@register("logins_mart", """SELECT e.user_id, e.event_id AS login_id, e.ts::VARCHAR AS created_at, c.c_custkey AS tree_user_id
  FROM events e JOIN customer c ON e.user_id = c.c_custkey WHERE e.event_type <> 'error'""")
def logins_mart(spark, d):
    logins = table(spark, d, "events").select(
        "user_id", F.col("event_id").alias("login_id"), F.col("ts").alias("created_at"),
        F.when(F.col("event_type") == "error", F.col("user_id")).alias("proxied_by_id"),
    )
    return marts.logins_mart(accounts(spark, d), logins)


@register("reviews_mart", sql(tb.ITEMS, """SELECT o.o_custkey AS user_id, o.o_custkey AS tree_user_id, i.l_orderkey AS review_id,
  1 + CAST(i.l_quantity AS BIGINT) % 5 AS rating, p.p_name AS product_name, p.p_brand AS product_code
  FROM items i JOIN orders o ON i.l_orderkey = o.o_orderkey JOIN part p ON i.l_partkey = p.p_partkey"""))
def reviews_mart(spark, d):
    reviews = tb.items(spark, d).join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("product_id"), F.col("l_orderkey").alias("review_id"),
        (F.col("l_quantity").cast("long") % 5 + 1).alias("rating"),
    )
    part = table(spark, d, "part")
    products = part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"))
    variants = part.select(F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("sku"))
    return marts.reviews_mart(reviews, accounts(spark, d), products, variants)


@register("tasks_mart", """SELECT e.event_id AS id, d.text AS task_title, e.user_id, e.user_id AS tree_user_id,
  CAST(e.event_type = 'error' AS BIGINT) AS from_system
  FROM events e JOIN documents d ON CAST(json_extract_string(e.props, '$.k') AS BIGINT) = d.doc_id
  JOIN customer c ON e.user_id = c.c_custkey WHERE d.text NOT LIKE '%test%'""")
def tasks_mart(spark, d):
    titles = table(spark, d, "documents").select(F.col("doc_id").alias("asset_id"), F.col("text").alias("task_title"))
    tasks = event_links(spark, d).join(titles, "asset_id").select(
        F.col("link_id").alias("id"), "task_title", F.col("link_sharer_id").alias("user_id"),
        F.when(F.col("asset_type") == "error", "system").otherwise("user").alias("source"),
    )
    return marts.tasks_mart(tasks, accounts(spark, d))


# --- messages --------------------------------------------------------------------------------


def messages(spark, d):
    """Conversations as messages of a user, their turns as recipients."""
    conv = table(spark, d, "conversations")
    return conv.groupBy(F.col("conv_id").alias("message_id")).agg(
        F.max("turn").alias("sender_id"), F.max_by("role", F.struct("turn", "role")).alias("sender_type"),
    )


def recipients(spark, d):
    conv = table(spark, d, "conversations")
    return conv.select(
        F.col("conv_id").alias("message_id"), F.col("turn").alias("recipient_id"), F.col("role").alias("recipient_type"),
        F.length("text").cast("long").alias("size"),
        F.when(F.col("role") == "system", "sms").otherwise("email").alias("delivery_type"),
    )


def directories(spark, d):
    return {
        "user": (table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") + 100).alias("tree")), "c_custkey", "tree"),
        "assistant": (table(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") + 500).alias("tree")), "s_suppkey", "tree"),
    }


MESSAGES = """messages AS (SELECT conv_id AS message_id, max(turn) AS sender_id, arg_max(role, (turn, role)) AS sender_type
  FROM conversations GROUP BY conv_id)"""
MAILS = """mails AS (SELECT m.message_id, m.sender_id, m.sender_type,
    CASE m.sender_type WHEN 'user' THEN cs.c_custkey + 100 WHEN 'assistant' THEN ss.s_suppkey + 500 END AS sender_tree_user_id,
    c.turn AS recipient_id, c.role AS recipient_type, CAST(length(c.text) AS BIGINT) AS size,
    CASE c.role WHEN 'user' THEN cr.c_custkey + 100 WHEN 'assistant' THEN sr.s_suppkey + 500 END AS recipient_tree_user_id
  FROM messages m LEFT JOIN conversations c ON m.message_id = c.conv_id AND c.role <> 'system'
  LEFT JOIN customer cs ON m.sender_id = cs.c_custkey LEFT JOIN supplier ss ON m.sender_id = ss.s_suppkey
  LEFT JOIN customer cr ON c.turn = cr.c_custkey LEFT JOIN supplier sr ON c.turn = sr.s_suppkey)"""


@register("flat_emails", sql(MESSAGES, MAILS, "SELECT * FROM mails WHERE recipient_id IS NOT NULL"))
def flat_emails(spark, d):
    both = directories(spark, d)
    return marts.flat_emails(messages(spark, d), recipients(spark, d), both, both)


def _mails(spark, d, **options):
    both = directories(spark, d)
    fields = ["tree_user_id", "recipient_id", "recipient_type", "size"]
    return marts.nested_emails(messages(spark, d), recipients(spark, d), both, both, fields, **options)


def _recipients():
    return F.array_join(F.transform("recipients", lambda r: F.concat(
        r["recipient_type"], F.lit(":"), r["recipient_id"].cast("string"), F.lit(":"), r["size"].cast("string"))), ",").alias("listing")


@register("nested_emails", sql(MESSAGES, MAILS, """SELECT message_id, sender_id, sender_type, sender_tree_user_id,
  count(recipient_id) AS n, string_agg(recipient_type || ':' || recipient_id || ':' || size, ','
    ORDER BY recipient_tree_user_id NULLS FIRST, recipient_id, recipient_type, size) AS listing FROM mails GROUP BY ALL"""))
def nested_emails(spark, d):
    return _mails(spark, d)[0].select(
        "message_id", "sender_id", "sender_type", "sender_tree_user_id",
        F.coalesce(F.size("recipients"), F.lit(0)).alias("n"), _recipients(),
    )


RECIPIENTS = 2  # in one slice of the query below


@register("recipient_slices", sql(MESSAGES, MAILS, f"""placed AS (SELECT *, (row_number() OVER (PARTITION BY message_id
    ORDER BY recipient_tree_user_id NULLS FIRST, recipient_id, recipient_type, size) - 1) // {RECIPIENTS} AS slice
  FROM mails WHERE recipient_id IS NOT NULL)""", """SELECT message_id, slice, count(*) AS n,
  string_agg(recipient_type || ':' || recipient_id || ':' || size, ',' ORDER BY recipient_tree_user_id NULLS FIRST, recipient_id, recipient_type, size) AS listing
  FROM placed GROUP BY ALL"""))
def recipient_slices(spark, d):
    """Both tables of nested messages with two recipients a slice, put together again: nothing is lost or twice."""
    first, rest = _mails(spark, d, limit=RECIPIENTS)
    both = first.filter("recipients IS NOT NULL").select("message_id", F.lit(0).alias("slice"), "recipients").unionByName(rest)
    return both.select("message_id", "slice", F.size("recipients").alias("n"), _recipients())


@register("email_rollup", """WITH turns AS (SELECT conv_id, role, turn, length(text) AS size FROM conversations),
  per_message AS (SELECT conv_id, count(DISTINCT role) AS roles, min(size) AS shortest, max(turn) AS turns FROM turns GROUP BY conv_id)
  SELECT roles, count(*) AS messages, CAST(sum(turns) AS BIGINT) AS turns, CAST(min(shortest) AS BIGINT) AS shortest FROM per_message GROUP BY roles""")
def email_rollup(spark, d):
    """Turns rolled up per message, then messages by the number of roles."""
    turns = table(spark, d, "conversations").select("conv_id", "role", "turn", F.length("text").alias("size"))
    per_role = turns.groupBy("conv_id", "role").agg(F.min("size").alias("size"), F.max("turn").alias("turn"))
    per_message = per_role.groupBy("conv_id").agg(
        F.count("*").alias("roles"), F.min("size").alias("shortest"), F.max("turn").alias("turns")
    )
    return per_message.groupBy("roles").agg(
        F.count("*").alias("messages"), F.sum("turns").alias("turns"), F.min("shortest").alias("shortest")
    )


@register("nested_commissions", sql(*tb.SALES, """SELECT client_partition_id, client, commission_user_id AS tree_user_id, count(*) AS commissions,
  count(*) FILTER (type = 'Wholesale') AS details, count(*) FILTER (type = 'Retail' AND is_autoship) AS bonuses,
  count(DISTINCT strftime(order_date, '%Y-%m')) AS runs, sum(total)::DOUBLE AS earnings
  FROM sales_orders WHERE commission_user_id IS NOT NULL GROUP BY ALL"""))
def nested_commissions(spark, d):
    o = tb.orders(spark, d).filter(F.col("commission_user_id").isNotNull())
    keyed = o.select(
        "client_partition_id", "client", F.col("commission_user_id").alias("tree_user_id"),
        F.col("commission_user_id").cast("string").alias("client_user_id"), "order_id", "type", "is_autoship", "total",
        F.date_format("order_date", "yyyy-MM").alias("period"),
    )
    keys = ["client_partition_id", "client", "tree_user_id", "client_user_id"]
    out = marts.nested_commissions(
        keyed.select(*keys, "order_id", F.col("total").alias("earnings")),
        keyed.filter(F.col("type") == "Wholesale").select(*keys, "order_id", F.col("total").alias("source_amount")),
        keyed.filter((F.col("type") == "Retail") & F.col("is_autoship")).select(*keys, "order_id", F.col("total").alias("amount")),
        keyed.select(*keys, "period").distinct(),
    )
    earned = F.aggregate("commissions", F.lit(0).cast("decimal(28,2)"), lambda a, c: (a + c["earnings"]).cast("decimal(28,2)"))
    return out.select("client_partition_id", "client", "tree_user_id",
                      *[F.size(n).alias(n) for n in ("commissions", "details", "bonuses", "runs")], earned.alias("earnings"))


@register("top_n_per_key", sql(tb.RAW_ORDERS, """SELECT tree_user_id, order_id, total::DOUBLE AS total, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY tree_user_id ORDER BY total DESC, order_id) AS rank FROM raw_orders) WHERE rank <= 5"""))
def top_n_per_key(spark, d):
    order = [F.col("total").desc(), F.col("order_id")]
    return top_n(tb.raw_orders(spark, d).select("tree_user_id", "order_id", "total"), ["tree_user_id"], order, 5)
