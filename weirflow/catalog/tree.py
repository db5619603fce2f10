"""The sponsor tree: edges, closure, generations, sponsored sign-ups and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.catalog import testbed as tb
from weirflow.catalog.testbed import comparable, sql
from weirflow.functions.dates import ts
from weirflow.lineage import cut_lineage
from weirflow.operators.tree import all_sponsor_paths, closure, neighbours, refresh_closure, sponsor_edges, sponsor_paths
from weirflow.plans import downline

QUERIES: dict = {}


def register(name, sql_text):
    def add(fn):
        QUERIES[name] = (lambda spark, d: comparable(fn(spark, d)), sql_text)
        return fn
    return add


def edges(spark, d):
    return sponsor_edges(tb.users(spark, d))


EDGES = """edges AS (SELECT u.client_partition_id, u.tree_user_id AS user_id, u.sponsor_id FROM users u
  JOIN users s ON u.sponsor_id = s.tree_user_id WHERE u.tree_user_id <> 0)"""


@register("sponsor_edges", sql(*tb.PEOPLE, EDGES, """SELECT client_partition_id, user_id, sponsor_id AS neighbour_id, 'sponsor' AS relation FROM edges
  UNION ALL SELECT client_partition_id, sponsor_id, user_id, 'child' FROM edges"""))
def sponsor_neighbours(spark, d):
    return neighbours(edges(spark, d))


@register("downline_closure", sql(*tb.PEOPLE, tb.CLOSURE, "SELECT u.client_partition_id, upline_id, c.user_id, depth FROM closure c JOIN users u ON c.user_id = u.tree_user_id"))
def downline_closure(spark, d):
    return closure(all_sponsor_paths(edges(spark, d)))


@register("closure_refreshed", QUERIES["downline_closure"][1])
def closure_refreshed(spark, d):
    """The closure followed through two windows: sponsors move, users join.

    At first one user in five hangs below its sponsor's sponsor and one in seven is not there.
    """
    final = edges(spark, d)
    up = final.select("client_partition_id", F.col("user_id").alias("sponsor_id"), F.col("sponsor_id").alias("above"))
    lifted = final.join(up, ["client_partition_id", "sponsor_id"], "left").select(
        "client_partition_id", "user_id", F.when(F.col("user_id") % 5 == 0, F.col("above")).otherwise(F.col("sponsor_id")).alias("sponsor_id"))
    lifted = lifted.filter("sponsor_id IS NOT NULL")
    first = cut_lineage(lifted.filter("user_id % 7 > 0"))
    second = cut_lineage(lifted.filter("user_id % 5 > 0 OR user_id % 2 = 0").unionByName(final.filter("user_id % 5 = 0 AND user_id % 2 > 0")))
    stored = closure(all_sponsor_paths(first)).select("client_partition_id", "upline_id", "user_id", "depth")
    for before, after in ((first, second), (second, final)):
        stored = cut_lineage(refresh_closure(cut_lineage(stored), before, after))
    return stored


def _generations_sql() -> str:
    day = tb.AS_OF[:10]
    recent = f"u.created >= TIMESTAMP '{tb.AS_OF}' - INTERVAL 1 YEAR"
    out = [
        "min(CASE WHEN depth = 1 THEN date_diff('day', CAST(p.created AS DATE), CAST(u.created AS DATE)) END) AS days_to_first_downline_distributor",
        f"count(CASE WHEN date_diff('day', CAST(u.created AS DATE), DATE '{day}') BETWEEN 0 AND 30 THEN 1 END) AS downline_distributor_signups_last_30",
    ]
    for g in range(1, 7):
        out += [
            f"count(CASE WHEN depth = {g} AND {recent} THEN 1 END) AS rolling_12_month_gen{g}_distributors_count",
            f"count(CASE WHEN depth = {g} THEN 1 END) AS gen{g}_distributors_count",
            f"sum(CASE WHEN depth = {g} THEN lcv_12 END)::DOUBLE AS rolling_12_month_gen{g}_distributors_lcv",
            f"sum(CASE WHEN depth = {g} THEN lcv END)::DOUBLE AS gen{g}_distributors_lcv",
        ]
    return sql(
        *tb.PEOPLE, tb.RAW_ORDERS, tb.CLOSURE,
        f"""vals AS (SELECT tree_user_id, sum(total) AS lcv,
              sum(total) FILTER (order_date >= TIMESTAMP '{tb.AS_OF}' - INTERVAL 1 YEAR) AS lcv_12
            FROM raw_orders WHERE status <> 'Cancelled' GROUP BY tree_user_id)""",
        f"""SELECT u.client_partition_id, c.upline_id AS tree_user_id, {', '.join(out)} FROM closure c JOIN users u ON c.user_id = u.tree_user_id
            JOIN users p ON c.upline_id = p.tree_user_id LEFT JOIN vals v ON c.user_id = v.tree_user_id
            WHERE depth <= 6 AND u.type = 'Distributor' GROUP BY u.client_partition_id, c.upline_id""",
    )


@register("downline_generations", _generations_sql())
def downline_generations(spark, d):
    users = tb.users(spark, d)
    paths = sponsor_paths(edges(spark, d), attributes=tb.tree_attributes(spark, d).drop("client"))
    return downline.downline_generations(users, paths, tb.orders(spark, d), ts(tb.AS_OF))


PAIRS = """pairs AS (SELECT c.upline_id, c.user_id, p.client, p.created AS p_at, u.created AS u_at
  FROM closure c JOIN users p ON c.upline_id = p.tree_user_id JOIN users u ON c.user_id = u.tree_user_id AND p.client = u.client)"""


def sponsored_paths(spark, d):
    return all_sponsor_paths(edges(spark, d), tb.tree_attributes(spark, d))


@register("sponsored_signups", sql(*tb.PEOPLE, tb.CLOSURE, PAIRS, """SELECT client, upline_id AS user_id,
  count(CASE WHEN date_sub('day', p_at, u_at) < 8 THEN 1 END) AS signups_7_days, count(*) AS signups_30_days
  FROM pairs WHERE date_sub('day', p_at, u_at) < 31 GROUP BY client, upline_id"""))
def sponsored_signups(spark, d):
    return downline.sponsored_signups(tb.users(spark, d), sponsored_paths(spark, d))


def _sponsored_orders_sql() -> str:
    spans = {"before_signup": "secs < 0", "first_7_after_signup": "secs > -1 AND days < 8", "first_30_after_signup": "secs > -1"}
    out = ["min(secs) AS seconds_from_signup_to_first_order"]
    for name, test in spans.items():
        out += [f"count(*) FILTER ({test}) AS orders_{name}", f"sum(total) FILTER ({test})::DOUBLE AS total_{name}"]
    return sql(
        *tb.PEOPLE, tb.RAW_ORDERS, tb.CLOSURE, PAIRS,
        """timed AS (SELECT x.client, x.upline_id, o.total, date_sub('second', x.p_at, o.order_date) AS secs,
             date_sub('day', x.p_at, o.order_date) AS days FROM pairs x JOIN raw_orders o ON x.user_id = o.tree_user_id)""",
        f"SELECT client, upline_id AS user_id, {', '.join(out)} FROM timed WHERE days < 31 GROUP BY client, upline_id",
    )


@register("sponsored_orders", _sponsored_orders_sql())
def sponsored_orders(spark, d):
    return downline.sponsored_orders(tb.users(spark, d), sponsored_paths(spark, d), tb.orders(spark, d))
