"""Reports over users whose ids repeat between clients.

The test relations' ids are unique over all clients, so nothing there would tell a plan that forgets the
client.  Here each client numbers its users from 1; results, with the ids named back, have to be those
of the same reports over unique ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weirflow.catalog import reports, testbed as tb, tree, versions
from weirflow.catalog.testbed import comparable
from weirflow.functions.dates import ts
from weirflow.operators.tree import all_sponsor_paths, closure, refresh_closure, sponsor_edges, sponsor_paths
from weirflow.plans import cohorts, downline
from weirflow.plans.sellers import seller_metrics

QUERIES: dict = {}
CLIENTS = 5  # a user's client is its number modulo this


def register(name, sql_text):
    def add(fn):
        QUERIES[name] = (lambda spark, d: comparable(fn(spark, d)), sql_text)
        return fn
    return add


def renumbered(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.expr(f"{c} div {CLIENTS} + 1") for c in columns})


def named_back(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: (F.col(c) - 1) * CLIENTS + F.col("client_partition_id") for c in columns})


def users(spark, d):
    return renumbered(tb.users(spark, d), "tree_user_id", "user_id", "sponsor_id")


def orders(spark, d):
    return renumbered(tb.orders(spark, d), "tree_user_id", "commission_user_id")


@register("lifetime_value_shared_ids", reports.QUERIES["lifetime_value"][1])
def lifetime_value(spark, d):
    return cohorts.lifetime_value(users(spark, d), orders(spark, d))


@register("year_cohort_value_shared_ids", reports.QUERIES["year_cohort_value"][1])
def year_cohort_value(spark, d):
    return cohorts.year_cohort_value(users(spark, d), orders(spark, d))


@register("order_metrics_shared_ids", versions.QUERIES["distributor_order_metrics"][1])
def order_metrics(spark, d):
    people = users(spark, d).select("client", "tree_user_id", "created", "client_status", F.col("type").alias("client_type"))
    bought = renumbered(versions.revised_orders(spark, d), "tree_user_id")
    return named_back(seller_metrics(people, bought, tb.clients(spark, d), ts(tb.AS_OF)), "tree_user_id")


@register("closure_shared_ids", tree.QUERIES["downline_closure"][1])
def shared_closure(spark, d):
    """The closure made from a part of the edges and then followed to all of them."""
    final = sponsor_edges(users(spark, d))
    first = final.filter("user_id % 3 > 0")
    start = closure(all_sponsor_paths(first)).select("client_partition_id", "upline_id", "user_id", "depth")
    return named_back(refresh_closure(start, first, final), "upline_id", "user_id")


@register("generations_shared_ids", tree.QUERIES["downline_generations"][1])
def generations(spark, d):
    people = users(spark, d)
    marks = people.select("client_partition_id", F.col("tree_user_id").alias("user_id"), F.col("created").alias("signup"))
    paths = sponsor_paths(sponsor_edges(people), attributes=marks)
    out = downline.downline_generations(people, paths, orders(spark, d), ts(tb.AS_OF))
    return named_back(out, *[c for c in ("tree_user_id", "user_id") if c in out.columns])
