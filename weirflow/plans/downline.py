"""Reports over the sponsor tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.functions import fixed
from weirflow.functions.dates import days_between, one_year_before, whole_units
from weirflow.functions.rules import day_bucket, day_bucket_rank, is_college, membership_type, product_type
from weirflow.operators.nesting import unnest
from weirflow.operators.shares import ratio
from weirflow.operators.tree import closure, per_generation

DIGITS = 6
USER = ["client_partition_id", "user_id"]
BUYER = ["client_partition_id", "tree_user_id"]  # ids are unique within a client only


# --- recruits and product value --------------------------------------------------------------


def recruits(users: DataFrame) -> DataFrame:
    """Per sponsor: first recruit, number of recruits, days to them.

    Recruits are counted per sponsor and sign-up day first; only those rows meet the sponsor's
    own date, so a sponsor of a third of all users is a few thousand rows.
    """
    per_day = users.groupBy("client_partition_id", F.col("sponsor_id").alias("tree_user_id"), F.to_date("coded").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    sponsors = users.select(*BUYER, F.to_date("coded").alias("own_day"))
    rows = per_day.join(sponsors, BUYER).withColumn("days", days_between(F.col("own_day"), F.col("day")))
    n, days = F.col("n"), F.col("days")
    return rows.filter(days > 0).groupBy(*BUYER).agg(
        F.min(days).alias("days_to_signup"),
        F.sum(n).alias("cnt"),
        F.sum(F.when(days.between(0, 30), n).otherwise(0)).alias("first_30_cnt"),
        (F.sum(days * n) / F.sum(n)).alias("avg_days_to_signup"),
        F.max(days).alias("max_days_to_signup"),
    )


def classified_lines(orders: DataFrame) -> DataFrame:
    """Active order lines with product type and membership from the product text."""
    active = orders.filter(F.col("status") == "Active")
    lines = unnest(active, "products", ["client_partition_id", "tree_user_id", "order_id"])
    text = F.col("product_description")
    return lines.select(
        "client_partition_id", "tree_user_id", "order_id", F.col("price_total").alias("total"),
        product_type(text).alias("product_type"), membership_type(text).alias("membership_type"),
        is_college(text).alias("is_college"),
    )


def _product_groups() -> dict[str, Column]:
    kind, rep = F.col("product_type"), F.col("membership_type") == "rep"
    groups = {}
    for prefix, member in (("vaca", ~rep), ("rep", rep)):
        for name, wanted in (("fees", "fee"), ("discounts", "discount"), ("subs", "subscription")):
            groups[f"{prefix}_{name}"] = (kind == wanted) & member
    groups["event"] = kind == "event"
    groups["product"] = kind == "product"
    return groups


def product_values(orders: DataFrame) -> DataFrame:
    """Per buyer: number and value of lines of each product group."""
    measures = []
    for name, hit in _product_groups().items():
        measures += [
            F.count(F.when(hit, F.col("order_id"))).alias(f"{name}_cnt"),
            F.sum(F.when(hit, F.col("total")).otherwise(0)).alias(f"{name}_tot"),
        ]
    lines = classified_lines(orders)
    return lines.groupBy(*BUYER).agg(*measures, F.sum("total").alias("tot"))


def downline_value(users: DataFrame, orders: DataFrame, user_type: str = "Distributor") -> DataFrame:
    """Recruiting and product value by the time to the first recruit."""
    people = users.filter(F.col("type") == user_type).select(*BUYER)
    rows = (
        people.join(recruits(users), BUYER, "left")
        .join(product_values(orders), BUYER, "left")
    )
    users_n = F.count(F.lit(1))
    out = [
        users_n.alias("cnt"),
        F.sum("cnt").alias("sponsored_cnt"),
        F.sum("first_30_cnt").alias("sponsored_first_30_cnt"),
        F.round(F.avg("avg_days_to_signup"), DIGITS).alias("avg_days_to_signup"),
        F.round(F.avg("days_to_signup"), DIGITS).alias("avg_min_days_to_signup"),
        F.round(F.avg("max_days_to_signup"), DIGITS).alias("avg_max_days_to_signup"),
        F.round(F.avg(F.col("max_days_to_signup") - F.col("days_to_signup")), DIGITS).alias("avg_days_active"),
    ]
    for name in _product_groups():
        for part in ("cnt", "tot"):
            total = F.sum(F.coalesce(F.col(f"{name}_{part}"), F.lit(0)))
            out.append(total.alias(f"{name}_{part}"))
            if name.endswith("subs"):
                out.append(F.round(ratio(total, users_n), DIGITS).alias(f"{name}_{part}_per_user"))
    value = F.sum(F.coalesce(F.col("tot"), F.lit(0)))
    out += [value.alias("tot"), F.round(ratio(value, users_n), DIGITS).alias("avg_rev_per_user")]
    edges = fixed.FINE_DAY_BUCKETS
    keyed = rows.withColumns(
        {
            "bucket": day_bucket(F.col("days_to_signup"), edges),
            "bucket_order": day_bucket_rank(F.col("days_to_signup"), edges),
        }
    )
    return keyed.groupBy("bucket", "bucket_order").agg(*out).orderBy("bucket_order").drop("bucket_order")


def subscription_by_class(users: DataFrame, orders: DataFrame) -> DataFrame:
    """Subscription lines by membership: lines, buyers, value.  Buyers are counted from one row
    per membership and buyer."""
    lines = classified_lines(orders).filter(F.col("product_type") == "subscription")
    per_buyer = lines.groupBy("membership_type", "client_partition_id", "tree_user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total").alias("total")
    )
    known = per_buyer.join(
        users.select("client_partition_id", "tree_user_id"), ["client_partition_id", "tree_user_id"], "left_semi"
    )
    return known.groupBy("membership_type").agg(
        F.sum("n").alias("cnt"),
        F.count(F.lit(1)).alias("distinct_users"),
        F.sum("total").alias("total"),
        F.round(ratio(F.sum("total"), F.count(F.lit(1))), DIGITS).alias("avg_tot_per_user"),
    )


# --- generations -----------------------------------------------------------------------------


def downline_generations(users: DataFrame, paths: DataFrame, orders: DataFrame, as_of: Column,
                         user_type: str = "Distributor") -> DataFrame:
    """Distributors and their lifetime value in each of six generations below a user, ever and
    among those who joined in the last 12 months; days to the first one; new ones in the last
    30 days.

    ``paths`` carries each ancestor's ``signup``.  Orders are summed per buyer before anything
    else; the walk up then adds at most six rows per user, grouped by ancestor.
    """
    year_ago = one_year_before(as_of)
    value = orders.filter(F.col("status") != "Cancelled").groupBy(*BUYER).agg(
        F.sum("total").alias("lcv"),
        F.sum(F.when(F.col("order_date") >= year_ago, F.col("total"))).alias("lcv_12"),
    )
    members = users.filter(F.col("type") == user_type).select("client_partition_id", F.col("tree_user_id").alias("user_id"), "created")
    # one row per user meets the joins; the paths are unfolded after them
    rows = closure(
        paths.join(members, USER).join(value.withColumnRenamed("tree_user_id", "user_id"), USER, "left")
    )
    depth, one = F.col("depth"), F.lit(1)
    recent = F.col("created") >= year_ago
    fresh = days_between(F.col("created"), as_of).between(0, 30)
    first = F.when(depth == 1, days_between(F.col("upline_signup"), F.col("created")))
    return rows.groupBy("client_partition_id", F.col("upline_id").alias("tree_user_id")).agg(
        F.min(first).alias("days_to_first_downline_distributor"),
        F.count(F.when(fresh, 1)).alias("downline_distributor_signups_last_30"),
        *per_generation(one, depth, "rolling_12_month_gen{g}_distributors_count", "count", recent),
        *per_generation(one, depth, "gen{g}_distributors_count", "count"),
        *per_generation(F.col("lcv_12"), depth, "rolling_12_month_gen{g}_distributors_lcv", "sum"),
        *per_generation(F.col("lcv"), depth, "gen{g}_distributors_lcv", "sum"),
    )


# --- sponsored sign-ups and orders -----------------------------------------------------------


def _near(paths: DataFrame, at: str) -> DataFrame:
    """Only ancestors whose sign-up lies less than 31 days before ``at``, or after it.

    Each path entry carries the ancestor's sign-up, so rows are unfolded for these alone.
    """
    return paths.withColumn("path", F.filter("path", lambda p: whole_units("DAY", p["signup"], F.col(at)) < 31))


def sponsored_signups(users: DataFrame, paths: DataFrame) -> DataFrame:
    """Sign-ups below a user within 7 and 30 days of the user's own.

    Sign-ups before the ancestor's own count too, as elapsed days are then negative.
    """
    own = users.select("client_partition_id", F.col("tree_user_id").alias("user_id"), "client", F.col("created").alias("signup"))
    rows = closure(_near(paths.join(own, USER), "signup"))
    days = whole_units("DAY", F.col("upline_signup"), F.col("signup"))
    return (
        rows.withColumn("days", days)
        .groupBy("client", F.col("upline_id"))
        .agg(F.count(F.when(F.col("days") < 8, 1)).alias("signups_7_days"), F.count("*").alias("signups_30_days"))
        .withColumnRenamed("upline_id", "user_id")
    )


def sponsored_orders(users: DataFrame, paths: DataFrame, orders: DataFrame, amounts=("total",)) -> DataFrame:
    """Orders below a user before the user's sign-up and 7 and 30 days after it.

    Orders are summed per buyer and time first; a buyer's path is cut to the ancestors that count
    before it is unfolded.
    """
    own = users.select("client_partition_id", F.col("tree_user_id").alias("user_id"), "client")
    bought = orders.groupBy("client_partition_id", F.col("tree_user_id").alias("user_id"), "order_date").agg(
        F.count("*").alias("n"), *[F.sum(a).alias(a) for a in amounts])
    # path first, orders second: the join that grows is followed by a group on another key
    rows = closure(_near(bought.join(paths.join(own, USER), USER), "order_date"))
    timed = rows.select(
        "client", "upline_id", "n", *amounts,
        whole_units("SECOND", F.col("upline_signup"), F.col("order_date")).alias("secs"),
        whole_units("DAY", F.col("upline_signup"), F.col("order_date")).alias("days"),
    )
    spans = {
        "before_signup": F.col("secs") < 0,
        "first_7_after_signup": (F.col("secs") > -1) & (F.col("days") < 8),
        "first_30_after_signup": F.col("secs") > -1,
    }
    measures = [F.min("secs").alias("seconds_from_signup_to_first_order")]
    for name, hit in spans.items():
        measures.append(F.sum(F.when(hit, F.col("n")).otherwise(0)).alias(f"orders_{name}"))
        measures += [F.sum(F.when(hit, F.col(a))).alias(f"{a}_{name}") for a in amounts]
    return timed.groupBy("client", F.col("upline_id").alias("user_id")).agg(*measures)
