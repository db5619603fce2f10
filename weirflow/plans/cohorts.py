"""Cohort, lifetime-value and first-sale reports.

They share one shape.  Orders are reduced to (owner, order type, day) before any join, so an
owner with a third of all orders becomes a few thousand rows.  Users add their sign-up date,
one more group gives a row per owner, and the report groups those rows into a handful of
buckets, on which the shares and running totals run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from weirflow.functions import fixed
from weirflow.functions.dates import days_between, month_text, ts, year_text
from weirflow.functions.rules import day_bucket, day_bucket_rank
from weirflow.operators.shares import ratio, running_total, total_over

DIGITS = 6
OWNER = ["client_partition_id", "owner_id"]  # ids are unique within a client only
RETAIL, WHOLESALE = "Retail", "Wholesale"


# --- the common steps ------------------------------------------------------------------------


def cohort(
    users: DataFrame, user_type: str | None = None, first: str | None = None, last: str | None = None,
    partition_id: int | None = None,
) -> DataFrame:
    """Users of a type and sign-up range with year, month and sign-up day."""
    out = users
    if user_type is not None:
        out = out.filter(F.col("type") == user_type)
    if first is not None:
        out = out.filter(F.col("created").between(ts(first), ts(last)))
    if partition_id is not None:
        out = out.filter(F.col("client_partition_id") == partition_id)
    return out.select(
        "client_partition_id",
        F.col("tree_user_id").alias("owner_id"),
        year_text(F.col("created")).alias("year"),
        month_text(F.col("created")).alias("month"),
        F.to_date("created").alias("signup"),
    )


def owner_days(orders: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """Open orders per owner, type and day: count and total.  Any order row counts once, so
    ``orders`` must hold one row per order."""
    kept = orders.filter(F.col("status") != "Cancelled")
    if types is not None:
        kept = kept.filter(F.col("type").isin(*types))
    return kept.groupBy(
        "client_partition_id", F.col("commission_user_id").alias("owner_id"), F.col("type").alias("order_type"),
        F.to_date("order_date").alias("day"),
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("total"))


def cohort_days(people: DataFrame, days: DataFrame, how: str = "left") -> DataFrame:
    """Each user's days with orders and their distance to the sign-up; users without orders
    keep one empty row under ``left``."""
    return people.join(days, OWNER, how).withColumn(
        "days_to_order", days_between(F.col("signup"), F.col("day"))
    )


PERIODS = [("", 0, None), *[(f"_{name}", low, high) for name, low, high in fixed.VALUE_PERIODS]]
KINDS = {"sales": RETAIL, "wholesale": WHOLESALE}

# The wide reports below name their measures in SQL text: one expression per output column.


def _in_period(low: int, high: int | None) -> str:
    return f"days_to_order >= {low}" if high is None else f"days_to_order BETWEEN {low} AND {high}"


def owner_values(rows: DataFrame, first_types: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per owner: first and last day among the orders passing ``first_types``, and for
    every period and kind the number and value of orders.

    Owners whose only orders lie before the sign-up vanish, owners without orders stay.
    """
    picked = f"CASE WHEN {first_types} THEN days_to_order END"
    measures = [f"min({picked}) AS first_days", f"max({picked}) AS last_days"]
    for prefix, low, high in PERIODS:
        for kind, order_type in KINDS.items():
            hit = f"order_type = '{order_type}' AND {_in_period(low, high)}"
            measures += [
                f"sum(CASE WHEN {hit} THEN n END) AS {prefix}_{kind}_n",
                f"sum(CASE WHEN {hit} THEN total END) AS {prefix}_{kind}_t",
            ]
    counted = rows.filter("days_to_order >= 0 OR days_to_order IS NULL")
    return counted.groupBy(*OWNER, *by).agg(*[F.expr(m) for m in measures])


def bucket_values(owners: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Owner rows summed per first-sale bucket (and ``by``): orders, value and owners for every
    period and kind.  An owner counts where it has an order, so no distinct count is needed."""
    measures = ["count(1) AS owner_count"]
    for edge in ("first", "last"):
        measures += [f"{how}({edge}_days) AS {how}_days_to_{edge}_order" for how in ("avg", "min", "max")]
    for prefix, _, _ in PERIODS:
        for kind in KINDS:
            n, t = f"{prefix}_{kind}_n", f"{prefix}_{kind}_t"
            measures += [
                f"coalesce(sum({n}), 0) AS {prefix}_{kind}_count",
                f"sum({t}) AS {prefix}_{kind}_total",
                f"count_if({n} > 0) AS {prefix}_{kind}_user_count",
            ]
        n = " + ".join(f"coalesce({prefix}_{kind}_n, 0)" for kind in KINDS)
        t = " + ".join(f"coalesce({prefix}_{kind}_t, 0)" for kind in KINDS)
        measures += [
            f"sum({n}) AS {prefix}_count",
            f"sum(CASE WHEN {n} > 0 THEN {t} END) AS {prefix}_total",
            f"count_if({n} > 0) AS {prefix}_user_count",
        ]
    keys = {"days_to_order_bucket": day_bucket(F.col("first_days")),
            "bucket_order": day_bucket_rank(F.col("first_days"))}
    return owners.withColumns(keys).groupBy(*by, *keys).agg(*[F.expr(m) for m in measures])


def _share(a: str, b: str, name: str) -> str:
    return f"round(try_divide(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), {DIGITS}) AS {name}"


def _share_if(test: str, a: str, b: str, name: str) -> str:
    return f"CASE WHEN {test} > 0 THEN round(try_divide(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), {DIGITS}) END AS {name}"


def _kind_columns(prefix: str, kind: str, rev_user: str) -> list[str]:
    """Count, value and their averages of one period and kind (both kinds for '')."""
    k, p = (f"{kind}_" if kind else ""), (f"{prefix}_" if prefix else "")
    n, t, u = f"{prefix}_{k}count", f"{prefix}_{k}total", f"{prefix}_{k}user_count"
    return [
        f"{n} AS {p}{k}count",
        _share_if(n, n, u, f"{p}avg_{k}count_user"),
        f"{t} AS {p}{k}total",
        _share_if(t, t, n, f"{p}avg_{k}rev_sale"),
        _share_if(t, t, u, f"{p}{rev_user}"),
    ]


# --- reports ---------------------------------------------------------------------------------


def lifetime_value(
    users: DataFrame, orders: DataFrame | None, user_type: str | None = "Distributor",
    first: str | None = None, last: str | None = None, days: DataFrame | None = None,
) -> DataFrame:
    """Value per first-sale bucket: owners, shares, running totals, averages.  ``days`` are stored
    days (``rollup.stored_days``) in place of the orders."""
    rows = cohort_days(cohort(users, user_type, first, last), owner_days(orders) if days is None else days)
    values = bucket_values(owner_values(rows, f"order_type <> '{WHOLESALE}' AND days_to_order >= 0"))
    running = "sum(owner_count) OVER (ORDER BY bucket_order)"
    return values.selectExpr(
        "days_to_order_bucket",
        "owner_count AS mp_count",
        _share("owner_count", "sum(owner_count) OVER ()", "mp_percent_of_total"),
        f"{running} AS mp_running_total",
        _share(running, "sum(owner_count) OVER ()", "mp_percent_of_running_total"),
        *[f"round(avg_days_to_{edge}_order, {DIGITS}) AS avg_days_to_{edge}_order" for edge in ("first", "last")],
        *_kind_columns("", "sales", "avg_sales_rev_user"),
        *_kind_columns("", "wholesale", "avg_wholesale_rev_user"),
        *_kind_columns("", "", "avg_rev_user"),
        _share_if("sum(_total) OVER ()", "_total", "sum(_total) OVER ()", "percent_of_total"),
    )


def year_cohort_value(
    users: DataFrame, orders: DataFrame | None, user_type: str | None = "Distributor",
    first: str | None = None, last: str | None = None, days: DataFrame | None = None,
) -> DataFrame:
    """The same per sign-up month, with every period's own counts, values and shares."""
    by = ["year", "month"]
    rows = cohort_days(cohort(users, user_type, first, last), owner_days(orders) if days is None else days)
    values = bucket_values(owner_values(rows, f"order_type = '{RETAIL}' AND days_to_order >= 0", by), by)
    month = "OVER (PARTITION BY year, month)"
    running = "sum(_sales_user_count) OVER (PARTITION BY year, month ORDER BY bucket_order)"
    out = [
        "concat(month, '/', year) AS cohort",
        *by,
        "days_to_order_bucket",
        "_sales_user_count AS mp_count",
        _share("_sales_user_count", f"sum(_sales_user_count) {month}", "mp_percent_of_total"),
        f"{running} AS mp_running_total",
        _share(running, f"sum(_sales_user_count) {month}", "mp_percent_of_running_total"),
    ]
    for edge in ("first", "last"):
        out += [
            f"min_days_to_{edge}_order",
            f"max_days_to_{edge}_order",
            f"round(avg_days_to_{edge}_order, {DIGITS}) AS avg_days_to_{edge}_order",
        ]
    for prefix, _, _ in PERIODS:
        p = f"{prefix}_" if prefix else ""
        out += _kind_columns(prefix, "sales", "avg_sales_rev_user")
        out += _kind_columns(prefix, "wholesale", "wholesale_rev_user" if prefix else "avg_wholesale_rev_user")
        out += _kind_columns(prefix, "", "avg_rev_user")
        if prefix == "_30":
            for kind in KINDS:
                for what in ("count", "total"):
                    whole, part = f"_{kind}_{what}", f"{prefix}_{kind}_{what}"
                    out.append(_share_if(whole, part, whole, f"{part}_percent"))
        month_total = f"sum({prefix}_total) {month}"
        out.append(_share_if(month_total, f"{prefix}_total", month_total, f"{p}percent_of_month_total"))
        if prefix:
            out += [
                _share_if("_count", f"{prefix}_count", "_count", f"{p}percent_of_total_count"),
                _share_if("_total", f"{prefix}_total", "_total", f"{p}percent_of_total_rev"),
            ]
    return values.selectExpr(*out)


UPLIFT_PERIODS = ["_30", "_31_90", "_91_180", "_181_365", "_366_730"]


def uplift(cohorts: DataFrame, rate: float = 0.02) -> DataFrame:
    """What selling ``rate`` more per buyer would add, per cohort row and over all of them.

    ``cohorts`` is the cohort report: one row per month and bucket, so the totals over all rows
    run on a small set.
    """
    out, gains = ["cohort", "days_to_order_bucket", "mp_count"], []
    for p in UPLIFT_PERIODS:
        parts = {
            kind: f"{p}_avg_{kind}_count_user * {rate}D * {p}_avg_{kind}_rev_sale * mp_count" for kind in KINDS
        }
        gain = " + ".join(f"coalesce({part}, 0D)" for part in parts.values())
        gains.append(f"({gain})")
        out += [
            *[f"{p}_avg_{kind}_{what}" for kind in KINDS for what in ("count_user", "rev_sale")],
            f"{p}_total",
            *[f"round({part}, 4) AS {p}_{kind}_rev_increase" for kind, part in parts.items()],
            f"round({gain}, 4) AS {p}_total_rev_increase",
            f"round(sum({gain}) OVER (), 4) AS {p}_agg_rev_increase",
        ]
    out += [
        "sum(total) OVER () AS agg_rev_total",
        f"round(sum({' + '.join(gains)}) OVER (), 4) AS agg_rev_increase",
    ]
    return cohorts.selectExpr(*out)


def days_to_first_sale(users: DataFrame, orders: DataFrame, user_type: str | None = "Distributor",
                       partition_id: int | None = None) -> DataFrame:
    """How many owners made their first sale n days after signing up, with running shares.

    One row per distinct day count reaches the running totals.
    """
    people = cohort(users, user_type, partition_id=partition_id)
    rows = cohort_days(people, owner_days(orders), "inner").filter(F.col("order_type") != WHOLESALE)
    firsts = rows.groupBy(*OWNER).agg(F.min("days_to_order").alias("days_to_first_sale"))
    summed = firsts.groupBy("days_to_first_sale").agg(F.count("*").alias("num")).filter(F.col("num") > 0)
    num, day = F.col("num"), F.col("days_to_first_sale")
    from_zero = F.when(day > -1, num)
    running, running_zero = running_total(num, [day]), running_total(from_zero, [day])
    return summed.select(
        day,
        num,
        F.round(ratio(num, total_over(num)), DIGITS).alias("percent_of_total"),
        running.alias("running_total"),
        F.round(ratio(running, total_over(num)), DIGITS).alias("percent_of_running_total"),
        running_zero.alias("running_total_from_zero"),
        F.round(ratio(running_zero, total_over(from_zero)), DIGITS).alias("percent_of_running_total_from_zero"),
    )


def days_to_last_sale(users: DataFrame, orders: DataFrame, first: str, last: str) -> DataFrame:
    """How many owners made their last retail sale n days after signing up."""
    people = cohort(users, None, first, last)
    rows = cohort_days(people, owner_days(orders, [RETAIL]), "inner")
    lasts = rows.groupBy(*OWNER).agg(F.max("days_to_order").alias("days_to_last_sale"))
    return lasts.groupBy("days_to_last_sale").agg(F.count("*").alias("num_retail_sales")).orderBy("days_to_last_sale")


def fast_starters(users: DataFrame, orders: DataFrame, first: str, last: str, start_days: int = 30,
                  horizon: int = 502) -> DataFrame:
    """Owners with a first retail sale within ``start_days``, and their sales up to ``horizon``
    days; owners without a wholesale order in that time are left out."""
    people = cohort(users, None, first, last)
    rows = cohort_days(people, owner_days(orders, [RETAIL, WHOLESALE]), "inner").filter(
        F.col("days_to_order").between(0, horizon)
    )
    retail, wholesale = F.col("order_type") == RETAIL, F.col("order_type") == WHOLESALE
    measured = rows.groupBy("client_partition_id", F.col("owner_id").alias("commission_user_id")).agg(
        F.min(F.when(retail, F.col("days_to_order"))).alias("days_to_first_sale"),
        F.max(F.when(retail, F.col("days_to_order"))).alias("days_to_last_sale"),
        F.sum(F.when(retail, F.col("n"))).alias("active_sales_count"),
        F.sum(F.when(wholesale, F.col("n"))).alias("active_wholesale_count"),
        F.sum(F.when(retail, F.coalesce(F.col("total"), F.lit(0)))).alias("active_sales_total"),
        F.sum(F.when(wholesale, F.coalesce(F.col("total"), F.lit(0)))).alias("active_wholesale_total"),
    )
    return measured.filter(
        F.col("days_to_first_sale").between(0, start_days) & F.col("active_wholesale_count").isNotNull()
    ).orderBy(
        F.col("active_sales_total").desc(), F.col("active_wholesale_count").desc(),
        F.col("days_to_last_sale").desc(), F.col("days_to_first_sale").asc(),
    )


def order_mix(users: DataFrame, orders: DataFrame, user_type: str = "Distributor") -> DataFrame:
    """Orders by buyer type, order type and autoship flag, with shares inside each level."""
    owners = users.filter(F.col("type") == user_type).select(
        "client_partition_id", F.col("tree_user_id").alias("commission_user_id"))
    kept = orders.filter(F.col("type").isin(RETAIL, WHOLESALE) & (F.col("status") != "Cancelled"))
    # one row per pair of owner and buyer instead of one per order meets the two joins
    pairs = kept.groupBy("client_partition_id", "commission_user_id", "tree_user_id", F.col("type").alias("order_type"), "is_autoship").agg(
        F.count(F.lit(1)).alias("n")
    )
    buyers = users.select("client_partition_id", "tree_user_id", F.col("type").alias("user_type"))
    mix = (
        pairs.join(owners, ["client_partition_id", "commission_user_id"], "left_semi")
        .join(buyers, ["client_partition_id", "tree_user_id"])
        .groupBy("user_type", "order_type", "is_autoship")
        .agg(F.sum("n").alias("count"))
    )
    n = F.col("count")
    over = {"types": ["user_type", "order_type"], "user_type": ["user_type"], "all": []}
    out = [F.col("user_type"), F.col("order_type"), F.col("is_autoship"), n]
    for name, keys in over.items():
        whole = total_over(n, keys)
        out += [
            whole.alias(f"count_over_{name}"),
            F.round(F.lit(100.0) * ratio(n, whole), 2).alias(f"per_over_{name}"),
        ]
    return mix.select(*out)
