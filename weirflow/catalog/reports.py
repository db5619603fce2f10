"""Cohort, lifetime-value, usage and product reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.catalog import testbed as tb
from weirflow.catalog.people import EVENT_PLATFORM_SQL, bucket_case, like_case
from weirflow.catalog.testbed import comparable, sql, table
from weirflow.functions import fixed, rules
from weirflow.functions.dates import ts
from weirflow.lineage import work_folder, written
from weirflow.operators import sketches
from weirflow.operators.nesting import nest
from weirflow.plans import cohorts, downline, rollup, usage

QUERIES: dict = {}


def register(name, sql_text):
    def add(fn):
        QUERIES[name] = (lambda spark, d: comparable(fn(spark, d)), sql_text)
        return fn
    return add


FIRST, LAST = "1995-02-01 00:00:00", "1996-06-30 00:00:00"

# users left-joined to their orders, one row per order; the reports' shared starting point
JOINED = f"""joined AS (
  SELECT u.tree_user_id AS owner_id, strftime(u.created, '%Y') AS year, strftime(u.created, '%m') AS month,
         CAST(u.created AS DATE) AS signup, o.order_id, o.type, o.total, o.order_date, o.tree_user_id AS buyer_id,
         date_diff('day', CAST(u.created AS DATE), CAST(o.order_date AS DATE)) AS days
  FROM users u LEFT JOIN sales_orders o ON o.commission_user_id = u.tree_user_id AND o.status <> 'Cancelled'
  WHERE u.type = 'Distributor')"""


# --- first and last sale ---------------------------------------------------------------------


@register("days_to_first_sale", sql(*tb.SALES, JOINED,
  "firsts AS (SELECT owner_id, arg_min(days, (order_date, order_id)) AS days FROM joined WHERE type <> 'Wholesale' GROUP BY owner_id)",
  "summ AS (SELECT days, count(DISTINCT owner_id) AS num FROM firsts GROUP BY days HAVING count(*) > 0)",
  """SELECT days AS days_to_first_sale, num, round(num / CAST(sum(num) OVER () AS DOUBLE), 6) AS percent_of_total,
  CAST(sum(num) OVER (ORDER BY days) AS BIGINT) AS running_total,
  round(CAST(sum(num) OVER (ORDER BY days) AS DOUBLE) / sum(num) OVER (), 6) AS percent_of_running_total,
  CAST(sum(CASE WHEN days > -1 THEN num END) OVER (ORDER BY days) AS BIGINT) AS running_total_from_zero,
  round(CAST(sum(CASE WHEN days > -1 THEN num END) OVER (ORDER BY days) AS DOUBLE) / sum(CASE WHEN days > -1 THEN num END) OVER (), 6) AS percent_of_running_total_from_zero
  FROM summ"""))
def days_to_first_sale(spark, d):
    return cohorts.days_to_first_sale(tb.users(spark, d), tb.orders(spark, d))


@register("days_to_last_sale", sql(*tb.SALES, f"""SELECT days AS days_to_last_sale, count(*) AS num_retail_sales FROM (
  SELECT u.tree_user_id, max(date_diff('day', CAST(u.created AS DATE), CAST(o.order_date AS DATE))) AS days
  FROM users u JOIN sales_orders o ON u.tree_user_id = o.commission_user_id
  WHERE o.type = 'Retail' AND o.status <> 'Cancelled' AND u.created BETWEEN TIMESTAMP '{FIRST}' AND TIMESTAMP '{LAST}'
  GROUP BY u.tree_user_id) GROUP BY days"""))
def days_to_last_sale(spark, d):
    return cohorts.days_to_last_sale(tb.users(spark, d), tb.orders(spark, d), FIRST, LAST)


@register("fast_starters", sql(*tb.SALES, f"""j AS (
  SELECT u.client_partition_id AS cp, u.tree_user_id AS id, o.type, o.total, date_diff('day', CAST(u.created AS DATE), CAST(o.order_date AS DATE)) AS days
  FROM users u JOIN sales_orders o ON u.tree_user_id = o.commission_user_id
  WHERE o.status <> 'Cancelled' AND u.created BETWEEN TIMESTAMP '{FIRST}' AND TIMESTAMP '{LAST}'
  AND date_diff('day', CAST(u.created AS DATE), CAST(o.order_date AS DATE)) BETWEEN 0 AND 502)""",
  "s AS (SELECT cp, id, count(*) AS n, sum(total) AS t, min(days) AS f, max(days) AS l FROM j WHERE type = 'Retail' GROUP BY cp, id)",
  "w AS (SELECT id, count(*) AS n, sum(total) AS t FROM j WHERE type = 'Wholesale' GROUP BY id)",
  """SELECT s.cp AS client_partition_id, s.id AS commission_user_id, s.f AS days_to_first_sale, s.l AS days_to_last_sale, s.n AS active_sales_count,
  w.n AS active_wholesale_count, s.t::DOUBLE AS active_sales_total, w.t::DOUBLE AS active_wholesale_total
  FROM s JOIN w ON s.id = w.id WHERE s.f BETWEEN 0 AND 30"""))
def fast_starters(spark, d):
    return cohorts.fast_starters(tb.users(spark, d), tb.orders(spark, d), FIRST, LAST)


# --- lifetime value --------------------------------------------------------------------------


def _period_test(low, high) -> str:
    return f"days >= {low}" if high is None else f"days BETWEEN {low} AND {high}"


KIND_TESTS = {"sales_": "type = 'Retail'", "wholesale_": "type = 'Wholesale'", "": "type IN ('Retail', 'Wholesale')"}


def _alpha(first_test: str) -> str:
    return f"""alpha AS (
      SELECT owner_id, arg_min(days, (order_date, order_id)) AS first_days, arg_max(days, (order_date, order_id)) AS last_days
      FROM joined WHERE {first_test} AND days >= 0 GROUP BY owner_id)"""


def _bucketed(by: str) -> list[str]:
    measures = []
    for prefix, low, high in cohorts.PERIODS:
        for kind, test in KIND_TESTS.items():
            hit = f"{test} AND {_period_test(low, high)}" if prefix else test
            measures.append(f"""count(CASE WHEN {hit} THEN order_id END) AS x{prefix}_{kind}count,
              sum(CASE WHEN {hit} THEN total END) AS x{prefix}_{kind}total,
              count(DISTINCT CASE WHEN {hit} THEN j.owner_id END) AS x{prefix}_{kind}user_count""")
    keys = f"{by} bucket, bucket_order"
    return [
        f"""bucketed AS (SELECT *, {bucket_case('first_days', fixed.DAY_BUCKETS, 0)} AS bucket,
            {bucket_case('first_days', fixed.DAY_BUCKETS, 1)} AS bucket_order FROM alpha)""",
        f"""sales AS (SELECT {keys}, count(DISTINCT j.owner_id) AS owners, {', '.join(measures)}
            FROM joined j LEFT JOIN bucketed b ON j.owner_id = b.owner_id
            WHERE j.days >= 0 OR j.days IS NULL GROUP BY {keys})""",
    ]


def _if_ratio(test: str, a: str, b: str, name: str) -> str:
    return f"CASE WHEN {test} > 0 THEN round(CAST({a} AS DOUBLE) / CAST(NULLIF({b}, 0) AS DOUBLE), 6) END AS {name}"


def _lifetime_sql() -> str:
    out = [
        "s.bucket AS days_to_order_bucket", "owners AS mp_count",
        "round(owners / CAST(sum(owners) OVER () AS DOUBLE), 6) AS mp_percent_of_total",
        "CAST(sum(owners) OVER (ORDER BY s.bucket_order NULLS FIRST) AS BIGINT) AS mp_running_total",
        "round(CAST(sum(owners) OVER (ORDER BY s.bucket_order NULLS FIRST) AS DOUBLE) / sum(owners) OVER (), 6) AS mp_percent_of_running_total",
        "round(a.f, 6) AS avg_days_to_first_order", "round(a.l, 6) AS avg_days_to_last_order",
    ]
    for kind in KIND_TESTS:
        n, t, u = f"x_{kind}count", f"x_{kind}total", f"x_{kind}user_count"
        out += [
            f"{n} AS {kind}count", _if_ratio(n, n, u, f"avg_{kind}count_user"), f"{t}::DOUBLE AS {kind}total",
            _if_ratio(t, t, n, f"avg_{kind}rev_sale"), _if_ratio(t, t, u, f"avg_{kind}rev_user"),
        ]
    out.append(_if_ratio("sum(x_total) OVER ()", "x_total", "sum(x_total) OVER ()", "percent_of_total"))
    return sql(
        *tb.SALES, JOINED, _alpha("type <> 'Wholesale'"), *_bucketed(""),
        "agg AS (SELECT bucket, avg(first_days) AS f, avg(last_days) AS l FROM bucketed GROUP BY bucket)",
        f"SELECT {', '.join(out)} FROM sales s LEFT JOIN agg a ON s.bucket = a.bucket",
    )


@register("lifetime_value", _lifetime_sql())
def lifetime_value(spark, d):
    return cohorts.lifetime_value(tb.users(spark, d), tb.orders(spark, d))


def _cohort_ctes() -> list[str]:
    by = "PARTITION BY s.year, s.month"
    out = [
        "s.month || '/' || s.year AS cohort", "s.year", "s.month", "s.bucket AS days_to_order_bucket",
        "x_sales_user_count AS mp_count",
        f"round(x_sales_user_count / CAST(NULLIF(sum(x_sales_user_count) OVER ({by}), 0) AS DOUBLE), 6) AS mp_percent_of_total",
        f"CAST(sum(x_sales_user_count) OVER ({by} ORDER BY s.bucket_order NULLS FIRST) AS BIGINT) AS mp_running_total",
        f"""round(CAST(sum(x_sales_user_count) OVER ({by} ORDER BY s.bucket_order NULLS FIRST) AS DOUBLE)
            / NULLIF(sum(x_sales_user_count) OVER ({by}), 0), 6) AS mp_percent_of_running_total""",
        "min_days_to_first_order", "max_days_to_first_order", "round(avg_f, 6) AS avg_days_to_first_order",
        "min_days_to_last_order", "max_days_to_last_order", "round(avg_l, 6) AS avg_days_to_last_order",
    ]
    for prefix, _, _ in cohorts.PERIODS:
        p = f"{prefix}_" if prefix else ""
        for kind in ("sales_", "wholesale_"):
            n, t, u = f"x{prefix}_{kind}count", f"x{prefix}_{kind}total", f"x{prefix}_{kind}user_count"
            rev = "avg_sales_rev_user" if kind == "sales_" else ("wholesale_rev_user" if prefix else "avg_wholesale_rev_user")
            out += [
                f'{n} AS "{p}{kind}count"', _if_ratio(n, n, u, f'"{p}avg_{kind}count_user"'),
                f'{t}::DOUBLE AS "{p}{kind}total"', _if_ratio(t, t, n, f'"{p}avg_{kind}rev_sale"'),
                _if_ratio(t, t, u, f'"{p}{rev}"'),
            ]
            if prefix == "_30":
                out += [
                    _if_ratio(f"x_{kind}count", n, f"x_{kind}count", f'"{p}{kind}count_percent"'),
                    _if_ratio(f"x_{kind}total", t, f"x_{kind}total", f'"{p}{kind}total_percent"'),
                ]
        n, t, u = f"x{prefix}_count", f"x{prefix}_total", f"x{prefix}_user_count"
        month = f"sum({t}) OVER ({by})"
        out += [
            f'{n} AS "{p}count"', _if_ratio(n, n, u, f'"{p}avg_count_user"'), f'{t}::DOUBLE AS "{p}total"',
            _if_ratio(t, t, n, f'"{p}avg_rev_sale"'), _if_ratio(t, t, u, f'"{p}avg_rev_user"'),
            _if_ratio(month, t, month, f'"{p}percent_of_month_total"'),
        ]
        if prefix:
            out += [
                _if_ratio("x_count", n, "x_count", f'"{p}percent_of_total_count"'),
                _if_ratio("x_total", t, "x_total", f'"{p}percent_of_total_rev"'),
            ]
    return [
        *tb.SALES, JOINED, _alpha("type = 'Retail'"), *_bucketed("year, month,"),
        """agg AS (SELECT strftime(u.created, '%Y') AS year, strftime(u.created, '%m') AS month, bucket,
             min(first_days) AS min_days_to_first_order, max(first_days) AS max_days_to_first_order, avg(first_days) AS avg_f,
             min(last_days) AS min_days_to_last_order, max(last_days) AS max_days_to_last_order, avg(last_days) AS avg_l
           FROM bucketed b JOIN users u ON b.owner_id = u.tree_user_id GROUP BY ALL)""",
        f"""cohorts AS (SELECT {', '.join(out)} FROM sales s
            LEFT JOIN agg a ON s.year = a.year AND s.month = a.month AND s.bucket = a.bucket)""",
    ]


@register("year_cohort_value", sql(*_cohort_ctes(), "SELECT * FROM cohorts"))
def year_cohort_value(spark, d):
    return cohorts.year_cohort_value(tb.users(spark, d), tb.orders(spark, d))


def _uplift_sql() -> str:
    out, gains = ["cohort", "days_to_order_bucket", "mp_count"], []
    for p in cohorts.UPLIFT_PERIODS:
        parts = {k: f'"{p}_avg_{k}_count_user" * 0.02::DOUBLE * "{p}_avg_{k}_rev_sale" * mp_count' for k in ("sales", "wholesale")}
        gain = f"(coalesce({parts['sales']}, 0) + coalesce({parts['wholesale']}, 0))"
        gains.append(gain)
        out += [
            *[f'"{p}_avg_{k}_{w}"' for k in parts for w in ("count_user", "rev_sale")], f'"{p}_total"',
            *[f'round({v}, 4) AS "{p}_{k}_rev_increase"' for k, v in parts.items()],
            f'round({gain}, 4) AS "{p}_total_rev_increase"', f'round(sum({gain}) OVER (), 4) AS "{p}_agg_rev_increase"',
        ]
    out += ["CAST(sum(total::DECIMAL(28,2)) OVER () AS DOUBLE) AS agg_rev_total",
            f"round(sum({' + '.join(gains)}) OVER (), 4) AS agg_rev_increase"]
    return sql(*_cohort_ctes(), f"SELECT {', '.join(out)} FROM cohorts")


@register("uplift_whatif", _uplift_sql())
def uplift_whatif(spark, d):
    return cohorts.uplift(cohorts.year_cohort_value(tb.users(spark, d), tb.orders(spark, d)))


# --- order mix and products ------------------------------------------------------------------


@register("order_mix", sql(*tb.SALES, """mix AS (SELECT b.type AS user_type, o.type AS order_type, o.is_autoship, count(DISTINCT o.order_id) AS count
    FROM sales_orders o JOIN users w ON o.commission_user_id = w.tree_user_id AND w.type = 'Distributor'
    JOIN users b ON o.tree_user_id = b.tree_user_id
    WHERE o.type IN ('Retail', 'Wholesale') AND o.status <> 'Cancelled' GROUP BY ALL)""",
  """SELECT user_type, order_type, is_autoship, count,
  CAST(sum(count) OVER (PARTITION BY user_type, order_type) AS BIGINT) AS count_over_types,
  round(100.0::DOUBLE * (count::DOUBLE / sum(count) OVER (PARTITION BY user_type, order_type)), 2) AS per_over_types,
  CAST(sum(count) OVER (PARTITION BY user_type) AS BIGINT) AS count_over_user_type,
  round(100.0::DOUBLE * (count::DOUBLE / sum(count) OVER (PARTITION BY user_type)), 2) AS per_over_user_type,
  CAST(sum(count) OVER () AS BIGINT) AS count_over_all,
  round(100.0::DOUBLE * (count::DOUBLE / sum(count) OVER ()), 2) AS per_over_all FROM mix"""))
def order_mix(spark, d):
    return cohorts.order_mix(tb.users(spark, d), tb.orders(spark, d))


CLASSIFIED = f"""classified AS (
  SELECT o.client_partition_id, o.tree_user_id, o.order_id, l.price_total AS total,
    {like_case('lower(product_description)', fixed.PRODUCT_TYPE_PATTERNS, 'product_description')} AS product_type,
    {like_case('lower(product_description)', fixed.MEMBERSHIP_PATTERNS, "'none'")} AS membership_type
  FROM sales_orders o JOIN lines l ON o.order_id = l.order_id WHERE o.status = 'Active')"""


def recruiters(spark, d):
    """Users of the product reports: employees are left out."""
    return tb.users(spark, d).filter(F.col("client_type") != "Employee")


RECRUITERS = "people AS (SELECT *, CAST(coded AS DATE) AS day FROM users WHERE client_type <> 'Employee')"


@register("subscription_by_class", sql(*tb.SALES, *tb.LINE_CTES, CLASSIFIED, RECRUITERS, """SELECT membership_type, count(*) AS cnt,
  count(DISTINCT c.tree_user_id) AS distinct_users, sum(total)::DOUBLE AS total,
  round(sum(total)::DOUBLE / count(DISTINCT c.tree_user_id), 6) AS avg_tot_per_user
  FROM classified c JOIN people p ON c.tree_user_id = p.tree_user_id AND c.client_partition_id = p.client_partition_id
  WHERE product_type = 'subscription' GROUP BY membership_type"""))
def subscription_by_class(spark, d):
    return downline.subscription_by_class(recruiters(spark, d), tb.nested_orders(spark, d))


def _downline_value_sql() -> str:
    tests = {}
    for prefix, member in (("vaca", "membership_type <> 'rep'"), ("rep", "membership_type = 'rep'")):
        for name, kind in (("fees", "fee"), ("discounts", "discount"), ("subs", "subscription")):
            tests[f"{prefix}_{name}"] = f"product_type = '{kind}' AND {member}"
    tests["event"] = "product_type = 'event'"
    tests["product"] = "product_type = 'product'"
    inner = ", ".join(f"count(*) FILTER ({t}) AS {n}_cnt, sum(CASE WHEN {t} THEN total ELSE 0 END) AS {n}_tot" for n, t in tests.items())
    outer = []
    for n in tests:
        outer += [f"CAST(sum(coalesce({n}_cnt, 0)) AS BIGINT) AS {n}_cnt", f"sum(coalesce({n}_tot, 0))::DOUBLE AS {n}_tot"]
        if n.endswith("subs"):
            outer += [f"round(sum(coalesce({n}_cnt, 0))::DOUBLE / count(*), 6) AS {n}_cnt_per_user",
                      f"round(sum(coalesce({n}_tot, 0))::DOUBLE / count(*), 6) AS {n}_tot_per_user"]
    diff = "date_diff('day', p.day, c.day)"
    return sql(
        *tb.SALES, *tb.LINE_CTES, CLASSIFIED, RECRUITERS,
        f"""sponsored AS (SELECT p.tree_user_id, min({diff}) AS first_days, count(*) AS cnt, count(*) FILTER ({diff} BETWEEN 0 AND 30) AS first_30_cnt,
              avg({diff}) AS avg_days, max({diff}) AS max_days
            FROM people p JOIN people c ON p.tree_user_id = c.sponsor_id WHERE {diff} > 0 GROUP BY p.tree_user_id)""",
        f"aggs AS (SELECT tree_user_id, {inner}, sum(total) AS tot FROM classified GROUP BY tree_user_id)",
        f"""SELECT {bucket_case('first_days', fixed.FINE_DAY_BUCKETS, 0)} AS bucket, count(*) AS cnt,
              CAST(sum(s.cnt) AS BIGINT) AS sponsored_cnt, CAST(sum(first_30_cnt) AS BIGINT) AS sponsored_first_30_cnt,
              round(avg(avg_days), 6) AS avg_days_to_signup, round(avg(first_days), 6) AS avg_min_days_to_signup,
              round(avg(max_days), 6) AS avg_max_days_to_signup, round(avg(max_days - first_days), 6) AS avg_days_active,
              {', '.join(outer)}, sum(coalesce(tot, 0))::DOUBLE AS tot, round(sum(coalesce(tot, 0))::DOUBLE / count(*), 6) AS avg_rev_per_user
            FROM people u LEFT JOIN sponsored s ON u.tree_user_id = s.tree_user_id LEFT JOIN aggs a ON u.tree_user_id = a.tree_user_id
            WHERE u.type = 'Distributor' GROUP BY 1""",
    )


@register("downline_value", _downline_value_sql())
def downline_value(spark, d):
    return downline.downline_value(recruiters(spark, d), tb.nested_orders(spark, d))


# --- usage -----------------------------------------------------------------------------------

# Logins and messages of the events table happen in 2024; moved back by 29 years they fall among
# the orders of the first years.
SHIFT_YEARS = 29


def usage_logins(spark, d):
    at = F.col("ts") - F.expr(f"INTERVAL {SHIFT_YEARS} YEARS")
    return table(spark, d, "events").select(
        (F.col("user_id") % 5).alias("client_partition_id"), F.col("user_id").alias("tree_user_id"), F.col("event_id").alias("login_id"), at.alias("created_at"),
        rules.by_lookup(F.col("event_type"), tb.EVENT_PLATFORMS).alias("platform"),
    )


def usage_emails(spark, d):
    """Each order is a message of its buyer, each of its lines a recipient."""
    lines = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("message_id"),
        F.col("l_suppkey").alias("tree_user_id"),
        F.when(F.col("l_returnflag") != "N", F.col("l_shipdate")).alias("seen"),
        F.when(F.col("l_returnflag") == "A", F.col("l_shipdate")).alias("read"),
        F.when(F.col("l_linestatus") == "O", 1).alias("undeliverable"),
    )
    # recipients of a message beyond the slice limit come as further rows; the features unnest all
    fields = ["tree_user_id", "seen", "read", "undeliverable"]
    nested = nest(lines, ["message_id"], fields, "recipients").drop("slice")
    o = table(spark, d, "orders")
    return o.join(nested, o.o_orderkey == F.col("message_id")).select(
        (F.col("o_custkey") % 5).alias("client_partition_id"), F.col("o_custkey").alias("sender_tree_user_id"), "message_id", F.col("o_orderstatus").alias("delivery_status"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("sent"), F.col("o_orderdate").alias("created"),
        F.col("o_orderpriority").alias("system_generated"), "recipients",
    )


def _usage_sql() -> str:
    kinds = {"retail": "type = 'Retail'", "wholesale": "type = 'Wholesale' AND owner_id = buyer_id",
             "autoship": "type = 'Wholesale' AND owner_id <> buyer_id"}
    spans = {"first30_": "days BETWEEN 0 AND 30",
             "last12_": f"date_diff('month', CAST(order_date AS DATE), DATE '{tb.AS_OF[:10]}') BETWEEN 0 AND 12", "": "true"}
    metrics = []
    for k, own in kinds.items():
        for s, span in spans.items():
            metrics += [f"count(*) FILTER ({own} AND {span}) AS count_{s}{k}",
                        f"sum(CASE WHEN {own} AND {span} THEN total ELSE 0 END)::DOUBLE AS total_{s}{k}"]
        metrics += [f"min(order_date) FILTER ({own}) AS f_{k}", f"max(order_date) FILTER ({own}) AS l_{k}"]
    day = lambda a, b: f"date_diff('day', CAST({a} AS DATE), CAST({b} AS DATE))"
    before = lambda at, k: f"CAST({at} AS DATE) >= u.signup AND {at} <= u.f_{k}"
    first30 = f"{day('u.signup', 'e.created')} BETWEEN 0 AND 30"
    mails = [f"{day('u.signup', f'min(e.{c})')} AS days_to_first_{n}"
             for n, c in (("created", "created"), ("sent", "sent"), ("seen", "min_seen"), ("read", "min_read"))]
    mails += [f"count(*) FILTER ({first30}) AS cnt_created_first30",
              f"count(*) FILTER ({day('u.signup', 'e.sent')} BETWEEN 0 AND 30) AS cnt_sent_first30"]
    mails += [f"CAST(sum(CASE WHEN {first30} THEN e.{n}_cnt ELSE 0 END) AS BIGINT) AS cnt_{n}_first30" for n in ("seen", "read", "undeliverable")]
    for k in kinds:
        mails += [f"count(*) FILTER ({before('e.created', k)}) AS cnt_created_before_first_{k}",
                  f"count(*) FILTER ({before('e.sent', k)}) AS cnt_sent_before_first_{k}"]
        mails += [f"CAST(sum(CASE WHEN {before(at, k)} THEN e.{n}_cnt ELSE 0 END) AS BIGINT) AS cnt_{n}_before_first_{k}"
                  for n, at in (("seen", "e.min_seen"), ("read", "e.min_read"), ("undeliverable", "e.sent"))]
    clicks = []
    for cls in fixed.PLATFORM_CLASSES:
        clicks.append(f"count(*) FILTER (cls = '{cls}' AND {day('u.signup', 'lh.at_time')} BETWEEN 0 AND 30) AS logins_first30_{cls}")
        clicks += [f"count(*) FILTER (cls = '{cls}' AND lh.at_time BETWEEN CAST(u.signup AS TIMESTAMP) AND u.f_{k}) AS logins_before_first_{k}_{cls}" for k in kinds]
    outer = [f"count_{s}{k}, total_{s}{k}" for k in kinds for s in spans]
    outer.append(f"{day('om.signup', chr(39) + tb.AS_OF[:10] + chr(39))} AS days_since_signup")
    for k in kinds:
        outer += [f"{day('om.signup', f'f_{k}')} AS days_to_first_{k}", f"{day('om.signup', f'l_{k}')} AS days_to_last_{k}",
                  f"{day(f'f_{k}', f'l_{k}')} AS days_active_{k}"]
    platform = f"""CASE WHEN platform IS NULL THEN 'unknown' ELSE {like_case('platform', fixed.PLATFORM_PATTERNS, "'other'")} END"""
    return sql(
        *tb.SALES, JOINED,
        f"om AS (SELECT owner_id, signup, {', '.join(metrics)} FROM joined WHERE days >= 0 AND type IN ('Retail', 'Wholesale') GROUP BY owner_id, signup)",
        """sent_mail AS (SELECT o_custkey AS sender, o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS sent, o_orderdate AS created,
             min(l_shipdate) FILTER (l_returnflag <> 'N') AS min_seen, min(l_shipdate) FILTER (l_returnflag = 'A') AS min_read,
             count(DISTINCT l_suppkey) FILTER (l_returnflag <> 'N') AS seen_cnt, count(DISTINCT l_suppkey) FILTER (l_returnflag = 'A') AS read_cnt,
             count(DISTINCT l_suppkey) FILTER (l_linestatus = 'O') AS undeliverable_cnt
           FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)""",
        """known AS (SELECT p.tree_user_id AS owner_id, CAST(p.created AS DATE) AS signup, om.f_retail, om.f_wholesale, om.f_autoship
           FROM users p LEFT JOIN om ON p.tree_user_id = om.owner_id WHERE p.type = 'Distributor')""",
        f"""sea AS (SELECT u.owner_id, {', '.join(mails)} FROM known u JOIN sent_mail e ON u.owner_id = e.sender
            WHERE CAST(e.created AS DATE) >= u.signup GROUP BY u.owner_id, u.signup)""",
        f"""logins AS (SELECT user_id, at_time, {platform} AS cls FROM (
             SELECT user_id, ts - INTERVAL {SHIFT_YEARS} YEAR AS at_time, {EVENT_PLATFORM_SQL} AS platform FROM events))""",
        f"""clicks AS (SELECT u.owner_id, {', '.join(clicks)} FROM logins lh JOIN known u ON lh.user_id = u.owner_id
            WHERE u.owner_id IN (SELECT owner_id FROM om) GROUP BY u.owner_id)""",
        f"""SELECT om.owner_id % 5 AS client_partition_id, om.owner_id AS commission_user_id, {', '.join(outer)}, sea.* EXCLUDE (owner_id), clicks.* EXCLUDE (owner_id)
            FROM om LEFT JOIN sea ON om.owner_id = sea.owner_id LEFT JOIN clicks ON om.owner_id = clicks.owner_id""",
    )


@register("usage_features", _usage_sql())
def usage_features(spark, d):
    people = tb.users(spark, d).filter(F.col("type") == "Distributor").select(
        "client_partition_id", F.col("tree_user_id").alias("owner_id"), F.to_date("created").alias("signup")
    )
    return usage.usage_features(people, tb.orders(spark, d), usage_emails(spark, d), usage_logins(spark, d), ts(tb.AS_OF))


@register("distinct_sketches", """SELECT o_orderpriority, year(o_orderdate) AS year, count(DISTINCT o_custkey) AS buyers, true AS close
  FROM orders GROUP BY ALL""")
def distinct_sketches(spark, d):
    """Distinct buyers a year, exact and from stored sketches of days: the estimate has to be close."""
    orders = table(spark, d, "orders").select("o_orderpriority", F.to_date("o_orderdate").alias("day"), "o_custkey")
    stored = written(sketches.distinct_sketches(orders, ["o_orderpriority", "day"], "o_custkey"), work_folder(spark))
    keys = ["o_orderpriority", "year"]
    of_year = sketches.merged_estimate(stored.withColumn("year", F.year("day")), keys, out="estimate")
    exact = orders.withColumn("year", F.year("day")).groupBy(*keys).agg(F.count_distinct("o_custkey").alias("buyers"))
    close = F.abs(F.col("estimate") - F.col("buyers")) <= 0.08 * F.col("buyers") + 1
    return exact.join(of_year, keys).select(*keys, "buyers", close.alias("close"))


def _order_states(spark, d):
    """The orders as three windows leave them: a third is wrong at first, a third not there yet, the rest final."""
    final, key = tb.orders(spark, d), F.col("order_id")
    wrong = final.filter(key % 3 == 0).withColumns({
        "commission_user_id": F.col("tree_user_id"), "total": (F.col("total") + 10).cast("decimal(18,2)"), "type": F.lit("Wholesale"),
        "order_date": F.expr("order_date - INTERVAL 40 DAYS"), "status": F.when(key % 2 == 0, "Cancelled").otherwise(F.col("status"))})
    return wrong, final.filter(key % 3 == 0), final.filter(key % 3 == 1), final.filter(key % 3 == 2)


def _followed_days(spark, d):
    """Stored days after a first load and two windows of changed and new orders."""
    folder = work_folder(spark)
    wrong, right, steady, late = _order_states(spark, d)
    rollup.create_days(wrong.unionByName(steady), f"{folder}/days")
    for _ in range(2):  # a refresh that is repeated changes nothing
        rollup.refresh_days(spark, f"{folder}/days", wrong, right, f"{folder}/first", 1)
    rollup.refresh_days(spark, f"{folder}/days", late.filter("false"), late, f"{folder}/second", 2)
    return rollup.stored_days(spark, f"{folder}/days")


@register("lifetime_value_followed", QUERIES["lifetime_value"][1])
def lifetime_value_followed(spark, d):
    return cohorts.lifetime_value(tb.users(spark, d), None, days=_followed_days(spark, d))


@register("year_cohort_value_followed", QUERIES["year_cohort_value"][1])
def year_cohort_value_followed(spark, d):
    return cohorts.year_cohort_value(tb.users(spark, d), None, days=_followed_days(spark, d))
