"""Usage and outcome features per user: orders, sent messages, logins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.functions import fixed
from weirflow.functions.dates import days_between, months_between_boundaries
from weirflow.functions.rules import platform_class
from weirflow.lineage import cut_lineage
from weirflow.operators.nesting import unnest
from weirflow.operators.skew import fold_slices, join_sliced

OWNER = ["client_partition_id", "owner_id"]  # ids are unique within a client only
KINDS = ["retail", "wholesale", "autoship"]


def _kind() -> Column:
    """Retail; wholesale bought by the owner itself; wholesale of others counts as autoship."""
    own = F.col("commission_user_id") == F.col("tree_user_id")
    return (
        F.when(F.col("type") == "Retail", "retail")
        .when((F.col("type") == "Wholesale") & own, "wholesale")
        .when((F.col("type") == "Wholesale") & ~own, "autoship")
    )


def order_features(people: DataFrame, orders: DataFrame, as_of: Column, legacy: bool = False) -> DataFrame:
    """Per owner and kind: count and value in the first 30 days, the last 12 months and ever;
    first and last order.  Owners without an order after signing up are left out.

    ``legacy`` fills the last order of a kind only where the owner's very last order is of it.
    """
    kept = orders.filter(F.col("type").isin("Retail", "Wholesale") & (F.col("status") != "Cancelled"))
    daily = kept.groupBy(
        "client_partition_id", F.col("commission_user_id").alias("owner_id"), _kind().alias("kind"),
        F.to_date("order_date").alias("day"),
    ).agg(
        F.count(F.lit(1)).alias("n"), F.sum("total").alias("total"),
        F.min("order_date").alias("first_at"), F.max("order_date").alias("last_at"),
    )
    rows = daily.join(people.select(*OWNER, "signup"), OWNER).withColumn(
        "days", days_between(F.col("signup"), F.col("day"))
    ).filter(F.col("days") >= 0)
    recent = months_between_boundaries(F.col("day"), as_of).between(0, 12)
    spans = {"first30": F.col("days").between(0, 30), "last12": recent, "": F.lit(True)}
    measures = [F.max("last_at").alias("_last_any")]
    for kind in KINDS:
        of_kind = F.col("kind") == kind
        for span, inside in spans.items():
            name = f"{span}_{kind}" if span else kind
            hit = of_kind & inside
            measures += [
                F.sum(F.when(hit, F.col("n")).otherwise(0)).alias(f"count_{name}"),
                F.sum(F.when(hit, F.col("total")).otherwise(0)).alias(f"total_{name}"),
            ]
        measures += [
            F.min(F.when(of_kind, F.col("first_at"))).alias(f"first_{kind}"),
            F.max(F.when(of_kind, F.col("last_at"))).alias(f"last_{kind}"),
        ]
    out = rows.groupBy(*OWNER, "signup").agg(*measures)
    if legacy:
        out = out.withColumns(
            {f"last_{k}": F.when(F.col(f"last_{k}") == F.col("_last_any"), F.col(f"last_{k}")) for k in KINDS}
        )
    spans_of = {"days_since_signup": days_between(F.col("signup"), as_of)}
    for kind in KINDS:
        first, last = F.col(f"first_{kind}"), F.col(f"last_{kind}")
        spans_of[f"days_to_first_{kind}"] = days_between(F.col("signup"), first)
        spans_of[f"days_to_last_{kind}"] = days_between(F.col("signup"), last)
        spans_of[f"days_active_{kind}"] = days_between(first, last)
    return out.withColumns(spans_of).drop("_last_any")


def sent_messages(emails: DataFrame) -> DataFrame:
    """One row per message: distinct recipients, and how many of them saw or read it.

    Recipients are reduced to one row each first, so the counts need no distinct aggregate.
    """
    keys = ["client_partition_id", "sender_tree_user_id", "message_id", "delivery_status", "sent", "created", "system_generated"]
    per_recipient = (
        unnest(emails, "recipients", keys)
        .groupBy(*keys, "tree_user_id")
        .agg(F.min("seen").alias("seen"), F.min("read").alias("read"), F.count("undeliverable").alias("bad"))
    )
    known = F.col("tree_user_id").isNotNull()
    return per_recipient.groupBy(*keys).agg(
        F.count("tree_user_id").alias("recipients"),
        F.min("seen").alias("min_seen"),
        F.count_if(known & F.col("seen").isNotNull()).alias("seen_cnt"),
        F.min("read").alias("min_read"),
        F.count_if(known & F.col("read").isNotNull()).alias("read_cnt"),
        F.count_if(known & (F.col("bad") > 0)).alias("undeliverable_cnt"),
    )


def _within30(at: str) -> str:
    return f"datediff(CAST({at} AS DATE), signup) BETWEEN 0 AND 30"


def message_features(people: DataFrame, emails: DataFrame) -> DataFrame:
    """Message counts per sender; ``people`` holds sign-up and first orders, one row each.

    Joined and grouped by the sender, so hot senders are sliced; they are counted in the
    messages before their recipients are unnested.
    """
    side = people.withColumnRenamed("owner_id", "sender_tree_user_id")
    sender = ["client_partition_id", "sender_tree_user_id"]
    rows = join_sliced(
        sent_messages(emails), side, sender, ["message_id"], counted=emails.select(*sender)
    ).filter(
        F.to_date("created") >= F.col("signup")
    )
    weights = {"seen": "seen_cnt", "read": "read_cnt", "undeliverable": "undeliverable_cnt"}
    clock = {"created": "created", "sent": "sent", "seen": "min_seen", "read": "min_read", "undeliverable": "sent"}
    measures = {f"_{e}": ("min", f"CAST({clock[e]} AS DATE)") for e in ("created", "sent", "seen", "read")}
    measures["_signup"] = ("min", "signup")
    for event, at in clock.items():
        how = "sum" if event in weights else "count"
        hit = f"{weights[event]} ELSE 0" if event in weights else "1"
        # what happened to a message counts for the message's own first 30 days
        start = at if event == "sent" else "created"
        measures[f"cnt_{event}_first30"] = (how, f"CASE WHEN {_within30(start)} THEN {hit} END")
        for kind in KINDS:
            before = f"CAST({at} AS DATE) >= signup AND {at} <= first_{kind}"
            measures[f"cnt_{event}_before_first_{kind}"] = (how, f"CASE WHEN {before} THEN {hit} END")
    out = fold_slices(rows, sender, measures)
    spans = {
        f"days_to_first_{event}": days_between(F.col("_signup"), F.col(f"_{event}"))
        for event in ("created", "sent", "seen", "read")
    }
    return out.withColumns(spans).drop("_created", "_sent", "_seen", "_read", "_signup")


def login_features(people: DataFrame, logins: DataFrame) -> DataFrame:
    """Logins per user by platform class, in the first 30 days and before each first order."""
    user = ["client_partition_id", "tree_user_id"]
    keyed = logins.select(*user, "login_id", "created_at", platform_class(F.col("platform")).alias("cls"))
    side = people.select(
        "client_partition_id", F.col("owner_id").alias("tree_user_id"), "signup", *[f"first_{k}" for k in KINDS]
    )
    rows = join_sliced(keyed, side, user, ["login_id"], counted=logins.select(*user))
    spans = {"first30": _within30("created_at")}
    for kind in KINDS:
        spans[f"before_first_{kind}"] = f"created_at BETWEEN CAST(signup AS TIMESTAMP_NTZ) AND first_{kind}"
    measures = {
        f"logins_{span}_{cls}": ("count", f"CASE WHEN cls = '{cls}' AND {inside} THEN 1 END")
        for span, inside in spans.items()
        for cls in fixed.PLATFORM_CLASSES
    }
    return fold_slices(rows, user, measures)


def usage_features(
    people: DataFrame, orders: DataFrame, emails: DataFrame, logins: DataFrame, as_of: Column,
    legacy: bool = False,
) -> DataFrame:
    """All features per owner with at least one order.  ``people``: client, owner_id, signup (a date)."""
    # one row per owner, used by all three parts: computed once
    base = cut_lineage(order_features(people, orders, as_of, legacy))
    firsts = [f"first_{k}" for k in KINDS]
    known = people.select(*OWNER, "signup").join(base.select(*OWNER, *firsts), OWNER, "left")
    mails = message_features(known, emails).withColumnRenamed("sender_tree_user_id", "owner_id")
    # logins count only for owners with an order, as their windows end at a first order
    clicks = login_features(base, logins).withColumnRenamed("tree_user_id", "owner_id")
    hidden = ["signup", *[f"{edge}_{k}" for edge in ("first", "last") for k in KINDS]]
    return (
        base.drop(*hidden)
        .join(mails, OWNER, "left")
        .join(clicks, OWNER, "left")
        .withColumnRenamed("owner_id", "commission_user_id")
    )
