"""Flat and nested marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.functions.dates import whole_units
from weirflow.functions.rules import is_autoship, without_test_titles
from weirflow.operators.joins import polymorphic_lookup
from weirflow.operators.nesting import ARRAY_LIMIT, nest, nest_many, parent_and_rest

Lookups = Mapping[str, tuple[DataFrame, str, str]]


def users_mart(users: DataFrame, accounts: DataFrame, types: DataFrame, statuses: DataFrame, as_of: Column) -> DataFrame:
    """Users with type and status names, their login account where there is one, and age."""
    return (
        users.join(accounts.select("tree_user_id", "user_id"), "tree_user_id", "left")
        .join(types.select("type_id", F.col("description").alias("type")), "type_id")
        .join(statuses.select("status_id", F.col("description").alias("status")), "status_id")
        .withColumn("age", whole_units("YEAR", F.col("birth_date").cast("timestamp_ntz"), as_of))
        .drop("type_id", "status_id")
    )


def commissions_mart(users: DataFrame, commissions: DataFrame, runs: DataFrame, periods: DataFrame,
                     period_types: DataFrame) -> DataFrame:
    """Commissions with their run, period and period type."""
    return (
        commissions.join(users.select("tree_user_id"), "tree_user_id", "left_semi")
        .join(runs, "run_id")
        .join(periods, "period_id")
        .join(period_types, "period_type_id")
        .select("tree_user_id", "run_id", "run_date", "period_id", "period_type_id", "period",
                "period_type", "currency_code", "earnings")
    )


def order_lines_mart(orders: DataFrame, items: DataFrame, types: DataFrame, statuses: DataFrame) -> DataFrame:
    """One row per order line with type and status names and the autoship flag."""
    return (
        orders.join(types.select("type_id", F.col("description").alias("type")), "type_id")
        .join(statuses.select("status_id", F.col("description").alias("status")), "status_id")
        .withColumn("is_autoship", is_autoship(F.col("autoship_template_id")).cast("long"))
        .join(items, "order_id")
        .drop("type_id", "status_id", "autoship_template_id")
    )


def site_visitors_mart(sites: DataFrame, visitors: DataFrame, accounts: DataFrame, tracking: DataFrame) -> DataFrame:
    """Sites with visitors, owner and tracking codes; sites without visitors are kept."""
    return (
        sites.select("site_id", F.col("user_id").cast("long").alias("user_id"))
        .join(visitors, "site_id", "left")
        .join(accounts.select("user_id", "tree_user_id"), "user_id")
        .join(tracking.select("user_id", "third_party_tracking_company", "tracking_code"), "user_id", "left")
    )


def logins_mart(accounts: DataFrame, logins: DataFrame) -> DataFrame:
    """Logins of known users, without those made on somebody's behalf."""
    own = logins.filter(F.col("proxied_by_id").isNull()).drop("proxied_by_id")
    return own.join(accounts.select("user_id", "tree_user_id"), "user_id")


def reviews_mart(reviews: DataFrame, accounts: DataFrame, products: DataFrame, variants: DataFrame) -> DataFrame:
    """Reviews with product and reviewer; a product with several variants repeats its reviews."""
    return (
        reviews.join(accounts.select("user_id", "tree_user_id"), "user_id")
        .join(products, "product_id")
        .join(variants.select("product_id", F.col("sku").alias("product_code")), "product_id")
        .drop("product_id")
    )


def tasks_mart(tasks: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """Tasks that are no tests, with a flag for system tasks, and their user's tree id."""
    out = without_test_titles(tasks, "task_title").withColumn(
        "from_system", F.when(F.col("source") == "system", 1).otherwise(0).cast("long")
    ).drop("source")
    return out if accounts is None else out.join(accounts.select("user_id", "tree_user_id"), "user_id")


# --- messages and links ----------------------------------------------------------------------


def flat_emails(messages: DataFrame, recipients: DataFrame, senders: Lookups, receivers: Lookups) -> DataFrame:
    """One row per message and recipient with both tree users."""
    mailed = recipients.filter(F.col("delivery_type") == "email").drop("delivery_type")
    found = polymorphic_lookup(mailed, "recipient_type", "recipient_id", receivers, "recipient_tree_user_id")
    sent = polymorphic_lookup(messages, "sender_type", "sender_id", senders, "sender_tree_user_id")
    return sent.join(found, "message_id")


RECIPIENT_FIELDS = ("tree_user_id", "recipient_id", "recipient_type", "seen", "read", "undeliverable")


def nested_emails(
    messages: DataFrame, recipients: DataFrame, senders: Lookups, receivers: Lookups,
    fields=RECIPIENT_FIELDS, limit: int = ARRAY_LIMIT,
) -> tuple[DataFrame, DataFrame]:
    """Messages with their e-mail recipients as an array, null where they have none: two tables.

    The first has one row per message with its first ``limit`` recipients in the array's order; the second,
    (message_id, slice, recipients), goes on from slice 1 for messages with more.  Recipients are
    resolved and nested before they meet the messages, so message bodies are never repeated.
    """
    mailed = recipients.filter(F.col("delivery_type") == "email")
    found = polymorphic_lookup(mailed, "recipient_type", "recipient_id", receivers, "tree_user_id")
    nested = nest(found, ["message_id"], list(fields), "recipients", limit, counted=mailed)
    first, rest = parent_and_rest(nested, ["message_id"], "recipients")
    sent = polymorphic_lookup(messages, "sender_type", "sender_id", senders, "sender_tree_user_id")
    return sent.join(first, "message_id", "left"), rest.join(messages.select("message_id"), "message_id", "left_semi")


def links_mart(links: DataFrame, assets: DataFrame, resources: DataFrame, users: DataFrame) -> DataFrame:
    """Links of known users with the shared asset and its resource as nested structs.

    Only the asset type carries columns into the mart; the other types keep their ids.
    """
    shared = assets.join(resources.select("resource_id", F.struct(*resources.columns).alias("resource")), "resource_id", "left")
    flags = [c for c in ("can_email", "allow_download") if c in assets.columns]
    shared = shared.withColumns({c: F.col(c).cast("boolean") for c in flags})
    detail = [c for c in assets.columns if c not in ("asset_id", "resource_id")]
    asset = shared.select(
        "asset_id", F.lit("asset").alias("asset_type"), F.struct("resource", *detail).alias("resource_asset")
    )
    return (
        links.join(users.select(F.col("user_id").alias("link_sharer_id")), "link_sharer_id", "left_semi")
        .join(asset, ["asset_type", "asset_id"], "left")
    )


def nested_commissions(commissions: DataFrame, details: DataFrame, bonuses: DataFrame, runs: DataFrame,
                       limit: int = ARRAY_LIMIT) -> DataFrame:
    """Four arrays per client, user and slice; slice 0 has the first ``limit`` elements of each."""
    keys = ["client_partition_id", "client", "tree_user_id", "client_user_id"]
    parts = {"commissions": commissions, "details": details, "bonuses": bonuses, "runs": runs}
    fields = {n: [c for c in f.columns if c not in keys] for n, f in parts.items()}
    return nest_many({n: (f, fields[n]) for n, f in parts.items()}, keys, limit)
