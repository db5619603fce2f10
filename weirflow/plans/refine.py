"""From the append-only lake to clean staging tables, one ingestion window at a time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weirflow.functions import rules
from weirflow.functions.codecs import compress_long
from weirflow.functions.conform import stamp, stringify_dates, stringify_decimals, zero_dates_to_null
from weirflow.functions.dates import ts
from weirflow.lineage import work_folder, written
from weirflow.operators.increments import all_versions_of, changed_keys, in_window
from weirflow.operators.joins import with_client, with_lookup
from weirflow.operators.nesting import ARRAY_LIMIT, nest, parent_and_rest
from weirflow.operators.versions import newest

VERSION = ["event_eid", "ingestion_timestamp"]
NAMED = ["client", "id"]
CLIENT_COLUMNS = ["client", "client_partition_id", "client_score_id"]


def people(log: DataFrame, clients: DataFrame, first, last, batch_time, closed: str = "half_open") -> DataFrame:
    """Contacts: the newest version inside the window, with the client's partition."""
    seen = in_window(log, first, last, closed=closed)
    latest = newest(seen, NAMED, ["ingestion_timestamp"])
    partition = clients.select("client", "client_partition_id")
    return stamp(with_client(latest, partition), ingestion_timestamp=ts(batch_time))


def leads(log: DataFrame, clients: DataFrame, first, last, batch_time, closed: str = "half_open") -> DataFrame:
    """As ``people``, without purchased leads.  The test runs on the newest version: a lead
    bought in the meantime must go, whatever its older versions say."""
    out = people(log, clients, first, last, batch_time, closed).filter(~F.col("purchased"))
    return out.withColumnsRenamed({"id": "lead_id", "created_at": "created", "updated_at": "modified"})


PII_COLUMNS = ["first_name", "last_name", "company_name"]
PII_CONTACT = ["city", "state", "country", "email", "phone", "mobile_phone"]


def pii_users(log: DataFrame, clients: DataFrame, first, last, batch_time, closed: str = "half_open") -> DataFrame:
    """Personal data of users: street from two lines, gender folded, incomplete users dropped."""
    latest = newest(in_window(log, first, last, closed=closed), NAMED, VERSION)
    complete = latest.dropna(subset=["sponsor_id", "user_type_id", "rank_id"])
    return with_client(complete, clients).select(
        *CLIENT_COLUMNS, "event_eid", ts(batch_time).alias("ingestion_timestamp"),
        F.col("id").alias("tree_user_id"), *PII_COLUMNS,
        rules.street(F.col("address1"), F.col("address2")).alias("street"), *PII_CONTACT,
        rules.gender(F.col("gender")).alias("gender"), "birth_date",
        F.col("created_date").alias("created"),
    )


def user_branches(house: str, plain: str | None = None) -> Mapping[str, Mapping[str, Column]]:
    """The two clients' rules for users: normalised type and status, or the type as it is."""
    branches = {
        house: {
            "type": rules.user_type(F.col("client_type")),
            "status": rules.user_status(F.col("client_status")),
        }
    }
    if plain:
        branches[plain] = {"type": F.col("client_type")}
    return branches


def staging_users(
    tree_users: DataFrame, accounts: DataFrame, types: DataFrame, statuses: DataFrame, ranks: DataFrame,
    clients: DataFrame, first, last, house: str, plain: str | None = None, closed: str = "half_open",
) -> DataFrame:
    """Users touched in the window, in their newest version over all time.

    Only changed keys are ranked: the logs are semi-joined to them first.
    """
    touched = changed_keys(
        (in_window(tree_users, first, last, closed=closed), {"client": "client", "tree_user_id": "id"}),
        (in_window(accounts, first, last, closed=closed), {"client": "client", "tree_user_id": "tree_user_id"}),
    )
    latest = newest(all_versions_of(tree_users, touched, {"client": "client", "tree_user_id": "id"}), NAMED, VERSION)
    complete = latest.dropna(subset=["sponsor_id", "user_type_id", "rank_id"])
    logins = all_versions_of(accounts, touched, {"client": "client", "tree_user_id": "tree_user_id"})
    out = with_client(complete, clients)
    out = with_lookup(out, logins, {"client": "client", "id": "tree_user_id"}, {"id": "user_id"}, VERSION)
    by_id = lambda c: {"client": "client", c: "id"}
    out = with_lookup(out, types, by_id("user_type_id"), {"description": "client_type"}, VERSION)
    out = with_lookup(out, statuses, by_id("user_status_id"), {"description": "client_status"}, VERSION)
    levels = newest(ranks, NAMED, VERSION)
    for key, kind in (("paid_rank_id", "paid"), ("rank_id", "lifetime")):
        names = {"name": f"client_{kind}_rank", "level": f"client_{kind}_rank_level"}
        out = with_lookup(out, levels.withColumn("_level", F.col("level")), {"client": "client", key: "_level"}, names)
    shaped = out.select(
        *CLIENT_COLUMNS, *VERSION, F.col("id").alias("tree_user_id"), "user_id", "sponsor_id", "parent_id", "zip",
        F.col("created_date").alias("created"), F.col("updated_date").alias("modified"), "client_type",
        "client_status", F.lit("").alias("paid_rank"), F.lit(None).cast("long").alias("paid_rank_level"),
        "client_paid_rank", "client_paid_rank_level", F.lit("").alias("lifetime_rank"),
        F.lit(None).cast("long").alias("lifetime_rank_level"), "client_lifetime_rank", "client_lifetime_rank_level",
    )
    keep = (F.lower("client") != house.lower()) | rules.has_user_type(F.col("client_type"))
    return rules.route_clients(shaped.filter(keep), user_branches(house, plain))


ITEM_FIELDS = [
    "product_id", "product_code", "product_description", "quantity", "price_each", "price_total",
]


def staging_orders(*args, **options) -> DataFrame:
    """The orders of ``staged_orders``, one row each; the jobs that write them write its slices too."""
    return staged_orders(*args, **options)[0]


def staged_orders(
    tree_orders: DataFrame, order_items: DataFrame, tree_users: DataFrame, user_types: DataFrame,
    order_types: DataFrame, order_statuses: DataFrame, clients: DataFrame, first, last, house: str,
    plain: str | None = None, closed: str = "half_open", legacy_owner: bool = False, item_fields=ITEM_FIELDS,
    limit: int = ARRAY_LIMIT,
) -> tuple[DataFrame, DataFrame]:
    """Orders touched in the window - themselves or through an item - with nested items: two tables.

    The key set takes the item's *order* id, and event id and time come from the order version
    that was chosen.  The first table has one row per order; ``products`` holds its first ``limit`` items in the
    array's order.  The second, (client, order_id, slice, products), goes on from slice 1 for every
    order of the first that has more, so each item of an order is in exactly one of the two.
    """
    spark = tree_orders.sparkSession
    keep = lambda df: written(df, work_folder(spark))  # noqa: E731 - used several times below, computed once
    touched = keep(changed_keys(
        (in_window(tree_orders, first, last, closed=closed), {"client": "client", "order_id": "id"}),
        (in_window(order_items, first, last, closed=closed), {"client": "client", "order_id": "order_id"}),
    ))
    latest = keep(newest(all_versions_of(tree_orders, touched, {"client": "client", "order_id": "id"}), NAMED, VERSION))
    versions = all_versions_of(order_items, touched, {"client": "client", "order_id": "order_id"})
    nested = nest(_newest_items(versions), ["client", "order_id"], item_fields, "products", limit, counted=versions)
    products, rest = parent_and_rest(nested, ["client", "order_id"], "products")
    products = products.withColumnRenamed("order_id", "id")
    base = with_client(latest, clients)
    by_id = lambda c: {"client": "client", c: "id"}
    # only buyers of touched orders are ranked
    buyers = all_versions_of(tree_users, latest.select("client", "tree_user_id").distinct(),
                             {"client": "client", "tree_user_id": "id"})
    person = {"sponsor_id": "sponsor_id", "user_type_id": "user_type_id", "created_date": "user_created"}
    out = with_lookup(base, buyers, by_id("tree_user_id"), person, VERSION)
    out = with_lookup(out, user_types, by_id("user_type_id"), {"description": "client_user_type"}, VERSION)
    out = with_lookup(out, order_types, by_id("order_type_id"), {"description": "client_type"}, VERSION)
    out = with_lookup(out, order_statuses, by_id("order_status_id"), {"description": "client_status"}, VERSION)
    # the arrays come last, so that no other join moves them
    own = [c for c in base.columns if c not in NAMED]
    looked_up = [c for c in out.columns if c not in base.columns]
    out = out.join(products, NAMED, "left").select(*NAMED, *own, "products", *looked_up)
    shaped = out.withColumns(
        {"is_autoship": rules.is_autoship(F.col("autoship_template_id")), "order_id": F.col("id")}
    )
    orders = finish_orders(shaped, house, plain, legacy_owner)
    if rest.isEmpty():  # no order goes on: the orders need not be computed to hold it against them
        return orders, rest
    return orders, rest.join(orders.select("client", "order_id"), ["client", "order_id"], "left_semi")


def _newest_items(versions: DataFrame) -> DataFrame:
    """``newest`` of the items, where they lie by their order: only ids that several orders hold are moved."""
    order = ["client", "order_id"]
    own = newest(versions, [*order, "id"], VERSION)
    orders = versions.groupBy(*NAMED).agg(F.min("order_id").alias("_low"), F.max("order_id").alias("_high"))
    # stored, so that its real size decides how it is joined
    several = written(orders.filter("_low < _high").select("client", F.col("id").alias("_id")), work_folder(versions.sparkSession))
    met = (own["client"] == several["client"]) & own["id"].eqNullSafe(several["_id"])
    held = written(own.join(several, met, "left_semi"), work_folder(versions.sparkSession))
    last = newest(held, NAMED, VERSION).select("client", "order_id", F.col("id").alias("_id"))
    met = (held["client"] == last["client"]) & (held["order_id"] == last["order_id"]) & held["id"].eqNullSafe(last["_id"])
    older = written(held.join(last, met, "left_anti").select(*order, "id"), work_folder(versions.sparkSession))
    older = older.withColumnsRenamed({c: f"_{c}" for c in older.columns})
    met = (own["client"] == older["_client"]) & (own["order_id"] == older["_order_id"]) & own["id"].eqNullSafe(older["_id"])
    return own.join(older, met, "left_anti")


def finish_orders(df: DataFrame, house: str, plain: str | None = None, legacy_owner: bool = False) -> DataFrame:
    """Type, status and owner per client, then the helper columns go.

    The owner is decided from the *user* type before the order type replaces it.  The sign-up
    date of the buyer is compared with the order date.
    """
    keep = (F.lower("client") != house.lower()) | rules.has_user_type(F.col("client_user_type"))
    kind = rules.user_type(F.col("client_user_type"))
    coded, order_date = F.col("user_created"), F.col("order_date")
    branches = {
        house: {
            "type": rules.order_type(kind, coded, order_date),
            "status": rules.order_status(F.col("client_status")),
            "commission_user_id": rules.commission_owner(
                kind, F.col("tree_user_id"), F.col("sponsor_id"), coded, order_date, legacy_owner
            ),
        }
    }
    if plain:
        branches[plain] = {
            "type": F.lit("Customer"), "status": F.lit("Active"), "commission_user_id": F.col("tree_user_id"),
        }
    helpers = ["sponsor_id", "client_user_type", "user_created", "user_type_id", "order_type_id",
               "order_status_id", "autoship_template_id", "id"]
    return rules.route_clients(df.filter(keep), branches).drop(*helpers)


# --- full copies -----------------------------------------------------------------------------

FULL_COPY_EID = "z/0"


def copy_to_lake(df: DataFrame, client: str, batch_time) -> DataFrame:
    """A source table as it is, with the version columns and dates as text."""
    stamped = stamp(
        df, client=F.lit(client), event_eid=F.lit(FULL_COPY_EID), ingestion_timestamp=ts(batch_time)
    )
    return stringify_dates(stamped)


def database_rows(df: DataFrame) -> DataFrame:
    """Rows of a database table made ready for the lake: decimals and dates as text, zero dates
    null, long texts compressed."""
    plain = stringify_dates(stringify_decimals(zero_dates_to_null(df)))
    return plain.withColumns(
        {f.name: compress_long(F.col(f"`{f.name}`")) for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    )
