"""Order metrics per seller."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.functions.dates import days_between, one_year_before
from weirflow.functions.rules import active_distributors
from weirflow.operators.joins import with_client
from weirflow.operators.shares import ratio
from weirflow.operators.versions import newest

ORDER_TYPES = {"wholesale": "Wholesale", "autoship": "Autoship", "retail": "Retail"}

# lifetime counts take every order of these types, of the others only orders with a total
COUNT_ALL_ROWS = ("wholesale", "retail")


def order_measures(orders: DataFrame, keys, as_of: Column, types: Mapping[str, str] = ORDER_TYPES) -> DataFrame:
    """Counts, sums and first and last dates per key and order type, in one pass."""
    recent = F.col("order_date") >= one_year_before(as_of)
    measures = []
    for name, order_type in types.items():
        typed = F.col("type") == order_type
        counted = F.lit(1) if name in COUNT_ALL_ROWS else F.col("total")
        measures += [
            F.count(F.when(typed, counted)).alias(f"lifetime_total_{name}_count"),
            F.sum(F.when(typed, F.col("total"))).alias(f"lifetime_total_{name}_amount"),
            F.count(F.when(typed, 1)).alias(f"_rows_{name}"),
            F.count(F.when(typed & recent, F.col("total"))).alias(f"rolling_12_month_total_{name}_count"),
            F.sum(F.when(typed & recent, F.col("total"))).alias(f"rolling_12_month_total_{name}_amount"),
            F.count(F.when(typed & recent, 1)).alias(f"_recent_rows_{name}"),
            F.min(F.when(typed, F.col("order_date"))).alias(f"_first_{name}"),
            F.max(F.when(typed, F.col("order_date"))).alias(f"_last_{name}"),
        ]
    return orders.groupBy(*keys).agg(*measures)


def seller_metrics(
    users: DataFrame,
    orders: DataFrame,
    clients: DataFrame,
    as_of: Column,
    types: Mapping[str, str] = ORDER_TYPES,
    only_clients: list[str] | None = None,
    digits: int = 6,
) -> DataFrame:
    """27 order metrics for each active distributor.

    ``orders`` and ``users`` hold one row per key (``newest`` of their logs).  Orders are
    reduced to one row per buyer before they meet the users, so a buyer with very many orders
    costs one row per task.  A metric is null where the buyer has no such order.
    """
    keys = ["client", "tree_user_id"]
    wanted = clients if only_clients is None else clients.filter(
        F.lower("client").isin([c.lower() for c in only_clients])
    )
    people = with_client(active_distributors(users), wanted)
    joined = people.join(order_measures(orders, keys, as_of, types), keys, "left")
    columns = []
    for name in types:
        rows, recent_rows = F.col(f"_rows_{name}"), F.col(f"_recent_rows_{name}")
        life, year = f"lifetime_total_{name}", f"rolling_12_month_total_{name}"
        columns += [
            F.when(rows > 0, F.col(f"{life}_count")).alias(f"{life}_count"),
            F.col(f"{life}_amount"),
            F.round(ratio(F.col(f"{life}_amount"), rows), digits).alias(f"lifetime_avg_{name}_amount"),
            F.when(recent_rows > 0, F.col(f"{year}_count")).alias(f"{year}_count"),
            F.col(f"{year}_amount"),
            F.round(ratio(F.col(f"{year}_amount"), recent_rows), digits).alias(f"rolling_12_month_avg_{name}_amount"),
            days_between(F.col("created"), F.col(f"_first_{name}")).alias(f"days_to_first_{name}_order"),
            days_between(F.col(f"_last_{name}"), as_of).alias(f"days_since_last_{name}_order"),
        ]
    ids = [c for c in ("client_partition_id", "client_score_id", "client", "tree_user_id") if c in joined.columns]
    return joined.select(*ids, *columns)


def seller_metrics_from_logs(
    user_log: DataFrame, order_log: DataFrame, clients: DataFrame, as_of: Column, **options
) -> DataFrame:
    """The same from append-only logs: the newest version of each user and order."""
    version = ["event_eid", "ingestion_timestamp"]
    users = newest(user_log, ["client", "tree_user_id"], version)
    orders = newest(order_log, ["client", "order_id"], version)
    return seller_metrics(users, orders, clients, as_of, **options)
