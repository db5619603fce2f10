import random

import pytest
from pyspark.sql import functions as F

from conftest import values
from weirflow.operators.tree import all_sponsor_paths, closure, neighbours, sponsor_edges, sponsor_paths
from weirflow.plans import cohorts
from weirflow.plans.downline import downline_generations, sponsored_orders, sponsored_signups
from weirflow.functions.dates import ts
import datetime as dt
from decimal import Decimal


def brute(parents, limit=None):
    out = set()
    for user in parents:
        at, depth, seen = parents.get(user), 1, {user}
        while at is not None and at not in seen and (limit is None or depth <= limit):
            out.add((at, user, depth))
            seen.add(at)
            at, depth = parents.get(at), depth + 1
    return sorted(out)


def edge_frame(spark, parents):
    return spark.createDataFrame([(1, u, p) for u, p in parents.items()], "client_partition_id long, user_id long, sponsor_id long")


def random_tree(n, seed, deep):
    rnd = random.Random(seed)
    # a hot sponsor takes a third of everybody, the rest forms long chains
    return {u: 1 if rnd.random() < 0.33 and u > 1 else max(0, u - 1 if deep else rnd.randrange(u)) for u in range(1, n)}


@pytest.mark.parametrize("seed, deep", [(1, False), (2, True)])
def test_closure_equals_walking_up(spark, seed, deep):
    parents = random_tree(60, seed, deep)
    got = closure(all_sponsor_paths(edge_frame(spark, parents))).select("upline_id", "user_id", "depth")
    assert sorted(tuple(r) for r in got.collect()) == brute(parents)


def test_bounded_paths(spark):
    parents = random_tree(60, 3, True)
    got = closure(sponsor_paths(edge_frame(spark, parents), 6)).select("upline_id", "user_id", "depth")
    assert sorted(tuple(r) for r in got.collect()) == brute(parents, 6)


def test_cycles_end(spark):
    parents = {1: 3, 2: 1, 3: 2, 4: 3}
    got = closure(all_sponsor_paths(edge_frame(spark, parents))).select("upline_id", "user_id", "depth")
    assert sorted(tuple(r) for r in got.collect()) == brute(parents)


def test_a_tree_deeper_than_allowed_fails(spark):
    with pytest.raises(ValueError, match="deeper"):
        all_sponsor_paths(edge_frame(spark, {u: u - 1 for u in range(1, 12)}), max_depth=4)


def test_edges_need_both_ends(frame):
    users = frame("client_partition_id long, tree_user_id long, sponsor_id long",
                  (1, 0, None), (1, 1, 0), (1, 2, 1), (1, 3, 99), (1, 4, None), (2, 99, 4))
    edges = sponsor_edges(users)
    assert values(edges) == [(1, 1, 0), (1, 2, 1)]
    assert values(neighbours(edges), "user_id", "neighbour_id", "relation") == [(0, 1, "child"), (1, 0, "sponsor"), (1, 2, "child"), (2, 1, "sponsor")]


def test_equal_ids_of_two_clients_stay_apart(spark):
    edges = spark.createDataFrame([(1, 2, 1), (1, 3, 2), (2, 2, 3), (2, 3, 1)], "client_partition_id long, user_id long, sponsor_id long")
    want = [(1, 1, 2, 1), (1, 1, 3, 2), (1, 2, 3, 1), (2, 1, 2, 2), (2, 1, 3, 1), (2, 3, 2, 1)]
    for paths in (all_sponsor_paths(edges), sponsor_paths(edges, 6)):
        assert values(closure(paths), "client_partition_id", "upline_id", "user_id", "depth") == want


def test_one_order_is_one_sale_of_one_client(frame):
    users = frame("client_partition_id long, tree_user_id long, sponsor_id long, type string, created timestamp_ntz, coded timestamp_ntz",
                  *[(c, 7, None, "Distributor", day(0), day(0)) for c in (1, 2)])
    orders = frame("client_partition_id long, order_id long, tree_user_id long, commission_user_id long, type string, status string, is_autoship boolean, total decimal(18,2), order_date timestamp_ntz",
                   (1, 5, 7, 7, "Retail", "Active", False, Decimal(10), day(3)))
    value = cohorts.lifetime_value(users, orders).collect()
    assert sum(r.sales_count for r in value) == 1 and sum(r.sales_total or 0 for r in value) == Decimal(10)
    assert sum(r.num for r in cohorts.days_to_first_sale(users, orders).collect()) == 1
    assert sum(r["count"] for r in cohorts.order_mix(users, orders).collect()) == 1


def day(n):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


def test_sponsored_reports(spark, frame):
    users = frame("client_partition_id long, tree_user_id long, client string, created timestamp_ntz, type string, sponsor_id long",
                  (1, 0, "a", day(0), "Distributor", None), (1, 1, "a", day(5), "Distributor", 0), (1, 2, "a", day(20), "Distributor", 1),
                  (2, 3, "b", day(1), "Distributor", 0), (2, 0, "b", day(9), "Distributor", None))
    attributes = users.select("client_partition_id", F.col("tree_user_id").alias("user_id"), "client", F.col("created").alias("signup"))
    paths = all_sponsor_paths(sponsor_edges(users), attributes)
    assert values(sponsored_signups(users, paths), "client", "user_id", "signups_7_days", "signups_30_days") == [("a", 0, 1, 2), ("a", 1, 0, 1), ("b", 0, 1, 1)]
    orders = frame("client_partition_id long, tree_user_id long, order_date timestamp_ntz, total decimal(18,2), status string",
                   (1, 2, day(3), Decimal(10), "x"), (1, 2, day(6), Decimal(20), "x"), (1, 2, day(31), Decimal(40), "x"), (2, 3, day(2), Decimal(80), "x"))
    got = {r.user_id: r for r in sponsored_orders(users, paths, orders).collect() if r.client == "a"}
    zero, one = got[0], got[1]
    assert (zero.orders_first_7_after_signup, zero.orders_first_30_after_signup, zero.total_first_30_after_signup) == (2, 2, Decimal(30))
    assert (one.orders_before_signup, one.orders_first_7_after_signup, one.orders_first_30_after_signup) == (1, 1, 2)
    assert one.seconds_from_signup_to_first_order == -2 * 86400
    gens = downline_generations(users, sponsor_paths(sponsor_edges(users), attributes=attributes.drop("client")), orders, ts(day(35)))
    top = gens.filter("tree_user_id = 0 AND client_partition_id = 1").first()
    assert (top.gen1_distributors_count, top.gen2_distributors_count, top.gen3_distributors_count) == (1, 1, 0)
    assert (top.gen1_distributors_lcv, top.gen2_distributors_lcv, top.days_to_first_downline_distributor) == (None, Decimal(70), 5)
    assert top.downline_distributor_signups_last_30 == 2
    other = gens.filter("client_partition_id = 2").first()
    assert (other.gen1_distributors_count, other.gen1_distributors_lcv) == (1, Decimal(80))
