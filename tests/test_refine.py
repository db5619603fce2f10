import datetime as dt
from decimal import Decimal
from functools import partial

import pytest

from conftest import values
from parity import compare, connect
from weirflow.catalog import refined
from weirflow.functions.dates import ts
from weirflow.plans import refine
from weirflow.plans.sellers import seller_metrics_from_logs


def at(n):
    return dt.datetime(2020, 1, 1) + dt.timedelta(hours=n)


V = "client string, event_eid string, ingestion_timestamp timestamp_ntz"


@pytest.fixture
def clients(frame):
    return frame("client string, client_partition_id long, client_score_id string", ("House", 2, "s2"), ("plain", 3, "s3"))


def test_contacts_window_ends_at_the_first_version(frame, clients):
    log = frame("client string, id long, first_name string, ingestion_timestamp timestamp_ntz", ("House", 1, "old", at(1)), ("House", 1, "new", at(2)), ("nobody", 2, "x", at(1)))
    out = refine.people(log, clients, str(at(0)), str(at(2)), at(9))
    assert values(out, "id", "first_name", "client_partition_id", "ingestion_timestamp") == [(1, "old", 2, at(9))]


def test_a_lead_bought_later_is_gone(frame, clients):
    log = frame("client string, id long, purchased boolean, created_at timestamp_ntz, updated_at timestamp_ntz, ingestion_timestamp timestamp_ntz",
                ("House", 1, False, at(0), at(0), at(1)), ("House", 1, True, at(0), at(0), at(2)), ("House", 2, False, at(0), at(0), at(1)))
    out = refine.leads(log, clients, str(at(0)), str(at(5)), at(9))
    assert values(out, "lead_id") == [(2,)] and "created" in out.columns


def test_pii_users(frame, clients):
    names = "first_name string, last_name string, company_name string, address1 string, address2 string, city string, state string, country string, email string, phone string, mobile_phone string, gender string, birth_date date, created_date timestamp_ntz"
    person = ("a", "b", None, "1 Road", "Flat 2", "c", "s", "US", "e", "p", "m", "F", dt.date(1980, 1, 1), at(0))
    log = frame(f"{V}, id long, sponsor_id long, user_type_id long, rank_id long, {names}",
                ("House", "z/1", at(1), 1, 9, 1, 1, *person), ("House", "z/1", at(2), 2, None, 1, 1, *person), ("House", "z/1", at(0), 3, 9, 1, 1, *person))
    out = refine.pii_users(log, clients, str(at(1)), str(at(5)), at(9))
    assert values(out, "tree_user_id", "street", "gender", "client_partition_id") == [(1, "1 Road Flat 2", "female", 2)]


TREE = f"{V}, id long, user_type_id long, user_status_id long, rank_id long, paid_rank_id long, sponsor_id long, parent_id long, zip string, created_date timestamp_ntz, updated_date timestamp_ntz"


def lookups(frame):
    types = frame(f"{V}, id long, description string", ("House", "z/1", at(0), 1, "Distributor"), ("House", "z/2", at(0), 1, "Employee"), ("plain", "z/1", at(0), 1, "Member"), ("House", "z/1", at(0), 5, None))
    statuses = frame(f"{V}, id long, description string", ("House", "z/1", at(0), 1, "Grace"))
    ranks = frame(f"{V}, id long, name string, level long", ("House", "z/1", at(0), 10, "Star", 3))
    return types, statuses, ranks


def test_staging_users(frame, clients):
    tree = frame(TREE, ("House", "z/1", at(1), 1, 1, 1, 3, 3, 9, 8, "z", at(0), at(0)), ("House", "z/2", at(6), 1, 1, 1, 3, None, 9, 8, "new", at(0), at(0)),
                 ("House", "z/1", at(1), 2, 1, 1, 3, 3, 9, 8, "z", at(0), at(0)), ("plain", "z/1", at(6), 3, 1, 1, 1, 1, 9, 8, "z", at(0), at(0)),
                 ("House", "z/1", at(6), 4, 5, 1, 3, 3, 9, 8, "untyped", at(0), at(0)))
    accounts = frame(f"{V}, id long, tree_user_id long", ("House", "z/1", at(6), 77, 2), ("House", "z/0", at(1), 76, 2))
    types, statuses, ranks = lookups(frame)
    out = refine.staging_users(tree, accounts, types, statuses, ranks, clients, str(at(5)), str(at(9)), "house", "plain")
    assert values(out, "tree_user_id", "user_id", "type", "status", "client_lifetime_rank", "zip") == [
        (1, None, "Autoship", "Active", "Star", "new"), (2, 77, "Autoship", "Active", "Star", "z"), (3, None, "Member", None, None, "z")]
    # nothing changed in the window: nothing comes out
    assert refine.staging_users(tree, accounts, types, statuses, ranks, clients, str(at(20)), str(at(30)), "house", "plain").count() == 0


ORDER = f"{V}, id long, tree_user_id long, order_type_id long, order_status_id long, autoship_template_id long, order_date timestamp_ntz, total decimal(18,2)"
ITEM = f"{V}, id long, order_id long, product_id long, product_code string, product_description string, quantity long, price_each decimal(18,2), price_total decimal(18,2)"


def orders_of(frame, clients, first, last, **options):
    tree = frame(TREE, ("House", "z/1", at(0), 1, 1, 1, 3, 3, 9, 8, "z", at(50), at(0)), ("House", "z/2", at(0), 2, 2, 1, 3, 3, 9, 8, "z", at(0), at(0)),
                 ("plain", "z/1", at(0), 3, 1, 1, 3, 3, 9, 8, "z", at(0), at(0)))
    types = frame(f"{V}, id long, description string", ("House", "z/1", at(0), 1, "Distributor"), ("House", "z/1", at(0), 2, "Import"), ("plain", "z/1", at(0), 1, "Member"))
    names = frame(f"{V}, id long, description string", ("House", "z/1", at(0), 1, "CC Declined"), ("House", "z/1", at(0), 2, "Shipped"))
    order = lambda c, i, u, s, t: (c, "z/1", at(1), i, u, 1, s, t, at(10), Decimal(5))
    log = frame(ORDER, order("House", 100, 1, 1, 0), order("House", 101, 2, 2, 4), order("plain", 102, 3, 1, None), order("House", 103, 2, 2, 0))
    item = lambda e, n, i, o, q: ("House", e, at(n), i, o, 7, "c", "text", q, Decimal(1), Decimal(q))
    items = frame(ITEM, item("z/1", 1, 900, 101, 1), item("z/2", 6, 900, 101, 2), item("z/1", 1, 901, 101, 3), item("z/1", 6, 902, 100, 4), item("z/1", 1, 903, 103, 9),
                  ("plain", "z/1", at(6), 904, 102, 7, "c", "text", 1, Decimal(1), Decimal(1)))
    return refine.staging_orders(log, items, tree, types, names, names, clients, first, last, "house", "plain", **options)


def test_staging_orders(frame, clients):
    out = orders_of(frame, clients, str(at(5)), str(at(9)))
    assert values(out, "order_id", "type", "status", "commission_user_id", "is_autoship") == [
        (100, "Autoship", "Inactive", 9, False), (101, "Wholesale", "Active", 2, True), (102, "Customer", "Active", 3, False)]
    lines = {r.order_id: [(p.product_id, p.quantity) for p in r.products] for r in out.collect()}
    assert lines[101] == [(7, 2), (7, 3)] and lines[100] == [(7, 4)]
    for helper in ("sponsor_id", "client_user_type", "user_created", "id"):
        assert helper not in out.columns


def test_newest_items_of_ids_that_move_between_orders(frame):
    """As ranked over all versions of an id, whichever orders they name; a null id is a key of its own."""
    item = lambda e, n, i, o, q: ("House", e, at(n), i, o, 7, "c", "text", q, Decimal(1), Decimal(q))
    rows = [item("z/1", 1, 1, 10, 1), item("z/2", 2, 1, 11, 2), item("z/3", 3, 1, 10, 3), item("z/1", 1, 2, 10, 4), item("z/1", 1, 3, 11, 5), item("z/1", 1, 3, 12, 6),
            item("z/1", 1, None, 10, 7), item("z/2", 1, None, 11, 8), item("z/1", 1, 4, 12, 9), item("z/1", 1, 4, 12, 9)]
    versions = frame(ITEM, *rows)
    got = refine._newest_items(versions)
    assert values(got) == values(refine.newest(versions, refine.NAMED, refine.VERSION)) and got.count() == 5


def test_a_window_moves_no_items_of_bucketed_logs(spark, frame, clients):
    """The items of a log that is stored by client and order stay where they lie until they are nested."""
    item = lambda k: ("House", "z/1", at(k % 7), k, k % 50, 7, "c", "text", k, Decimal(1), Decimal(k))
    frame(ITEM, *[item(k) for k in range(500)]).repartition(4, "client", "order_id").write.bucketBy(4, "client", "order_id").saveAsTable("moved_items")
    try:
        touched = frame("client string, order_id long", *[("House", k) for k in range(40)])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        versions = refine.all_versions_of(spark.table("moved_items"), touched, {"client": "client", "order_id": "order_id"})
        plan = versions._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1, plan  # the touched keys
        own = refine.newest(versions, ["client", "order_id", "id"], refine.VERSION).groupBy("client", "order_id").count()
        assert own._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1 and own.count() == 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE moved_items")


def test_legacy_owner_is_always_the_sponsor(frame, clients):
    out = orders_of(frame, clients, str(at(5)), str(at(9)), legacy_owner=True)
    assert values(out, "order_id", "commission_user_id") == [(100, 9), (101, 9), (102, 3)]


def test_full_copies(frame):
    df = frame("id long, price decimal(10,2), day date, gone string, body string", (1, Decimal("1.50"), dt.date(2020, 1, 1), "0000-00-00", "x" * 1001))
    copy = refine.copy_to_lake(df.select("id", "day"), "acme", at(0)).first()
    assert (copy.day, copy.client, copy.event_eid, copy.ingestion_timestamp) == ("2020-01-01", "acme", "z/0", "2020-01-01 00:00:00")
    row = refine.database_rows(df).first()
    assert (row.price, row.day, row.gone) == ("1.50", "2020-01-01", None) and len(row.body) < 1001


def test_seller_metrics_take_the_newest_versions(frame, clients):
    users = frame(f"{V}, tree_user_id long, created timestamp_ntz, client_status string, client_type string",
                  ("House", "z/1", at(0), 1, at(0), "Active", "Distributor"), ("House", "z/1", at(0), 2, at(0), "Terminated", "Distributor"))
    order = lambda e, i, t, total, n: ("House", e, at(0), i, 1, t, None if total is None else Decimal(total), at(n))
    orders = frame(f"{V}, order_id long, tree_user_id long, type string, total decimal(18,2), order_date timestamp_ntz",
                   order("z/1", 1, "Retail", 10, 24), order("z/2", 1, "Retail", 30, 24), order("z/1", 2, "Retail", None, 48), order("z/1", 3, "Autoship", None, 48))
    out = seller_metrics_from_logs(users, orders, clients, ts(at(24 * 10)))
    row = out.first()
    assert out.count() == 1 and row.tree_user_id == 1
    assert (row.lifetime_total_retail_count, row.lifetime_total_retail_amount, row.lifetime_avg_retail_amount) == (2, Decimal(30), 15.0)
    assert (row.rolling_12_month_total_retail_count, row.days_to_first_retail_order, row.days_since_last_retail_order) == (1, 1, 8)
    assert (row.lifetime_total_autoship_count, row.lifetime_total_wholesale_count) == (0, None)
    only = seller_metrics_from_logs(users, orders, clients, ts(at(240)), only_clients=["PLAIN"])
    assert only.count() == 0


@pytest.mark.parametrize("name", ["staging_orders", "refine_cycle"])
def test_an_order_longer_than_an_array_keeps_all_its_items(spark, monkeypatch, name):
    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(refine, "staged_orders", partial(refine.staged_orders, limit=3))
    run, text = refined.QUERIES[name]
    ok, note = compare(run(spark, sf), connect(sf), text)
    assert ok, note
