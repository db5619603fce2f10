import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import values
from weirflow.functions import fixed, rules
from weirflow.functions.dates import days_between, months_between_boundaries, ts, whole_units


def test_user_type_drops_rows_without_one(frame):
    df = frame("id long, client_type string", (1, "Distributor"), (2, None), (3, ""))
    assert values(rules.normalize_user_type(df), "id", "type") == [(1, "Distributor")]


def test_every_listed_user_type(frame):
    listed = list(fixed.USER_TYPE_LOOKUP.items())
    df = frame("client_type string, want string", *listed, ("Pending TRANSFER", "Distributor"), ("Preferred Customer", "Autoship"))
    out = rules.normalize_user_type(df)
    assert out.filter(F.col("type") != F.col("want")).count() == 0
    assert out.count() == len(listed) + 2


def test_transfer_wins_over_customer(frame):
    df = frame("client_type string", ("Customer Transfer",))
    assert values(rules.normalize_user_type(df), "type") == [("Distributor",)]


def test_unknown_user_type_fails_or_is_set_aside(frame):
    df = frame("client_type string", ("martian",))
    with pytest.raises(Exception, match="martian"):
        rules.normalize_user_type(df).collect()
    assert values(rules.normalize_user_type(df, on_unknown="null"), "type") == [(None,)]


@pytest.mark.parametrize("raw, want", [("Active", "Active"), ("GRACE", "Active"), ("hold", "Active"), ("gone", "Inactive"), (None, None)])
def test_user_status(frame, raw, want):
    df = frame("s string", (raw,))
    assert values(df.select(rules.user_status(F.col("s")))) == [(want,)]


def test_null_status_keeps_what_is_there(frame):
    df = frame("s string, status string", (None, "tbd"), ("hold", "tbd"))
    assert values(df.select(rules.user_status(F.col("s"), F.col("status")))) == [("Active",), ("tbd",)]


DAY = dt.datetime(2020, 5, 1)


@pytest.mark.parametrize(
    "kind, created, ordered, want",
    [
        ("Distributor", DAY, DAY, "Wholesale"),
        ("Distributor", DAY, DAY + dt.timedelta(days=1), "Wholesale"),
        ("Distributor", DAY + dt.timedelta(days=1), DAY, "Autoship"),
        ("Autoship", DAY, DAY, "Autoship"),
        ("Other", DAY, DAY, "Other"),
    ],
)
def test_order_type(frame, kind, created, ordered, want):
    df = frame("t string, c timestamp_ntz, o timestamp_ntz", (kind, created, ordered))
    assert values(df.select(rules.order_type(F.col("t"), F.col("c"), F.col("o")))) == [(want,)]


@pytest.mark.parametrize("raw, want", [("ACH Declined", "Inactive"), ("cancelled", "Inactive"), ("CC Declined", "Inactive"), ("Shipped", "Active")])
def test_order_status(frame, raw, want):
    assert values(frame("s string", (raw,)).select(rules.order_status(F.col("s")))) == [(want,)]


def test_commission_owner(frame):
    late = DAY + dt.timedelta(days=1)
    df = frame(
        "t string, buyer long, sponsor long, c timestamp_ntz, o timestamp_ntz",
        ("Distributor", 1, 9, DAY, late), ("Distributor", 2, 9, late, DAY), ("Autoship", 3, 9, DAY, late),
    )
    args = [F.col(c) for c in ("t", "buyer", "sponsor", "c", "o")]
    assert values(df.select("buyer", rules.commission_owner(*args))) == [(1, 1), (2, 9), (3, 9)]
    assert values(df.select("buyer", rules.commission_owner(*args, legacy=True))) == [(1, 9), (2, 9), (3, 9)]


def test_active_distributors_lose_their_helpers(frame):
    df = frame("id long, client_type string, client_status string",
               (1, "Distributor", "Active"), (2, "Distributor", "Grace"), (3, "Customer", "Active"))
    out = rules.active_distributors(df)
    assert out.columns == ["id"] and values(out) == [(1,), (2,)]


def test_route_clients_ignores_case_and_drops_unknown(frame):
    df = frame("client string, raw string, type string", ("Acme", "x", "old"), ("BETA", "y", "old"), ("other", "z", "old"))
    out = rules.route_clients(df, {"acme": {"type": F.lit("A")}, "Beta": {"status": F.col("raw")}})
    assert values(out, "client", "type", "status") == [("Acme", "A", None), ("BETA", "old", "y")]


def test_merge_branches(frame):
    a, b = frame("id long, x string", (1, "a")), frame("y string, id long", ("b", 2))
    assert values(rules.merge_branches(a, b), "id", "x", "y") == [(1, "a", None), (2, None, "b")]


@pytest.mark.parametrize("days, label", [(-1, None), (0, "0"), (1, "1-15"), (15, "1-15"), (16, "16-90"), (90, "16-90"), (91, "91-180"),
                                         (180, "91-180"), (181, "181-365"), (365, "181-365"), (366, "366-730"), (730, "366-730"), (731, "> 730"), (None, None)])
def test_day_bucket_edges(frame, days, label):
    assert values(frame("d long", (days,)).select(rules.day_bucket(F.col("d")))) == [(label,)]


def test_buckets_have_no_gap():
    for edges in (fixed.DAY_BUCKETS, fixed.FINE_DAY_BUCKETS):
        for (_, high, *_), (low, *_) in zip(edges, edges[1:]):
            assert low == high + 1


@pytest.mark.parametrize("platform, want", [(None, "unknown"), ("Android 9", "android"), ("iPhone", "iphone"), ("iPad2", "ipad"), ("Windows", "windows"),
                                            ("Windows 10", "other"), ("Mac OS X", "macos"), ("linux x86", "linux"), ("Fedora", "linux"), ("ChromeOS", "chromeos"), ("android", "other")])
def test_platform(frame, platform, want):
    assert values(frame("p string", (platform,)).select(rules.platform_class(F.col("p")))) == [(want,)]


@pytest.mark.parametrize("text, kind, member", [
    ("RBS Monthly", "subscription", "rep"), ("DTP Reactivation", "fee", "dream trips platinum"), ("DT Plus Gold", "DT Plus Gold", "dream trips gold"),
    ("Initial Box Free", "discount", "none"), ("wva boot camp", "event", "worldventures a"), ("Pick Your Product", "product", "none")])
def test_product_rules(frame, text, kind, member):
    df = frame("t string", (text,))
    assert values(df.select(rules.product_type(F.col("t")), rules.membership_type(F.col("t")))) == [(kind, member)]


def test_street_and_gender(frame):
    df = frame("a string, b string, g string", ("1 Road", None, "F"), ("1 Road", "", "male"), ("1 Road", "Flat 2", "x"), (None, "Flat 2", None))
    assert values(df.select(rules.street(F.col("a"), F.col("b")), rules.gender(F.col("g")))) == [
        (None, "none"), ("1 Road", "female"), ("1 Road", "male"), ("1 Road Flat 2", "none")]


def test_codes(frame):
    df = frame("c string", ("B",), ("Y",), ("?",))
    assert values(df.select("c", rules.order_code_name(F.col("c")))) == [("?", None), ("B", "Backorder Cancelled"), ("Y", "Point Redemption")]
    m = frame("c string", ("MEMBER",), ("RETAIL",), ("BA",), ("PC",), ("X",))
    assert values(m.select("c", rules.member_user_type(F.col("c")))) == [
        ("BA", "Distributor"), ("MEMBER", "Distributor"), ("PC", "Autoship"), ("RETAIL", "Customer"), ("X", None)]


def test_autoship_and_titles(frame):
    assert values(frame("n long", (None,), (0,), (3,)).select("n", rules.is_autoship(F.col("n")))) == [(None, False), (0, False), (3, True)]
    df = frame("t string", ("a test",), (None,), ("call",))
    assert values(rules.without_test_titles(df, "t")) == [("call",)]


def test_id_lists(frame):
    df = frame("ids string", ("3,1,,3,",), ("4;5",))
    assert values(df.select(rules.is_id_list(F.col("ids")))) == [(False,), (True,)]
    people = frame("id long", (1,), (2,), (3,), (4,))
    assert values(rules.in_id_list(people, "id", df, "ids")) == [(1,), (3,)]
    assert df.filter(rules.is_id_list(F.col("ids"))).select(rules.parse_id_list(F.col("ids"))).first()[0] == [3, 1]


def test_expired_paths(frame):
    df = frame("p string", ("logs/2020-06-01T00/1.log",), ("logs/2020-06-30/1.log",), ("logs/2020-06-01/x.txt",), ("2020-99-01/1.log",))
    assert values(rules.expired_paths(df, "p", ts("2020-07-01 00:00:00"), 30)) == [("logs/2020-06-01T00/1.log",)]


def test_required_fields(frame):
    df = frame("id long, name string", (1, "a"), (2, None), (None, None))
    valid, rejected = rules.require_fields(df, ["id", "name"])
    assert values(valid) == [(1, "a")]
    assert values(rejected, "missing_fields") == [(["id", "name"],), (["name"],)]


def test_two_kinds_of_difference(frame):
    df = frame("a timestamp_ntz, b timestamp_ntz", (dt.datetime(2020, 1, 31, 23), dt.datetime(2020, 2, 1, 1)))
    a, b = F.col("a"), F.col("b")
    assert values(df.select(days_between(a, b), whole_units("DAY", a, b), months_between_boundaries(a, b), whole_units("HOUR", a, b))) == [(1, 0, 1, 2)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=-10, max_value=2000), min_size=1, max_size=20))
def test_every_day_has_one_bucket(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d long")
    for row in df.select("d", rules.day_bucket(F.col("d")).alias("b")).collect():
        hits = [label for low, high, label, _ in fixed.DAY_BUCKETS if row.d >= low and (high is None or row.d <= high)]
        assert [row.b] == (hits or [None])
