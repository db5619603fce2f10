import pytest
from pyspark.sql import functions as F

from conftest import values
from weirflow.operators.joins import enrich, link_entities, person_profiles, polymorphic_lookup, with_client, with_lookup
from weirflow.operators.nesting import (
    first_of, last_of, nest, nest_many, scores_from_json, scores_from_wide, unnest,
)
from weirflow.operators.shares import by_rank_list, ratio, ratio_if_positive, running_total, top_n, total_over
from weirflow.operators.skew import fold_slices, hot_keys, join_sliced, slice_hot_keys


def test_client_join_drops_unknown(frame):
    clients = frame("client string, client_partition_id long", ("a", 1))
    assert values(with_client(frame("client string, id long", ("a", 1), ("x", 2)), clients)) == [("a", 1, 1)]


def test_lookup_takes_newest_and_never_multiplies(frame):
    facts = frame("client string, type_id long", ("a", 1), ("a", 1), ("a", 9))
    log = frame("client string, id long, event_eid string, description string", ("a", 1, "z/1", "old"), ("a", 1, "z/2", "new"))
    out = with_lookup(facts, log, {"client": "client", "type_id": "id"}, {"description": "kind"}, ["event_eid"])
    assert values(out, "type_id", "kind") == [(1, "new"), (1, "new"), (9, None)]


def test_polymorphic_lookup(frame):
    facts = frame("t string, k long", ("U", 1), ("C", 1), ("?", 1), ("U", 7))
    users, contacts = frame("id long, v long", (1, 10)), frame("id long, v long", (1, 20))
    out = polymorphic_lookup(facts, "t", "k", {"U": (users, "id", "v"), "C": (contacts, "id", "v")}, "found")
    assert values(out) == [("?", 1, None), ("C", 1, 20), ("U", 1, 10), ("U", 7, None)]


def test_enrich_later_columns_win_and_strict_fails(frame):
    plays = frame("track_id long, user_id long, name string", (1, 5, "play"))
    tracks, users = frame("track_id long, name string", (1, "song")), frame("user_id long, name string", (5, "ann"))
    assert values(enrich(plays, (tracks, "track_id"), (users, "user_id"), strict=True), "track_id", "user_id", "name") == [(1, 5, "ann")]
    lost = frame("track_id long, user_id long, name string", (2, 5, "play"))
    assert enrich(lost, (tracks, "track_id")).count() == 0
    with pytest.raises(Exception, match="no track_id = 2"):
        enrich(lost, (tracks, "track_id"), strict=True).collect()


ENTITY = "client string, entity_id string, file string, email string"
STATUS = "client string, file string, status string, table string, end_date timestamp_ntz"


def test_one_lead_then_one_contact_link(frame):
    entities = frame(ENTITY, ("a", "e1", "f1", "x@y"), ("b", "e2", "f2", "x@y"))
    statuses = frame(STATUS, ("a", "f1", "processed", "staging.leads", None), ("a", "f1", "processed", "staging.contacts", None),
                     ("b", "other", "processed", "staging.leads", None))
    people = frame("client string, email string, lead_id long", ("a", "x@y", 1), ("b", "x@y", 2))
    links = frame("entity_id string, lead_id long")
    new = link_entities(entities, statuses, people, links, "lead_id", "staging.leads")
    assert values(new) == [("e1", 1)]
    assert link_entities(entities, statuses, people, new, "lead_id", "staging.leads").count() == 0
    contacts = people.withColumnRenamed("lead_id", "contact_id")
    assert values(link_entities(entities, statuses, contacts, frame("entity_id string, contact_id long"), "contact_id", "staging.contacts")) == [("e1", 1)]


def test_processed_states_are_a_parameter(frame):
    statuses = frame(STATUS, ("a", "f1", "succeeded", "t", None))
    args = (frame(ENTITY, ("a", "e1", "f1", "x")), statuses, frame("client string, email string, id long", ("a", "x", 1)), frame("entity_id string, id long"), "id", "t")
    assert link_entities(*args).count() == 0
    assert link_entities(*args, processed=["succeeded"]).count() == 1


def test_profile_without_a_score_is_kept(frame):
    entities = frame("client string, entity_id string, email string, phone string, twitter string", ("a", "e1", "m", "p", "t"), ("b", "e2", "m", "p", "t"))
    links = frame("entity_id string, lead_id long", ("e1", 1), ("e2", 2))
    scores = frame("entity_id string, scores array<struct<client: string, score: long>>")
    levels = frame("entity_id string, prediction string", ("e1", "high"))
    out = person_profiles(entities, links, {"match_score": (scores, "scores"), "lcv_level": (levels, "prediction")}, "lead_id", client="a")
    row = out.first()
    assert out.count() == 1 and row.entity.entity_id == "e1" and row.match_score is None and row.lcv_level == "high"
    ids = frame("lead_id long", (2,))
    assert values(person_profiles(entities, links, {}, "lead_id", ids=ids), "lead_id") == [(2,)]


# --- nesting ---------------------------------------------------------------------------------


def test_nest_and_unnest(frame):
    items = frame("o long, id long, v string", (1, 2, "b"), (1, 1, "a"), (2, 3, "c"))
    nested = nest(items, ["o"], ["id", "v"], "products")
    rows = {r.o: [tuple(p) for p in r.products] for r in nested.collect()}
    assert rows == {1: [(1, "a"), (2, "b")], 2: [(3, "c")]}
    assert values(unnest(nested, "products", ["o"])) == [(1, 1, "a"), (1, 2, "b"), (2, 3, "c")]


def test_hot_key_is_nested_in_slices_and_stays_whole(spark):
    items = spark.range(1000).selectExpr("IF(id < 900, 0, id) AS o", "id")
    nested = nest(items, ["o"], ["id"], "products", limit=100)
    sizes = [len(r.products) for r in nested.filter("o = 0").collect()]
    assert len(sizes) == 9 and max(sizes) < 200
    assert values(unnest(nested, "products", ["o"])) == values(items)


def test_nest_many(frame):
    a, b = frame("k long, x long", (1, 1), (1, 2)), frame("k long, y string", (1, "u"), (2, "v"))
    out = nest_many({"xs": (a, ["x"]), "ys": (b, ["y"])}, ["k"])
    rows = {r.k: ([e.x for e in r.xs], [e.y for e in r.ys]) for r in out.collect()}
    assert rows == {1: ([1, 2], ["u"]), 2: ([], ["v"])}


def test_first_and_last(frame):
    df = frame("k long, d long, id long, t string", (1, 1, 1, "R"), (1, 1, 2, "W"), (1, 3, 3, "R"), (1, 9, 4, "W"), (1, None, 5, "R"))
    retail = F.col("t") == "R"
    known = df.filter("d is not null")
    row = known.groupBy("k").agg(
        first_of(F.col("id"), ["d", "id"]).alias("first"), last_of(F.col("id"), ["d", "id"]).alias("last"),
        first_of(F.col("id"), ["d", "id"], retail).alias("first_r"), last_of(F.col("id"), ["d", "id"], retail).alias("last_r"),
        last_of(F.col("id"), ["d", "id"], retail, legacy=True).alias("legacy_r"),
    ).first()
    assert (row.first, row.last, row.first_r, row.last_r, row.legacy_r) == (1, 4, 1, 3, None)


def test_scores_from_wide_and_json(frame):
    wide = frame("entity_id string, acme string, beta string", ("e", "7", "8"))
    assert [tuple(s) for s in scores_from_wide(wide, "entity_id", "client", "score", "int").first().scores] == [("acme", 7), ("beta", 8)]
    text = frame("answer string", ('{"entity_id": "e", "acme": 7, "beta": "8"}',))
    row = scores_from_json(text, "answer", "entity_id", "client", "score", "int").first()
    assert row.entity_id == "e" and [tuple(s) for s in row.scores] == [("acme", 7), ("beta", 8)]
    curve = scores_from_json(frame("answer string", ('{"entity_id": "e", "ecom": "early"}',)), "answer", "entity_id", "corpus", "score").first()
    assert [tuple(s) for s in curve.scores] == [("ecom", "early")]


# --- shares ----------------------------------------------------------------------------------


def test_shares_and_running_totals(frame):
    df = frame("g string, o long, n long", ("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", 1, 4))
    n = F.col("n")
    out = df.select("g", "o", "n", total_over(n).alias("t"), total_over(n, ["g"]).alias("tg"), running_total(n, ["o"], ["g"]).alias("r"))
    assert values(out) == [("a", 1, 1, 10, 6, 1), ("a", 2, 2, 10, 6, 6), ("a", 2, 3, 10, 6, 6), ("b", 1, 4, 10, 4, 4)]


def test_ratios(frame):
    df = frame("a long, b long", (1, 3), (0, 3), (1, 0))
    assert values(df.select(ratio(F.col("a"), F.col("b"), 2), ratio_if_positive(F.col("a"), F.col("a"), F.col("b"), 2))) == [(None, None), (0.0, None), (0.33, 0.33)]


def test_top_n_and_rank_list(frame):
    df = frame("k string, v long", ("a", 1), ("a", 3), ("a", 2), ("b", 1))
    assert values(top_n(df, ["k"], [F.col("v").desc()], 2)) == [("a", 2, 2), ("a", 3, 1), ("b", 1, 1)]
    names = frame("n string", ("x",), ("orders",), ("users",))
    assert [r.n for r in names.orderBy(by_rank_list(F.col("n"), ["users", "orders"])).collect()] == ["users", "orders", "x"]


# --- skew ------------------------------------------------------------------------------------


def test_hot_keys_and_slices(spark):
    df = spark.range(100).selectExpr("IF(id < 60, 1, id) AS k", "id")
    assert values(hot_keys(df, ["k"], 20)) == [(1, 3)]
    sliced = slice_hot_keys(df, ["k"], ["id"], 20)
    assert sliced.count() == 100 and values(sliced.filter("k = 1").select("slice").distinct()) == [(0,), (1,), (2,)]
    assert values(sliced.filter("k <> 1").select("slice").distinct()) == [(0,)]


def test_sliced_join_equals_plain_join(spark):
    facts = spark.range(200).selectExpr("IF(id < 120, 1, id % 10) AS k", "id AS v")
    side = spark.range(12).selectExpr("id AS k", "id * 10 AS s")
    joined = join_sliced(facts, side, ["k"], ["v"], limit=20)
    assert values(joined, "k", "v", "s") == values(facts.join(side, "k"), "k", "v", "s")
    folded = fold_slices(joined, ["k"], {"n": ("count", "v"), "t": ("sum", "v"), "lo": ("min", "s"), "hi": ("max", "v")})
    plain = facts.join(side, "k").groupBy("k").agg(F.count("v"), F.sum("v"), F.min("s"), F.max("v"))
    assert values(folded) == values(plain)
