"""Places, running sums, batches, whole nested arrays, keyed tables and logs, sketches."""

import random

import pytest
from pyspark.sql import functions as F, types as T

from conftest import values
from weirflow.operators import keyed_log, sketches
from weirflow.operators import nesting
from weirflow.operators.nesting import nest, nest_many, parent_and_rest, unnest
from weirflow.operators.positions import batches_by_size, positions, running_sums
from weirflow.sources import writers

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- positions -------------------------------------------------------------------------------


def test_positions_over_the_table_and_inside_a_hot_key(spark):
    rng = random.Random(1)
    rows = [(None if k % 50 == 0 else int(rng.random() ** 4 * 5), rng.randrange(200), k) for k in range(2000)]
    df = spark.createDataFrame(rows, "g long, a long, b long").repartition(7)
    whole = {r.b: r.place for r in positions(df, [F.col("a").desc(), "b"], out="place").collect()}
    assert whole == {b: i for i, (_, _, b) in enumerate(sorted(rows, key=lambda r: (-r[1], r[2])), 1)}
    own = {r.b: r.position for r in positions(df, ["a", "b"], ["g"]).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        want |= {b: i for i, (_, _, b) in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2])), 1)}
    assert own == want


def test_rows_equal_in_the_order_get_each_a_place_of_their_own(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (None, "z")], "a long, b string")
    assert values(positions(df, ["a"]), "position", "a", "b") == [(1, None, "z"), (2, 1, "a"), (3, 1, "a"), (4, 1, "b")]
    assert positions(df.limit(0), ["a"]).count() == 0


def test_whole_sort_has_no_window_over_everything(spark):
    plan = plan_of(positions(spark.range(100), [F.col("id").desc()]))
    assert "Window" not in plan and "SinglePartition" not in plan


def test_running_sums_and_batches(spark):
    rng = random.Random(3)
    sizes = [(k, rng.choice([0, 1, 5, 40, 99, 100, 101, 350])) for k in range(600)] + [(600, None)]
    df = spark.createDataFrame(sizes, "k long, n long").repartition(5)
    total, want = 0, {}
    for k, n in sizes:
        total += n or 0
        want[k] = total
    assert {r.k: r.running for r in running_sums(df, ["k"], "n").collect()} == want
    batches = {}
    for r in batches_by_size(df, ["k"], "n", 100).orderBy("k").collect():
        batches.setdefault(r.batch, []).append((r.k, r.n or 0))
    for rows in batches.values():
        assert sum(n for _, n in rows) <= 100 or len([n for _, n in rows if n]) == 1
        assert [k for k, _ in rows] == list(range(rows[0][0], rows[-1][0] + 1))
    assert sorted(batches) == sorted(batches, key=lambda b: batches[b][0][0])
    assert len(batches) <= 2 * total / 100 + 2


# --- whole nested arrays ---------------------------------------------------------------------


@pytest.mark.parametrize("size", [99, 100, 101, 300, 1000])
def test_slices_are_full_in_order_and_hold_every_element(spark, size):
    items = spark.range(size).selectExpr("CAST(NULL AS STRING) AS o", "id").unionByName(spark.range(150).selectExpr("CAST(id AS STRING) AS o", "id"))
    nested = nest(items.repartition(5), ["o"], ["id"], "products", limit=100)
    first, rest = parent_and_rest(nested, ["o"], "products")
    assert first.count() == 151 and first.select("o").distinct().count() == 151
    hot = [p.id for p in first.filter("o IS NULL").first().products]
    assert hot == list(range(min(size, 100)))
    slices = {r.slice: [p.id for p in r.products] for r in rest.collect()}
    assert slices == {k: list(range(100 * k, min(size, 100 * k + 100))) for k in range(1, -(-size // 100))}
    assert values(unnest(nested, "products", ["o"])) == values(items)


def test_slices_of_collected_and_of_placed_keys_agree(spark, monkeypatch):
    """Keys of up to ``whole`` elements are cut where they lie, larger ones are placed by range."""
    placed = []
    monkeypatch.setattr(nesting, "positions", lambda df, *args, **options: placed.append(df.count()) or positions(df, *args, **options))
    items = spark.range(1000).selectExpr("CASE WHEN id < 30 THEN 'a' WHEN id < 95 THEN 'b' WHEN id < 300 THEN NULL ELSE 'd' END AS o", "id")
    want = {("a", 30), ("b", 65), (None, 205), ("d", 700)}
    rows = lambda df: sorted((str(r.o), r.slice, [p.id for p in r.products]) for r in df.collect())
    cut = rows(nest(items, ["o"], ["id"], "products", limit=20))
    assert placed == []
    both = rows(nest(items, ["o"], ["id"], "products", limit=20, whole=100))
    assert placed == [905] and cut == both
    assert sorted((o, k, len(p)) for o, k, p in cut) == sorted((str(o), k, min(20, n - 20 * k)) for o, n in want for k in range(-(-n // 20)))


def test_each_of_several_arrays_is_sliced_by_its_own_places(spark):
    a = spark.range(250).selectExpr("0L AS k", "id AS x")
    b = spark.range(30).selectExpr("id % 2 AS k", "id AS y")
    out = {(r.k, r.slice): ([e.x for e in r.xs], [e.y for e in r.ys]) for r in nest_many({"xs": (a, ["x"]), "ys": (b, ["y"])}, ["k"], limit=100).collect()}
    assert out == {(0, 0): (list(range(100)), list(range(0, 30, 2))), (0, 1): (list(range(100, 200)), []), (0, 2): (list(range(200, 250)), []),
                   (1, 0): ([], list(range(1, 30, 2)))}


# --- keyed tables ----------------------------------------------------------------------------

ROWS = "client_partition_id long, id long, v string, n long"


def files_of(folder):
    return {f: f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}


def test_upsert_rewrites_only_the_buckets_it_touches(spark, frame, tmp_path):
    path, work = str(tmp_path / "t"), str(tmp_path / "w")
    rows = [(k % 2, k, "old", 1) for k in range(400)]
    writers.create_keyed(frame(ROWS, *rows), path, ["client_partition_id", "id"], buckets=8)
    before = files_of(tmp_path / "t")
    assert len({f.parent for f in before}) == 16
    changes = frame(ROWS, (0, 10, "new", 2), (0, 10, "newer", 3), (0, 1000, "added", 1))
    for _ in range(2):
        writers.upsert_partitions(spark, path, changes, ["client_partition_id", "id"], ["n"], work)
    kept = files_of(tmp_path / "t")
    touched = {f.parent for f in before if f not in kept}
    assert 1 <= len(touched) <= 2 and all(f.parent.name == "client_partition_id=0" for f in [t for t in touched])
    got = {r.id: r.v for r in writers.read_keyed(spark, path).collect()}
    assert got == {k: "old" for k in range(400)} | {10: "newer", 1000: "added"}
    # a stored newer row stays where rows compete
    writers.upsert_partitions(spark, path, frame(ROWS, (0, 10, "late", 1), (1, 11, "next", 5)), ["client_partition_id", "id"], ["n"], work, keep_newer=True)
    got = {r.id: r.v for r in writers.read_keyed(spark, path).filter("id IN (10, 11)").collect()}
    assert got == {10: "newer", 11: "next"}
    writers.upsert_partitions(spark, path, changes.limit(0), ["client_partition_id", "id"], ["n"], work)
    assert writers.read_keyed(spark, path).count() == 401


def test_keyed_log_reads_ranges_without_a_shuffle(spark):
    name = "keyed_log_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    log = spark.range(10_000).selectExpr("IF(id % 2 = 0, 'a', 'b') AS client", "id", "1 AS v")
    for v in (1, 2):
        keyed_log.append_log(log.withColumn("v", F.lit(v)), name, ["client", "id"], size=1000, buckets=4)
    changed = spark.createDataFrame([("a", 10), ("b", 11), ("b", 10), ("a", 2500)], "client string, id long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = keyed_log.versions_of(spark, name, changed, ["client", "id"], 1000)
        plan = plan_of(found)
        assert values(found, "client", "id", "v") == [("a", 10, 1), ("a", 10, 2), ("a", 2500, 1), ("a", 2500, 2), ("b", 11, 1), ("b", 11, 2)]
        read = found.inputFiles()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1  # the changed keys, not the log
    assert "PartitionFilters: [key_range" in plan and plan.count("SortMergeJoin") == 1
    assert 0 < len(read) < len(spark.table(name).inputFiles()) / 4
    assert keyed_log.versions_of(spark, name, changed.limit(0), ["client", "id"], 1000).count() == 0
    spark.sql(f"DROP TABLE {name}")


def test_sketches_merge_to_a_close_estimate(spark):
    rows = spark.range(60_000).selectExpr("id % 30 AS day", "id % 3 AS k", "IF(id % 7 = 0, NULL, id % 9000) AS user")
    stored = sketches.distinct_sketches(rows, ["k", "day"], "user")
    exact = {r.k: r.n for r in rows.groupBy("k").agg(F.count_distinct("user").alias("n")).collect()}
    for r in sketches.merged_estimate(stored, ["k"]).collect():
        assert abs(r.distinct - exact[r.k]) < 0.06 * exact[r.k]


# --- posted requests and batches -------------------------------------------------------------


def test_posted_requests_are_all_or_nothing(spark, frame, tmp_path):
    path = str(tmp_path / "posted")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("day", T.DateType())])
    requests = frame("request_id string, body string", ("good", '[{"id": 1, "name": "a", "day": "2020-01-02"}, {"id": 2, "name": "b", "more": 1}]'),
                     ("lacks", '[{"id": 3, "name": "c"}, {"id": 4}]'), ("wrong", '[{"id": "x", "name": "d"}]'), ("broken", '[{"id": 5'), ("empty", "[]"), ("null", None))
    out = writers.append_posted(requests, schema, path, ["id", "name"], client=F.lit("acme"))
    assert values(out, "request_id", "records", "fault") == sorted([
        ("good", 2, None), ("lacks", 2, "no name"), ("wrong", 1, "id is no bigint"), ("broken", 0, "no array of records"), ("empty", 0, None),
        ("null", 0, "no array of records")], key=str)
    assert values(spark.read.parquet(path).selectExpr("request_id", "id", "name", "CAST(day AS STRING) AS day", "client")) == [
        ("good", 1, "a", "2020-01-02", "acme"), ("good", 2, "b", None, "acme")]


def test_batches_by_characters(spark, frame, tmp_path):
    rows = [(k, "x" * (k * 7 % 40)) for k in range(200)] + [(200, "y" * 500), (201, None)]
    out = writers.append_batches(frame("k long, t string", *rows), str(tmp_path / "b"), ["k"], 100).collect()
    assert sum(r.rows for r in out) == 202
    assert sum(r.characters for r in out) == sum(len(str(k)) + len(t or "") for k, t in rows)
    assert all(r.characters <= 100 or r.rows == 1 for r in out) and max(r.characters for r in out) == 503
    assert spark.read.parquet(str(tmp_path / "b")).count() == 202


def test_ranges_of_a_log_follow_its_keys(spark):
    log = lambda n: spark.range(n).withColumnRenamed("id", "key")
    assert keyed_log.range_size(log(0), "key", 2000) == 2000
    assert keyed_log.range_size(log(10_000), "key", 2000) == 2000
    size = keyed_log.range_size(log(3_000_000), "key", 2000)
    assert 2_999_999 // size + 1 <= keyed_log.RANGES + 1
