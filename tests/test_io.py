import datetime as dt
import gzip
import json
import sys

import pytest
from hypothesis import given, settings, strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

from conftest import values
from weirflow.functions.dates import ts
from weirflow.plans.scores import export_people, import_scores
from weirflow.sources import readers, writers
from weirflow.sources.lookup import batched_lookup


# executors get these functions by value: the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

def test_read_wants_a_table_or_a_query(spark):
    for args in ({}, {"query": "select 1", "table": "t"}):
        with pytest.raises(ValueError):
            readers.read(spark, **args)
    assert readers.read(spark, query="select 1 AS a").first().a == 1


def test_read_table_by_name_and_path(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert readers.read(spark, table=path).count() == 3
    writers.create_table_as(spark.range(4), "made")
    assert readers.read(spark, table="made").count() == 4
    writers.create_table_as(spark.range(2), "made")
    assert readers.read(spark, table="made").count() == 2


def test_file_order_and_filter(frame):
    df = frame("p string", ("in/a-10",), ("in/a-2",), ("in/b-1",), ("in/a-x",), ("in/a-3.tmp",))
    out = readers.select_files(df, "p", "a-").orderBy("file_seq", "p")
    assert [(r.p, r.file_seq) for r in out.collect()] == [("in/a-3.tmp", None), ("in/a-x", None), ("in/a-2", 2), ("in/a-10", 10)]
    assert values(readers.select_files(df, "p", "a", "x"), "p") == [("in/a-x",)]


def test_lines_and_json(spark, tmp_path):
    (tmp_path / "a-1").write_text('{"id": 1, "v": "x"}\nbroken\n')
    (tmp_path / "a-2.gz").write_bytes(gzip.compress(b'{"id": 2, "v": "y"}\n'))
    (tmp_path / "b-1").write_text("other\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    lines = readers.read_lines(spark, str(tmp_path), "a")
    assert values(lines, "file", "file_seq") == [("a-1", 1), ("a-1", 1), ("a-2.gz", None)]
    parsed = readers.parse_json(lines, schema, rejects="bad")
    assert values(parsed, "id", "v", "bad") == [(None, None, "broken"), (1, "x", None), (2, "y", None)]
    with pytest.raises(Exception):
        readers.parse_json(lines, schema).collect()
    assert values(readers.read_json_lines(spark, str(tmp_path / "a-2.gz"), schema)) == [(2, "y")]


@settings(max_examples=20, deadline=None)
@given(st.sets(st.integers(min_value=-50, max_value=200), max_size=12), st.integers(min_value=1, max_value=40))
def test_key_ranges_cover_without_gap_or_overlap(spark, ids, batch):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    ranges = [tuple(r) for r in readers.key_ranges(df, "id", batch).orderBy("low").collect()]
    if not ids:
        assert ranges == []
        return
    covered = [i for low, high in ranges for i in range(low, high + 1)]
    assert covered == list(range(min(ids), max(ids) + 1))


def test_profile(frame):
    df = frame("at timestamp_ntz", (dt.datetime(2020, 1, 1),), (dt.datetime(2020, 1, 3),))
    assert values(readers.profile([("a", df, "at"), ("b", df, None)])) == [("a", 2, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 3)), ("b", 2, None, None)]


# --- writers ---------------------------------------------------------------------------------

TARGET = T.StructType([T.StructField("client_partition_id", T.LongType()), T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])


def test_append_conforms_and_partitions(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    writers.append(frame("id string, client_partition_id int, extra int", ("7", 1, 0)), path, TARGET)
    writers.append(frame("v string, id long, client_partition_id long", ("x", 8, 2)), path, TARGET)
    back = spark.read.schema(TARGET).parquet(path)
    assert values(back, "client_partition_id", "id", "v") == [(1, 7, None), (2, 8, "x")]
    assert (tmp_path / "t" / "client_partition_id=1").is_dir()
    plan = back.filter("client_partition_id = 1")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(client_partition_id" in plan


def test_append_existing_never_creates(spark, frame):
    with pytest.raises(ValueError):
        writers.append_existing(frame("id long", (1,)), "nowhere")
    writers.create_table_as(frame("id long, v string", (1, "a")), "there")
    writers.append_existing(frame("v string, id int", ("b", 2)), "there")
    assert values(spark.table("there"), "id", "v") == [(1, "a"), (2, "b")]


def test_recreate_and_rows_per_file(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.recreate(spark.range(5), path)
    writers.recreate(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2
    many = str(tmp_path / "m")
    writers.append(spark.range(100).coalesce(1), many, rows_per_file=30)
    assert len(list((tmp_path / "m").glob("*.parquet"))) == 4


def test_export_is_one_folder_per_client(spark, frame, tmp_path):
    columns = ", ".join(f"{c} string" for c in ["client", "first_name", "last_name", "email", "email2", "email3", "phone", "phone2", "phone3", "twitter", "city", "state", "zip", "country"])
    rows = [(c, n, None, 'say "hi"', *["x"] * 10) for c, n in (("a", "ann"), ("a", "bob"), ("b", "cy"))]
    df = frame(columns + ", ingestion_timestamp timestamp_ntz", *[(*r, dt.datetime(2020, 1, d)) for d, r in enumerate(rows, 1)])
    out = tmp_path / "out"
    export_people(df, "contacts", str(out), "2020-01-01 00:00:00", "2020-01-03 00:00:01")
    assert sorted(p.name for p in out.glob("client=*")) == ["client=a", "client=b"]
    texts = [gzip.decompress(p.read_bytes()).decode().splitlines() for p in (out / "client=b").glob("*.csv.gz")]
    lines = [t for t in texts if t][0]
    assert lines[0].startswith('"first_name","last_name"') and "client" not in lines[0]
    assert lines[1].startswith('"cy","","say \\"hi\\""')
    with pytest.raises(ValueError):
        export_people(df, "strangers", str(out))


def test_booleans_and_dates_in_an_export(spark, frame, tmp_path):
    df = frame("client string, ok boolean, day date, amount decimal(5,2)", ("a", True, dt.date(2020, 1, 2), None))
    writers.export_csv_per_client(df, str(tmp_path / "o"), ["ok", "day", "amount"])
    text = gzip.decompress(next((tmp_path / "o" / "client=a").glob("*.gz")).read_bytes()).decode()
    assert text.splitlines() == ['"ok","day","amount"', '"1","2020-01-02",""']


def test_json_export(spark, frame, tmp_path):
    writers.export_json(frame("id long, v string", (1, "x")), str(tmp_path / "j"))
    files = list((tmp_path / "j").glob("*.json.gz"))
    assert [json.loads(l) for f in files for l in gzip.decompress(f.read_bytes()).decode().splitlines()] == [{"id": 1, "v": "x"}]


# --- score lookup ----------------------------------------------------------------------------


def fetch_ok(ids):
    assert len(ids) <= 3
    return 200, [{"entity_id": i, "acme": len(i), "beta": 9} for i in ids]


def test_lookup_in_batches(spark):
    ids = spark.range(20).selectExpr("CONCAT('e', id) AS entity_id")
    out = batched_lookup(ids.union(ids), fetch_ok, batch_size=3, partitions=2)
    assert out.count() == 20


@pytest.mark.parametrize("code", [102, 204, 402])
def test_codes_without_rows(spark, code):
    ids = spark.range(2).selectExpr("CONCAT('e', id) AS entity_id")
    assert batched_lookup(ids, lambda batch: (code, [{"entity_id": "no"}])).count() == 0


def test_other_codes_fail(spark):
    ids = spark.range(2).selectExpr("CONCAT('e', id) AS entity_id")
    with pytest.raises(Exception, match="status 500"):
        batched_lookup(ids, lambda batch: (500, [])).collect()


def test_import_scores(frame):
    at = dt.datetime(2020, 1, 1)
    entities = frame("entity_id string, ingestion_timestamp timestamp_ntz", ("e1", at), ("e22", at), ("old", at - dt.timedelta(days=9)))
    scored = frame("entity_id string", ("e1",))
    args = (entities, scored, fetch_ok)
    match = import_scores(*args, "match-score", ts(at), 24, "2020-01-01 01:00:00", batch_size=3).collect()
    assert [(r.entity_id, sorted(tuple(s) for s in r.scores)) for r in match] == [("e22", [("acme", 3), ("beta", 9)])]
    level = import_scores(*args, "lcv-level", ts(at), 24, "2020-01-01 01:00:00", batch_size=3, fields="acme long").first()
    assert (level.entity_id, level.acme) == ("e22", 3)
