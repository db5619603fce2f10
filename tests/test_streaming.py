import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F, types as T

from conftest import values
from test_conform import KEYS, encrypted
from weirflow.operators.versions import newest
from weirflow.sources.writers import read_keyed
from weirflow.catalog import flows
from weirflow.streaming.ingest import ingest_changes, text_schema, upsert_stream
from weirflow.streaming.numbered import ingest_numbered, numbered_files
from weirflow.streaming.state import newest_by_state, write_updates

TARGET = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("at", T.TimestampNTZType()), T.StructField("gone", T.DateType()),
    T.StructField("items", T.ArrayType(T.StructType([T.StructField("day", T.DateType())]))),
])


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None
    return query


def lake(spark, path):
    return spark.read.parquet(path)


def test_text_schema_reaches_nested_dates():
    assert text_schema(TARGET)["items"].dataType.elementType["day"].dataType == T.StringType()


def test_plain_and_encrypted_files_arrive_once_and_are_archived(spark, tmp_path):
    folder, archive = tmp_path / "in", tmp_path / "done"
    folder.mkdir()
    out, ckpt = str(tmp_path / "lake"), str(tmp_path / "ckpt")
    (folder / "cdc-1").write_text(encrypted(spark, KEYS[1], '{"id": 1, "at": "2020-01-02T03:04:05Z", "gone": "0000-00-00", "items": [{"day": "2020-01-01"}]}') + "\n")
    (folder / "other-1").write_text("not ours\n")
    start = lambda: run(ingest_changes(spark, str(folder), out, TARGET, ckpt, lambda: "2020-05-01 00:00:00", keys=KEYS[:2], prefix="cdc", archive=str(archive)))
    start()
    row = lake(spark, out).first()
    assert (row.id, row.at, row.gone, row["items"][0].day) == (1, dt.datetime(2020, 1, 2, 3, 4, 5), None, dt.date(2020, 1, 1))
    assert row.ingestion_timestamp == dt.datetime(2020, 5, 1)
    start()
    assert lake(spark, out).count() == 1
    (folder / "cdc-2").write_text(encrypted(spark, KEYS[0], '{"id": 2}') + "\n")
    start()
    assert values(lake(spark, out), "id") == [(1,), (2,)]
    start()
    assert not (folder / "cdc-1").exists() and list(archive.rglob("cdc-1"))
    assert (folder / "other-1").exists()


def test_bad_lines_fail_or_go_to_the_rejects(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "cdc-1").write_text('{"id": 1, "at": "2020-01-02T03:04:05Z"}\n{"id": 2, "at": "soon"}\n{"id": 3,\n\n{"id": "x"}\n')
    out, bad = str(tmp_path / "lake"), str(tmp_path / "bad")
    start = lambda name, **more: ingest_changes(spark, str(folder), out + name, TARGET, str(tmp_path / name), lambda: "2020-05-01 00:00:00", **more)
    run(start("a", rejects=bad))
    assert values(lake(spark, out + "a"), "id") == [(1,)]
    rows = {(r.id, r._broken_line, tuple(r._faults)) for r in lake(spark, bad).collect()}
    assert (2, None, ("at",)) in rows and len(rows) == 3 and {b for _, b, _ in rows} == {None, '{"id": 3,', '{"id": "x"}'}
    query = start("b")
    try:
        query.awaitTermination(120)
    except Exception:
        pass
    assert query.exception() is not None


SCHEMA = "client_partition_id long, id long, n long, v string"


def test_upsert_stream_equals_the_batch_result(spark, tmp_path):
    feed, table = tmp_path / "feed", str(tmp_path / "table")
    rows = [(1, 1, 1, "a"), (1, 2, 1, "b"), (2, 3, 5, "c"), (1, 1, 3, "d"), (2, 3, 4, "late"), (1, 4, 1, "e"), (1, 2, 2, "f")]
    everything = spark.createDataFrame(rows, SCHEMA)
    # three batches; the older version of 3 arrives after the newer one
    for part in (rows[:3], rows[3:5], rows[5:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(feed))
        changes = spark.readStream.schema(SCHEMA).parquet(str(feed))
        run(upsert_stream(changes, table, ["client_partition_id", "id"], ["n"], str(tmp_path / "ckpt"), str(tmp_path / "work")))
    want = newest(everything, ["client_partition_id", "id"], ["n"])
    columns = ["client_partition_id", "id", "n", "v"]
    assert values(read_keyed(spark, table), *columns) == values(want, *columns)


def test_driver_events_as_a_stream(spark, tmp_path):
    """The newest event per user, streamed file by file, against the batch operator."""
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        (F.col("user_id") % 5).alias("client_partition_id"), "user_id", "event_id", "event_type")
    feed, table = str(tmp_path / "feed"), str(tmp_path / "table")
    events.repartition(3).write.parquet(feed)
    changes = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(feed)
    run(upsert_stream(changes, table, ["client_partition_id", "user_id"], ["event_id"], str(tmp_path / "c"), str(tmp_path / "w")))
    want = newest(events, ["client_partition_id", "user_id"], ["event_id"])
    columns = ["user_id", "event_id", "event_type"]
    assert values(read_keyed(spark, table), *columns) == values(want, *columns)


def test_lines_no_key_fits_go_to_the_rejects(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lost = encrypted(spark, KEYS[2], '{"id": 2}')
    (folder / "cdc-1").write_text(encrypted(spark, KEYS[0], '{"id": 1}') + "\n" + lost + "\nno hex at all\n")
    out, bad = str(tmp_path / "lake"), str(tmp_path / "bad")
    start = lambda name, **more: ingest_changes(spark, str(folder), out + name, TARGET, str(tmp_path / name), lambda: "2020-05-01 00:00:00", keys=KEYS[:2], **more)
    run(start("a", rejects=bad))
    assert values(lake(spark, out + "a"), "id") == [(1,)]
    assert {r._broken_line for r in lake(spark, bad).collect()} == {lost, "no hex at all"}
    query = start("b")
    try:
        query.awaitTermination(120)
    except Exception:
        pass
    assert query.exception() is not None


def test_files_come_in_the_order_of_their_numbers(spark, tmp_path):
    folder, out, marks = tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "marks")
    folder.mkdir()
    add = lambda number, *ids: (folder / f"cdc-{number}").write_text("".join(f'{{"id": {i}}}\n' for i in ids))
    # the newest file has the smallest number, and 9 comes before 10
    for number in (12, 10, 9, 2):
        add(number, number * 100, number * 100 + 1)
    (folder / "cdc-7.gz").write_bytes(gzip.compress(b'{"id": 700}\n'))
    (folder / "other-1").write_text("not ours\n")
    (folder / "cdc-none").write_text("no number\n")
    assert [n for n, _ in numbered_files(str(folder), "cdc")] == [2, 7, 9, 10, 12]
    start = lambda: ingest_numbered(spark, str(folder), out, TARGET, marks, lambda: "2020-05-01 00:00:00", prefix="cdc", files_per_batch=2)
    assert start() == 3
    assert values(lake(spark, out), "batch_id", "id") == sorted(
        [(0, 200), (0, 201), (0, 700), (1, 900), (1, 901), (1, 1000), (1, 1001), (2, 1200), (2, 1201)], key=str)
    assert start() == 0
    add(13, 1300)
    add(1, 100)  # a number that was passed already: not read again
    assert start() == 1
    assert values(lake(spark, out).filter("batch_id > 2"), "batch_id", "id") == [(3, 1300)]


def test_a_failed_batch_is_read_again_and_nothing_twice(spark, tmp_path):
    folder, out, marks = tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "marks")
    folder.mkdir()
    (folder / "cdc-1").write_text('{"id": 1}\n')
    (folder / "cdc-2").write_text('{"id": \n')
    start = lambda: ingest_numbered(spark, str(folder), out, TARGET, marks, lambda: "2020-05-01 00:00:00", files_per_batch=1)
    with pytest.raises(Exception):
        start()
    assert values(lake(spark, out), "batch_id", "id") == [(0, 1)]
    (folder / "cdc-2").write_text('{"id": 2}\n')
    (folder / "cdc-3").write_text('{"id": 3}\n')
    start()
    assert values(lake(spark, out), "batch_id", "id") == [(0, 1), (1, 2), (2, 3)]


STATE = "k string, at timestamp_ntz, n long, v string"


def state_run(spark, tmp_path, rows, lateness="1000 days", keep="1000 days"):
    feed = str(tmp_path / "feed")
    spark.createDataFrame(rows, STATE).coalesce(1).write.mode("append").parquet(feed)
    stream = spark.readStream.schema(STATE).option("maxFilesPerTrigger", 1).parquet(feed)
    updates = newest_by_state(stream, ["k"], ["at", "n"], "at", lateness, keep)
    return run(write_updates(updates, str(tmp_path / "table"), str(tmp_path / "marks")))


def on(day):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=day)


def test_state_keeps_the_newest_version_over_batches_and_restarts(spark, tmp_path):
    batches = [
        [("a", on(3), 1, "a3"), ("a", on(1), 9, "a1"), ("b", on(2), 1, "b2"), ("b", on(2), None, "null is older"), ("c", None, 5, "no time")],
        [("a", on(2), 9, "late"), ("b", on(2), 2, "b2 again"), (None, on(1), 1, "null key")],
        [("a", on(9), None, None), ("c", on(1), 1, "c1"), ("b", on(2), 2, "b2 again")],
    ]
    for rows in batches:  # each start goes on from the checkpoint
        state_run(spark, tmp_path, rows)
    everything = spark.createDataFrame([r for rows in batches for r in rows], STATE)
    out = spark.read.parquet(str(tmp_path / "table"))
    columns = ["k", "at", "n", "v"]
    assert values(newest(out.drop("batch_id"), ["k"], ["at", "n"]), *columns) == values(newest(everything, ["k"], ["at", "n"]), *columns)
    # an older version never comes out, and an equal one not again
    assert {r.v for r in out.collect()} == {"a3", "b2", "no time", "b2 again", "null key", None, "c1"}
    assert out.filter("v = 'b2 again'").count() == 1


def test_state_lets_old_keys_go(spark, tmp_path):
    state_run(spark, tmp_path, [("old", on(0), 1, "x"), ("young", on(60), 1, "y")], "1 day", "10 days")
    query = state_run(spark, tmp_path, [("young", on(61), 1, "z")], "1 day", "10 days")
    query = state_run(spark, tmp_path, [("young", on(62), 1, "w")], "1 day", "10 days")
    left = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert left[-1] == 1
    assert spark.read.parquet(str(tmp_path / "table")).filter("k = 'old'").count() == 1


def test_state_is_called_once_for_many_keys(spark, tmp_path):
    big = 2**62
    for n in range(2):
        rows = [(f"k{i}" if i else None, on(i % 7 + n) if i % 11 else None, big + i if i % 5 else None, str(n)) for i in range(2000)]
        query = state_run(spark, tmp_path, rows)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 256
    out = spark.read.parquet(str(tmp_path / "table")).filter("v = '1'")
    # a key's own null, whole numbers beside nulls as they are, and every key's second version; without a time the text decides
    assert values(out, "k", "at", "n", "v") == values(spark.createDataFrame(rows, STATE))


def test_state_drops_a_key_beside_one_that_stays(spark, tmp_path):
    run_one = lambda rows: run(write_updates(newest_by_state(
        spark.readStream.schema(STATE).option("maxFilesPerTrigger", 1).parquet(rows), ["k"], ["at", "n"], "at", "100 days", "10 days", 1),
        str(tmp_path / "table"), str(tmp_path / "marks")))
    feed = str(tmp_path / "feed")
    for batch in ([("old", on(0), 1, "x"), ("young", on(150), 1, "y")], [("young", on(151), 1, "z")], [("old", on(60), 0, "again"), ("young", on(150), 1, "late")]):
        spark.createDataFrame(batch, STATE).coalesce(1).write.mode("append").parquet(feed)
        run_one(feed)
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "table")).orderBy("batch_id", "k").select("k", "v").collect() if r] == [
        ("old", "x"), ("young", "y"), ("young", "z"), ("old", "again")]


def test_a_feed_has_a_file_for_each_share_of_its_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(flows, "ROWS_PER_FILE", 100)
    folder = str(tmp_path / "feed")
    files = flows.feed([spark.range(350), spark.range(350, 700), spark.range(700, 1020)], folder)
    rows = spark.read.parquet(folder).groupBy(F.input_file_name()).count().collect()
    assert files == 4 and len(rows) == 12 and sum(r[1] for r in rows) == 1020 and max(r[1] for r in rows) < 200
    monkeypatch.undo()
    assert flows.feed([spark.range(10), spark.range(0)], str(tmp_path / "small")) == 1
