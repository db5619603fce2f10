import datetime as dt

from pyspark.sql import functions as F

from conftest import values
from weirflow.functions.dates import ts
from weirflow.operators import increments as inc
from weirflow.operators.versions import (
    close_and_open, insert_missing, newest, recent_open, replace_into, update_from, update_where,
)
from weirflow.sources.writers import upsert_partitions


def at(n):
    return dt.datetime(2020, 1, 1) + dt.timedelta(hours=n)


LOG = "client string, id long, event_eid string, ingestion_timestamp timestamp_ntz, v string"


def test_newest_by_event_then_time(frame):
    log = frame(LOG, ("a", 1, "z/1", at(5), "old"), ("a", 1, "z/2", at(1), "mid"), ("a", 1, "z/2", at(2), "new"), ("b", 1, "z/0", at(0), "only"))
    assert values(newest(log, ["client", "id"], ["event_eid", "ingestion_timestamp"]), "client", "v") == [("a", "new"), ("b", "only")]


def test_newest_prunes_before_the_shuffle(spark, frame):
    df = newest(frame(LOG, ("a", 1, "z", at(0), "x")), ["client", "id"], ["event_eid"])
    assert "WindowGroupLimit" in df._jdf.queryExecution().toString()


def test_replace_into_takes_the_last_change(frame):
    target = frame("id long, v string", (1, "a"), (2, "b"))
    changes = frame("id long, v string, n long", (2, "c", 1), (2, "d", 2), (3, "e", 1))
    assert values(replace_into(target, changes, ["id"], ["n"])) == [(1, "a"), (2, "d"), (3, "e")]
    assert values(insert_missing(target, changes.drop("n"), ["id"])) == [(3, "e")]


def test_replace_into_twice_changes_nothing(frame):
    target = frame("id long, v string", (1, "a"))
    changes = frame("id long, v string", (1, "b"), (2, "c"))
    once = replace_into(target, changes, ["id"])
    assert values(replace_into(once, changes, ["id"])) == values(once)


def test_update_from_and_where(frame):
    target = frame("id long, type string, open boolean", (1, "x", True), (2, "x", False), (3, "x", True))
    source = frame("id long, type string", (1, "T"), (2, "T"))
    out = update_from(target, source, ["id"], {"type": F.concat("src_type", F.col("id").cast("string"))}, only=F.col("open"))
    assert values(out, "id", "type") == [(1, "T1"), (2, "x"), (3, "x")]
    assert values(update_where(target, F.col("id") > 2, {"type": F.lit("y")}), "id", "type") == [(1, "x"), (2, "x"), (3, "y")]


HISTORY = "client string, file string, table string, status string, start_date timestamp_ntz, end_date timestamp_ntz"


def test_close_and_open(frame):
    history = frame(HISTORY, ("a", "f1", "t", "running", at(0), None), ("a", "f2", "t", "running", at(0), None), ("a", "f3", "t", "done", at(0), at(1)))
    states = frame("file string, status string", ("f1", "SUCCEEDED"), ("f2", "RUNNING"), ("f3", "FAILED"))
    out = close_and_open(history, states, ts(at(9)), ["file"])
    assert values(out, "file", "status", "start_date", "end_date") == sorted([
        ("f1", "running", at(0), at(9)), ("f1", "succeeded", at(9), None), ("f2", "running", at(0), None), ("f3", "done", at(0), at(1))], key=str)
    again = close_and_open(out, states, ts(at(10)), ["file"])
    assert values(again) == values(out)


def test_recent_open_counts_hour_changes(frame):
    h = frame(HISTORY, ("a", "f1", "t", "running", dt.datetime(2020, 1, 1, 0, 59), None), ("a", "f2", "t", "running", dt.datetime(2019, 12, 31, 23, 59), None),
              ("a", "f3", "t", "running", at(1), at(2)), ("a", "f4", "t", "done", at(1), None))
    assert values(recent_open(h, ts(at(2)), 2), "file") == [("f1",)]


def test_upsert_rewrites_only_touched_partitions(spark, frame, tmp_path):
    path, work = str(tmp_path / "t"), str(tmp_path / "w")
    frame("client_partition_id long, id long, v string, n long", (1, 1, "a", 1), (1, 2, "b", 1), (2, 1, "c", 1)).write.partitionBy("client_partition_id").parquet(path)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "client_partition_id=2").iterdir()}
    changes = frame("client_partition_id long, id long, v string, n long", (1, 2, "B", 2), (1, 3, "D", 2))
    for _ in range(2):
        upsert_partitions(spark, path, changes, ["client_partition_id", "id"], ["n"], work)
        assert values(spark.read.parquet(path), "client_partition_id", "id", "v") == [(1, 1, "a"), (1, 2, "B"), (1, 3, "D"), (2, 1, "c")]
    assert before == {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "client_partition_id=2").iterdir()}


# --- windows and checkpoints -----------------------------------------------------------------


def test_windows_meet_without_gap_or_overlap(frame):
    df = frame("ingestion_timestamp timestamp_ntz", *[(at(n),) for n in range(6)])
    parts = [inc.in_window(df, str(at(a)), str(at(b))).count() for a, b in ((0, 2), (2, 3), (3, 6))]
    assert parts == [2, 1, 3]
    assert inc.in_window(df, str(at(0)), str(at(2)), closed="both").count() == 3
    assert inc.in_window(df, str(at(0)), str(at(2)), closed="left_open").count() == 2


def test_changed_keys_reach_all_versions(frame):
    orders = frame("client string, id long, ingestion_timestamp timestamp_ntz", ("a", 1, at(0)), ("a", 1, at(5)), ("a", 2, at(0)), ("a", 3, at(0)))
    items = frame("client string, id long, order_id long, ingestion_timestamp timestamp_ntz", ("a", 70, 2, at(5)), ("a", 3, 9, at(5)))
    touched = inc.changed_keys(
        (inc.in_window(orders, str(at(4)), str(at(6))), {"client": "client", "order_id": "id"}),
        (inc.in_window(items, str(at(4)), str(at(6))), {"client": "client", "order_id": "order_id"}),
    )
    assert values(touched) == [("a", 1), ("a", 2), ("a", 9)]
    assert inc.all_versions_of(orders, touched, {"client": "client", "order_id": "id"}).count() == 3


def marks(frame, *rows):
    return frame(inc.CHECKPOINT_SCHEMA, *rows)


def source(frame, *hours):
    return frame("ingestion_timestamp timestamp_ntz", *[(at(h),) for h in hours])


US = dt.timedelta(microseconds=1)


def test_first_window_starts_in_1970(frame):
    w = inc.next_window(marks(frame), "j", "t", {"s": source(frame, 1, 2)}).first()
    assert w.first == dt.datetime(1970, 1, 1) and w.until == at(2) + US and w.has_data


def test_existing_mark_and_advance_by_a_microsecond(frame):
    table = marks(frame, ("j", "t", at(1)), ("j", "other", at(0)))
    w = inc.next_window(table, "j", "t", {"s": source(frame, 0, 2)})
    assert w.first().first == at(1)
    out = inc.advance(table, w)
    assert values(out, "target", "mark") == [("other", at(0)), ("t", at(2) + dt.timedelta(microseconds=1))]


def test_no_data_leaves_the_mark(frame):
    table = marks(frame, ("j", "t", at(9)))
    w = inc.next_window(table, "j", "t", {"s": source(frame, 1)})
    assert not w.first().has_data and w.first().until is None
    assert values(inc.advance(table, w)) == values(table)


def test_second_run_without_new_rows_has_nothing(frame):
    sources = {"s": source(frame, 1, 2)}
    after = inc.advance(marks(frame), inc.next_window(marks(frame), "j", "t", sources))
    assert not inc.next_window(after, "j", "t", sources).first().has_data
    later = {"s": source(frame, 1, 2, 3)}
    assert inc.next_window(after, "j", "t", later).first().until == at(3) + US


def test_overlap_reads_late_rows_again(frame):
    table = marks(frame, ("j", "t", at(5)))
    w = inc.next_window(table, "j", "t", {"s": source(frame, 4)}, overlap=dt.timedelta(hours=2)).first()
    assert w.first == at(3) and w.until == at(4) + US


def test_chained_windows_meet_every_row_once(frame):
    hours = [1, 1, 1, 2, 2, 3, 5, 5, 9]
    rows = frame("id long, ingestion_timestamp timestamp_ntz", *[(k, at(h)) for k, h in enumerate(hours)])
    table, seen, windows = marks(frame), [], 0
    while (w := inc.next_window(table, "j", "t", {"s": rows}, cap=2)).first().has_data:
        edge = w.first()
        seen += [r.id for r in inc.in_window(rows, str(edge["first"]), str(edge.until)).collect()]
        table, windows = frame(inc.CHECKPOINT_SCHEMA, *map(tuple, inc.advance(table, w).collect())), windows + 1
    assert sorted(seen) == list(range(len(hours))) and windows == 3


def test_cap_counts_distinct_pairs_and_keeps_ties(frame):
    base = dt.datetime(2020, 1, 1, 10, 0, 0)
    stamps = [base + dt.timedelta(microseconds=m) for m in (5, 5, 5, 7, 9)] + [base + dt.timedelta(hours=3)]
    one = frame("ingestion_timestamp timestamp_ntz", *[(s,) for s in stamps])
    two = frame("ingestion_timestamp timestamp_ntz", (stamps[0],))
    got = [inc.capped_last_mark({"one": one, "two": two}, inc.FIRST_MARK, cap=n) for n in (1, 2, 3, 4, 5, 9)]
    micros = [dt.datetime.fromisoformat(g).microsecond for g in got[:4]]
    assert micros == [5, 5, 7, 9]
    assert got[4] == got[5] == "2020-01-01 13:00:00"


def test_not_yet_scored(frame):
    e = frame("entity_id string, ingestion_timestamp timestamp_ntz", ("a", at(0)), ("a", at(1)), ("b", at(9)), ("c", at(9)))
    s = frame("entity_id string", ("c",))
    assert values(inc.not_yet_scored(e, s, ts(at(10)), 5)) == [("b",)]
