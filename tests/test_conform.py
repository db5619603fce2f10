import base64
import datetime as dt
import gzip
from decimal import Decimal

from pyspark.sql import functions as F, types as T

from conftest import values
from weirflow.functions import conform
from weirflow.functions.codecs import compress_long, decrypt_line, decrypt_lines_or_fail, gunzip, inflate

import pytest

NTZ = T.TimestampNTZType()


def test_zero_dates_at_every_depth(frame):
    df = frame("a string, l array<struct<d: string, deep: array<struct<d: string>>>>",
               ("0000-00-00 00:00:00", [("0000-00-00", [("0000-00-00",), ("2020-01-01",)])]))
    row = conform.zero_dates_to_null(df).first()
    assert row.a is None and row.l[0].d is None
    assert [e.d for e in row.l[0].deep] == [None, "2020-01-01"]


def test_zero_date_inside_a_text_is_kept_unless_legacy(frame):
    df = frame("a string", ("see 0000-00-00",))
    assert values(conform.zero_dates_to_null(df)) == [("see 0000-00-00",)]
    assert values(conform.zero_dates_to_null(df, legacy=True)) == [(None,)]


def test_only_a_whole_zero_date_is_null(frame):
    kept = ["0000-00-00 call back", "call 0000-00-00", "0000-00-00-1", "0000-00-00 10:00"]
    zero = ["0000-00-00", "0000-00-00 00:00", "0000-00-00T00:00:00Z", "0000-00-00 00:00:00.000000+00:00", "0000-00-00 00:00:00 UTC"]
    df = frame("a string", *[(t,) for t in kept + zero])
    for out in (conform.zero_dates_to_null(df), conform.stringify_dates(df)):
        assert sorted(r.a for r in out.collect() if r.a is not None) == sorted(kept)
    assert {r.a for r in conform.stringify_dates(df, legacy=True).collect()} == {None}


def test_stringify_nested_dates(frame):
    df = frame("d date, t timestamp_ntz, l array<struct<t: timestamp_ntz>>",
               (dt.date(2020, 1, 2), dt.datetime(2020, 1, 2, 3, 4, 5), [(dt.datetime(2020, 1, 1),)]))
    out = conform.stringify_dates(df, time_format="yyyy-MM-dd HH:mm:ss.SSSSSS").first()
    assert (out.d, out.t, out.l[0].t) == ("2020-01-02", "2020-01-02 03:04:05.000000", "2020-01-01 00:00:00.000000")


def test_parse_by_target_type(frame):
    target = T.StructType([
        T.StructField("day", T.DateType()), T.StructField("local", NTZ), T.StructField("zoned", T.TimestampType()),
        T.StructField("items", T.ArrayType(T.StructType([T.StructField("at", NTZ)]))),
    ])
    df = frame("day string, local string, zoned string, items array<struct<at: string>>, other string",
               ("2019-04-30T23:00:00-07:00", "2019-04-30T10:11:12Z", "2019-04-30T10:11:12Z", [("2019-01-01 00:00:01",), ("junk",)], "x"),
               ("junk", None, "0000-00-00", None, "y"))
    rows = conform.parse_dates(df, target, rejects="bad").orderBy("other").collect()
    assert rows[0].day == dt.date(2019, 4, 30) and rows[0].local == dt.datetime(2019, 4, 30, 10, 11, 12)
    assert [i.at for i in rows[0]["items"]] == [dt.datetime(2019, 1, 1, 0, 0, 1), None]
    assert rows[0].zoned is not None and rows[0].bad == []
    assert rows[1].day is None and rows[1].zoned is None and rows[1].bad == ["day"]


def test_decimals_nulls_and_booleans(frame):
    df = frame("d decimal(10,2), l array<struct<d: decimal(10,2)>>, b boolean, n string", (Decimal("1.50"), [(Decimal("2.00"),)], True, None))
    out = conform.stringify_decimals(df).first()
    assert out.d == "1.50" and out.l[0].d == "2.00"
    assert conform.booleans_to_ints(df.select("b")).first().b == 1
    assert values(conform.nulls_to_empty(df.select("d", "n"))) == [("1.50", "")]


def test_conform_adds_orders_casts_and_drops(frame):
    target = T.StructType([T.StructField("b", T.LongType()), T.StructField("new", T.StringType()), T.StructField("a", T.IntegerType())])
    out = conform.conform(frame("a string, b int, extra int", ("7", 1, 0), ("x", 2, 0)), target)
    assert out.schema.fieldNames() == ["b", "new", "a"]
    assert values(out) == [(1, None, 7), (2, None, None)]
    with pytest.raises(Exception):
        conform.conform(frame("a string", ("x",)), target, strict=True).collect()


def test_schema_changes():
    base = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("z", T.StringType())])
    added = conform.insert_column(base, T.StructField("m", T.StringType()), after="id")
    assert added.fieldNames() == ["id", "m", "z"]
    assert conform.insert_column(added, T.StructField("m", T.LongType())) == added
    assert conform.relax(base, "id")["id"].nullable
    version = T.StructType([T.StructField("event_eid", T.StringType(), False), T.StructField("id", T.StringType(), False)])
    assert conform.with_version_columns(base, version).fieldNames() == ["id", "z", "event_eid"]


def test_missing_required(frame):
    target = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.LongType())])
    df = frame("a long, b long", (1, None), (None, 1))
    assert values(df.filter(conform.missing_required(df, target))) == [(None, 1)]


# --- codecs ----------------------------------------------------------------------------------


def test_long_text_round_trip(frame):
    long = "words and more " * 200
    df = frame("t string", (long,), ("short",), (None,))
    packed = df.select("t", compress_long(F.col("t")).alias("p"))
    assert values(packed.filter("t is null or length(t) < 10"), "p") == [(None,), ("short",)]
    assert values(packed.filter("length(t) > 1000").select(inflate(F.col("p")))) == [(long,)]
    assert packed.filter("length(t) > 1000 and length(p) >= length(t)").count() == 0


def test_gunzip_or_same(frame):
    text = base64.b64encode(gzip.compress("hé".encode())).decode()
    assert values(frame("t string", (text,), ("plain",), (None,)).select(gunzip(F.col("t")))) == [(None,), ("hé",), ("plain",)]


KEYS = [base64.b64encode(bytes([n]) * 32).decode() for n in (3, 4, 5)]


def encrypted(spark, key, text):
    body = bytearray(gzip.compress(text.encode()))
    iv = bytes(range(16))
    df = spark.createDataFrame([(body, bytearray(iv))], "body binary, iv binary")
    out = df.select(F.hex(F.aes_encrypt("body", F.unbase64(F.lit(key)), F.lit("CBC"), F.lit("PKCS"), "iv")).alias("h")).first().h
    return f"{iv.hex()}:{out[32:].lower()}"


def test_wrong_key_first_right_key_second(spark, frame):
    line = encrypted(spark, KEYS[1], '{"id": 1}')
    df = frame("l string", (line,))
    assert values(df.select(decrypt_line(F.col("l"), KEYS[:2]))) == [('{"id": 1}',)]
    assert values(df.select(decrypt_line(F.col("l"), [KEYS[0], KEYS[2]]))) == [(None,)]
    with pytest.raises(Exception, match="no key"):
        df.select(decrypt_lines_or_fail(F.col("l"), [KEYS[0]])).collect()
