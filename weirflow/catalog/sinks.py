"""Each sink and source written and read back, on the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F, types as T

from weirflow.catalog import testbed as tb
from weirflow.catalog.testbed import comparable, sql, table
from weirflow.functions import fixed
from weirflow.functions.dates import ts
from weirflow.lineage import work_folder
from weirflow.operators.increments import has_rows
from weirflow.operators.positions import positions
from weirflow.operators.shares import by_rank_list
from weirflow.operators.versions import insert_missing, update_where
from weirflow.plans.refine import copy_to_lake, database_rows
from weirflow.plans.scores import export_people as export
from weirflow.plans.topics import play_log
from weirflow.sources import readers, writers

QUERIES: dict = {}


def register(name, sql_text):
    def add(fn):
        QUERIES[name] = (lambda spark, d: comparable(fn(spark, d)), sql_text)
        return fn
    return add


# texts that hold, begin with and are a zero date
NOTE = """CASE o_orderkey % 5 WHEN 0 THEN '0000-00-00 call back' WHEN 1 THEN 'seen 0000-00-00' WHEN 2 THEN '0000-00-00'
  WHEN 3 THEN '0000-00-00 00:00:00' ELSE o_orderpriority END"""
KEPT = """CASE o_orderkey % 5 WHEN 0 THEN '0000-00-00 call back' WHEN 1 THEN 'seen 0000-00-00' WHEN 2 THEN NULL WHEN 3 THEN NULL
  ELSE o_orderpriority END"""


def notes(spark, d):
    return table(spark, d, "orders").selectExpr(
        "o_orderkey AS id", "o_orderdate AS at", "CAST(o_orderdate AS DATE) AS day", "CAST(o_totalprice AS DECIMAL(18,2)) AS total",
        f"{NOTE} AS note")


@register("copy_to_lake", f"""SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS at,
  strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE AS total, {KEPT} AS note, 'acme' AS client,
  'z/0' AS event_eid, '{tb.AS_OF}' AS ingestion_timestamp FROM orders""")
def lake_copy(spark, d):
    return copy_to_lake(notes(spark, d), "acme", tb.AS_OF)


@register("database_rows", f"""SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS at,
  strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total, {KEPT} AS note FROM orders""")
def database(spark, d):
    return database_rows(notes(spark, d))


LEAD_TEXT = [c for c in fixed.LEAD_EXPORT_COLUMNS if c not in ("email", "zip", "city")]


@register("export_people", sql(tb.RAW_USERS, f"""SELECT client, email, CAST(tree_user_id AS VARCHAR) AS zip,
  CASE tree_user_id % 3 WHEN 0 THEN 'seen 0000-00-00' WHEN 1 THEN '' ELSE client_status END AS city,
  {', '.join(f"'' AS {c}" for c in LEAD_TEXT)} FROM raw_users
  WHERE created >= TIMESTAMP '1995-03-01' AND created < TIMESTAMP '1996-03-01'"""))
def export_leads(spark, d):
    """Leads of a window as one CSV folder per client, read back."""
    folder = work_folder(spark)
    rows = tb.raw_users(spark, d).selectExpr(
        "client", "email", "CAST(tree_user_id AS STRING) AS zip", "created AS ingestion_timestamp",
        "CASE tree_user_id % 3 WHEN 0 THEN 'seen 0000-00-00' WHEN 1 THEN '0000-00-00' ELSE client_status END AS city",
        *[f"CAST(NULL AS STRING) AS {c}" for c in LEAD_TEXT])
    export(rows, "leads", folder, "1995-03-01 00:00:00", "1996-03-01 00:00:00")
    schema = ", ".join(f"{c} string" for c in [*fixed.LEAD_EXPORT_COLUMNS, "client"])
    back = spark.read.schema(schema).option("header", True).option("escape", "\\").csv(folder)
    return back.select("client", *[F.coalesce(c, F.lit("")).alias(c) for c in fixed.LEAD_EXPORT_COLUMNS])


# --- sinks -----------------------------------------------------------------------------------

TARGET = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("client_partition_id", T.LongType()),
    T.StructField("total", T.DecimalType(18, 2)), T.StructField("extra", T.StringType()),
])


def _orders(spark, d):
    return table(spark, d, "orders").selectExpr(
        "o_orderkey % 5 AS client_partition_id", "CAST(o_orderkey AS STRING) AS id", "o_totalprice AS total", "o_orderpriority AS gone")


APPENDED = """SELECT o_orderkey AS id, o_orderkey % 5 AS client_partition_id,
  CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE AS total, CAST(NULL AS VARCHAR) AS extra FROM orders"""


@register("append_conformed", f"{APPENDED} UNION ALL {APPENDED}")
def append_conformed(spark, d):
    """Two appends by name to the target schema, partitioned by client."""
    folder = work_folder(spark)
    for _ in range(2):
        writers.append(_orders(spark, d), folder, TARGET)
    return spark.read.schema(TARGET).parquet(folder)


@register("rows_into_batches", "SELECT o_orderkey AS id, true AS within FROM orders")
def rows_into_batches(spark, d):
    """No file of a batched append holds more rows than asked for."""
    folder = work_folder(spark)
    writers.append(_orders(spark, d), folder, TARGET, rows_per_file=400)
    rows = spark.read.schema(TARGET).parquet(folder).select("id", F.col("_metadata.file_path").alias("file"))
    full = rows.groupBy("file").agg((F.count("*") <= 400).alias("within"))
    return rows.join(full, "file").select("id", "within")


def _name() -> str:
    return f"weirflow_{uuid.uuid4().hex}"


@register("append_existing", """SELECT o_orderkey AS id, o_totalprice AS total, CAST(NULL AS VARCHAR) AS note FROM orders
  UNION ALL SELECT c_custkey, c_acctbal, c_name FROM customer""")
def append_existing(spark, d):
    """A table created from one query takes rows of another shape by name; it has to exist."""
    name = _name()
    first = table(spark, d, "orders").selectExpr("o_orderkey AS id", "o_totalprice AS total", "CAST(NULL AS STRING) AS note")
    more = table(spark, d, "customer").selectExpr("c_name AS note", "CAST(c_custkey AS STRING) AS id", "c_acctbal AS total", "1 AS gone")
    try:
        writers.append_existing(more, name)
        raise AssertionError("a missing table was written to")
    except ValueError:
        writers.create_table_as(first, name)
    writers.append_existing(more, name)
    folder = work_folder(spark)
    spark.table(name).write.parquet(folder)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(folder)


@register("recreate", "SELECT c_custkey AS id, c_name AS name FROM customer")
def recreate(spark, d):
    """The second load replaces the first, other columns and all."""
    folder = work_folder(spark)
    writers.recreate(table(spark, d, "orders"), folder)
    writers.recreate(table(spark, d, "customer").selectExpr("c_custkey AS id", "c_name AS name"), folder)
    return spark.read.parquet(folder)


@register("export_json", """SELECT conv_id, turn::BIGINT AS turn, role, text FROM conversations""")
def export_json(spark, d):
    folder = work_folder(spark)
    rows = table(spark, d, "conversations").selectExpr("conv_id", "CAST(turn AS BIGINT) AS turn", "role", "text")
    writers.export_json(rows, folder)
    return readers.read_json_lines(spark, folder, rows.schema)


POSTED = T.StructType([T.StructField("id", T.LongType()), T.StructField("total", T.DoubleType()), T.StructField("note", T.StringType())])
#: twenty order numbers are a request; some records lack their id, some totals are no number
POSTS = """posts AS (SELECT o_orderkey // 20 AS request_id, o_orderkey AS id, o_totalprice AS total, o_orderpriority AS note,
  CASE WHEN o_orderkey % 97 = 0 THEN 'no id' WHEN o_orderkey % 89 = 0 THEN 'total is no double' END AS fault FROM orders),
judged AS (SELECT request_id, count(*) AS records, arg_min(fault, id) FILTER (fault IS NOT NULL) AS fault FROM posts GROUP BY request_id)"""


def _posted(spark, d):
    """The orders as posted requests, each a JSON array of at most twenty records: (folder, what became of each)."""
    key = F.col("o_orderkey")
    record = F.struct(
        F.when(key % 97 > 0, key).alias("id"),
        F.when(key % 89 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("total"),
        F.col("o_orderpriority").alias("note"))
    requests = table(spark, d, "orders").groupBy(F.expr("o_orderkey div 20").alias("request_id")).agg(
        F.sort_array(F.collect_list(F.struct(key.alias("k"), record.alias("r")))).alias("all")).select(
        "request_id", F.to_json(F.transform("all", lambda x: x["r"])).alias("body"))
    folder = work_folder(spark)
    return folder, writers.append_posted(requests, POSTED, folder, ["id", "total"], ingestion_timestamp=ts(tb.AS_OF))


@register("append_posted", sql(POSTS, """SELECT request_id, id, total, note, '2001-08-01 00:00:00' AS ingestion_timestamp
  FROM posts JOIN judged USING (request_id) WHERE judged.fault IS NULL"""))
def append_posted(spark, d):
    """Requests arrive whole, or leave nothing."""
    return spark.read.parquet(_posted(spark, d)[0])


@register("posted_faults", sql(POSTS, "SELECT request_id, records, fault FROM judged"))
def posted_faults(spark, d):
    return _posted(spark, d)[1]


CHARACTERS = 40_000  # of a batch in the query below
LINE_SIZES = """sized AS (SELECT doc_id, text, length(coalesce(text, '')) + length(CAST(doc_id AS VARCHAR)) AS size FROM documents)"""


@register("rows_by_characters", sql(LINE_SIZES, f"""placed AS (SELECT *, CAST(sum(size) OVER (ORDER BY doc_id, text) AS BIGINT) AS "end" FROM sized),
cut AS (SELECT *, ("end" - size) // {CHARACTERS} AS a, greatest("end" - 1, "end" - size) // {CHARACTERS} AS z FROM placed)""",
  """SELECT CASE WHEN a <> z THEN 2 * z - 1 ELSE 2 * a END AS batch, count(*) AS rows, CAST(sum(size) AS BIGINT) AS characters FROM cut GROUP BY batch"""))
def rows_by_characters(spark, d):
    """Documents in batches by characters, read back from their folders; only single long rows pass the limit."""
    folder = work_folder(spark)
    rows = table(spark, d, "documents").select("doc_id", "text")
    said = writers.append_batches(rows, folder, ["doc_id", "text"], CHARACTERS)
    back = spark.read.parquet(folder).groupBy(F.col("batch").cast("long").alias("batch")).agg(
        F.count("*").alias("rows"), F.sum(writers.characters(rows)).alias("characters"))
    larger = F.raise_error(F.lit("a batch of several rows is larger than the limit")).cast("long")
    return back.join(said, ["batch", "rows", "characters"]).withColumn(
        "rows", F.when((F.col("characters") > CHARACTERS) & (F.col("rows") > 1), larger).otherwise(F.col("rows")))


# --- sources and small operators -------------------------------------------------------------


@register("read_table_query", "SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 1000 UNION ALL SELECT p_partkey, p_size FROM part")
def read_table_query(spark, d):
    """A query over one table, and another table by its path."""
    name = _name()
    table(spark, d, "orders").createOrReplaceTempView(name)
    asked = readers.read(spark, query=f"SELECT o_orderkey, o_custkey FROM {name} WHERE o_totalprice > 1000")
    whole = readers.read(spark, table=f"{d}/part.parquet").selectExpr("p_partkey AS o_orderkey", "CAST(p_size AS BIGINT) AS o_custkey")
    return asked.unionByName(whole)


@register("read_csv", "SELECT l_partkey AS product_id, l_suppkey AS user_id, l_quantity AS rating FROM lineitem")
def csv_names(spark, d):
    """Rows written without a header, read under given names and types."""
    folder = work_folder(spark)
    table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_quantity").write.csv(folder)
    return readers.read_csv(spark, folder, ["product_id", "user_id", "rating"], ["long", "long", "double"])


@register("play_log", """SELECT l_suppkey AS user_id, l_partkey AS track_id, l_quantity AS seconds, p_name AS title, s_name AS name
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""")
def plays(spark, d):
    """Order lines as plays of parts by suppliers."""
    streams = table(spark, d, "lineitem").selectExpr("l_suppkey AS user_id", "l_partkey AS track_id", "l_quantity AS seconds")
    tracks = table(spark, d, "part").selectExpr("p_partkey AS track_id", "p_name AS title")
    users = table(spark, d, "supplier").selectExpr("s_suppkey AS user_id", "s_name AS name")
    return play_log(streams, tracks, users).select("user_id", "track_id", "seconds", "title", "name")


@register("insert_missing", """SELECT c_custkey AS id, 'new' AS state FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def missing(spark, d):
    changes = table(spark, d, "customer").selectExpr("c_custkey AS id", "'new' AS state")
    return insert_missing(table(spark, d, "orders").filter("o_orderstatus = 'P'").selectExpr("o_custkey AS id", "'old' AS state"), changes, ["id"])


@register("update_where", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def updated(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return update_where(rows, F.col("o_orderstatus") == "F", {"o_totalprice": F.lit(0.0), "o_orderpriority": F.lit("done")}).drop("o_orderstatus")


@register("skip_without_data", """SELECT 'late' AS source, false AS has_data UNION ALL SELECT 'all', count(*) > 0 FROM orders
  UNION ALL SELECT 'returned', count(*) > 0 FROM lineitem WHERE l_returnflag = 'R'""")
def skip_without_data(spark, d):
    """Which sources of a job have anything to do."""
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    sources = {"late": orders.filter("o_orderdate > TIMESTAMP_NTZ'2100-01-01 00:00:00'"), "all": orders,
               "returned": lines.filter("l_returnflag = 'R'")}
    return spark.createDataFrame([(name, has_rows(rows)) for name, rows in sources.items()], "source string, has_data boolean")


PRIORITIES = ["3-MEDIUM", "1-URGENT", "5-LOW"]


@register("sort_by_rank", f"""SELECT o_orderkey, o_orderpriority, row_number() OVER (ORDER BY
  CASE o_orderpriority {' '.join(f"WHEN '{p}' THEN {i}" for i, p in enumerate(PRIORITIES, 1))} ELSE 4 END, o_orderkey) AS place
  FROM orders""")
def sort_by_rank(spark, d):
    """All orders by a list of priorities, each with its place."""
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return positions(rows, [by_rank_list(F.col("o_orderpriority"), PRIORITIES), "o_orderkey"], out="place")


@register("mixed_sort", """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_shipdate::VARCHAR AS l_shipdate,
  row_number() OVER (ORDER BY l_returnflag DESC, l_shipdate, l_quantity DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS place,
  row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, l_quantity DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS place_of_flag
  FROM lineitem""")
def mixed_sort(spark, d):
    """Every line's place in a sort of mixed directions, over the table and inside its return flag, a hot key."""
    own = ["l_shipdate", F.col("l_quantity").desc(), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_returnflag")
    placed = positions(positions(rows, [F.col("l_returnflag").desc(), *own], out="place"), own, ["l_returnflag"], out="place_of_flag")
    return placed.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "place", "place_of_flag")
