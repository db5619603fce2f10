"""Whole flows through files: change files, streams, exports, score lookups.

They write below the checkpoint folder and read back what they wrote.
"""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from weirflow.catalog import testbed as tb
from weirflow.catalog.testbed import comparable, sql, table
from weirflow.catalog.texts import SAMPLE_KEYS, encrypted
from weirflow.functions.dates import ts
from weirflow.lineage import work_folder
from weirflow.operators.nesting import unnest
from weirflow.operators.versions import newest
from weirflow.plans.scores import import_scores
from weirflow.sources.writers import export_csv_per_client, read_keyed
from weirflow.streaming.ingest import ingest_changes, upsert_stream
from weirflow.streaming.numbered import ingest_numbered
from weirflow.streaming.state import BUCKETS, newest_by_state, write_updates

QUERIES: dict = {}


def register(name, sql_text):
    def add(fn):
        QUERIES[name] = (lambda spark, d: comparable(fn(spark, d)), sql_text)
        return fn
    return add


def finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


ROWS_PER_FILE = 500_000  # of a feed's batches


def feed(parts, folder: str) -> int:
    """Frames written one after the other as the batches of a file stream; returns the files of each.

    A batch has as many files as its share of the rows needs, so that no task reads or writes all of it.
    A part without rows has one file.
    """
    files = max(1, -(-max(part.count() for part in parts) // ROWS_PER_FILE))
    for part in parts:
        # rows are dealt out in turn: every file gets some, unless the part has fewer rows than files
        dealt = part.repartition(files) if files > 1 else part.coalesce(1)
        dealt.write.mode("append").parquet(folder)
    return files


CHANGE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("tree_user_id", T.LongType()),
        T.StructField("order_date", T.TimestampNTZType()),
        T.StructField("shipped", T.DateType()),
        T.StructField("items", T.ArrayType(T.StructType([T.StructField("day", T.DateType())]))),
    ]
)


def change_files(spark, d, folder: str) -> None:
    """Orders as packed and encrypted JSON lines: one in fifty broken, one in fifty without a real date."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    key = F.col("o_orderkey")
    record = F.to_json(F.struct(
        key.alias("id"), F.col("o_custkey").alias("tree_user_id"),
        F.when(key % 50 == 1, "soon").otherwise(F.concat(day, F.lit("T00:00:00Z"))).alias("order_date"),
        F.when(F.col("o_orderstatus") == "P", "0000-00-00").otherwise(day).alias("shipped"),
        F.array(F.struct(day.alias("day"))).alias("items"),
    ))
    text = F.when(key % 50 == 0, F.left(record, F.lit(12))).otherwise(record)
    lines = table(spark, d, "orders").select(encrypted(text, key.cast("string"), key % 2 == 0).alias("line"))
    lines.write.option("compression", "gzip").text(folder)


def ingested(spark, d) -> str:
    work = work_folder(spark)
    change_files(spark, d, f"{work}/in")
    finish(ingest_changes(spark, f"{work}/in", f"{work}/lake", CHANGE, f"{work}/marks", lambda: tb.AS_OF, keys=SAMPLE_KEYS,
                          prefix="part-", archive=f"{work}/done", rejects=f"{work}/rejects"))
    return work


@register("cdc_stream", """SELECT o_orderkey AS id, o_custkey AS tree_user_id, CAST(o_orderdate AS VARCHAR) AS order_date,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS shipped,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS item_day, '2001-08-01 00:00:00' AS ingestion_timestamp FROM orders
  WHERE o_orderkey % 50 > 1""")
def cdc_stream(spark, d):
    """Orders written as encrypted change files, then streamed into the lake."""
    lake = spark.read.parquet(f"{ingested(spark, d)}/lake")
    return lake.select(
        "id", "tree_user_id", "order_date", "shipped", F.element_at("items", 1)["day"].alias("item_day"), "ingestion_timestamp"
    )


@register("cdc_rejects", """SELECT CASE o_orderkey % 50 WHEN 1 THEN o_orderkey END AS id, o_orderkey % 50 = 0 AS broken,
  CASE o_orderkey % 50 WHEN 1 THEN 'order_date' ELSE '' END AS faults FROM orders WHERE o_orderkey % 50 < 2""")
def cdc_rejects(spark, d):
    """What the stream set aside: broken lines, and records with a text that is no date."""
    bad = spark.read.parquet(f"{ingested(spark, d)}/rejects")
    broken = F.col("_broken_line").isNotNull()
    return bad.select(F.when(~broken, F.col("id")).alias("id"), broken.alias("broken"), F.array_join("_faults", ",").alias("faults"))


@register("upsert_stream", sql(tb.ITEMS, """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CAST(CASE WHEN l_orderkey % 2 = 0 THEN l_shipdate + INTERVAL 100 YEAR ELSE l_shipdate END AS VARCHAR) AS l_shipdate,
  l_suppkey, l_extendedprice FROM items"""))
def upsert(spark, d):
    """The line log as a stream of several batches, kept as newest versions in a partitioned table.

    Half of the lines come again in the first batch as a later version, so their older ones are late.
    """
    work = work_folder(spark)
    log = table(spark, d, "lineitem")
    again = log.filter("l_orderkey % 2 = 0").withColumn("l_shipdate", F.expr("l_shipdate + INTERVAL 100 YEARS"))
    files = feed([again, *[log.filter(F.pmod(F.hash("l_partkey"), F.lit(2)) == k) for k in range(2)]], f"{work}/feed")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", files).parquet(f"{work}/feed")
    finish(upsert_stream(stream, f"{work}/table", tb.ITEM_KEYS, tb.ITEM_ORDER, f"{work}/marks", f"{work}/merge", "l_linenumber"))
    return read_keyed(spark, f"{work}/table").select("l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey", "l_extendedprice")


@register("cdc_ordered", """WITH numbered AS (SELECT o_orderkey, o_custkey % 40 AS file_seq FROM orders),
  files AS (SELECT file_seq, (row_number() OVER (ORDER BY file_seq) - 1) // 7 AS batch_id FROM (SELECT DISTINCT file_seq FROM numbered))
  SELECT o_orderkey AS id, batch_id, '2001-08-01 00:00:00' AS ingestion_timestamp FROM numbered JOIN files USING (file_seq)""")
def cdc_ordered(spark, d):
    """Change files read seven at a time in the order of their numbers; the files are written the other way round."""
    work = work_folder(spark)
    rows = table(spark, d, "orders").withColumn("file_seq", F.col("o_custkey") % 40)
    record = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("tree_user_id")))
    for last in (True, False):
        rows.filter((F.col("file_seq") >= 20) == last).select(record.alias("value"), "file_seq").repartition("file_seq").write.partitionBy(
            "file_seq").mode("append").text(f"{work}/staged")
    numbered_copy(spark, f"{work}/staged", f"{work}/in")
    for _ in range(2):  # the second start finds nothing new
        ingest_numbered(spark, f"{work}/in", f"{work}/lake", CHANGE, f"{work}/marks", lambda: tb.AS_OF, prefix="cdc", files_per_batch=7)
    return spark.read.parquet(f"{work}/lake").select("id", F.col("batch_id").cast("long").alias("batch_id"), "ingestion_timestamp")


def numbered_copy(spark, staged: str, folder: str) -> None:
    """Files of folders ``file_seq=n`` renamed to ``cdc-n`` in one folder, as an exporter would name them."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(folder))
    for found in files.globStatus(path(f"{staged}/file_seq=*/part-*")):
        number = found.getPath().getParent().getName().rpartition("=")[2]
        files.rename(found.getPath(), path(f"{folder}/cdc-{number}"))


STATE_ROWS = 100_000  # lines of a bucket of parts, about
STATE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"]


@register("state_upsert", """SELECT l_partkey, CAST(l_shipdate AS VARCHAR) AS l_shipdate, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_quantity DESC) AS rn
  FROM lineitem) WHERE rn = 1""")
def state_upsert(spark, d):
    """The newest line of each part, kept as keyed state over four batches whose lines come in no order of time."""
    work = work_folder(spark)
    log = table(spark, d, "lineitem").select("l_partkey", *STATE_ORDER)
    files = feed([log.filter(F.pmod(F.hash("l_orderkey"), F.lit(4)) == k) for k in range(4)], f"{work}/feed")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", files).parquet(f"{work}/feed")
    buckets = max(BUCKETS, -(-log.count() // STATE_ROWS))
    newer = newest_by_state(stream, ["l_partkey"], STATE_ORDER, "l_shipdate", "20000 days", "20000 days", buckets)
    finish(write_updates(newer, f"{work}/table", f"{work}/marks"))
    return newest(spark.read.parquet(f"{work}/table").drop("batch_id"), ["l_partkey"], STATE_ORDER).drop("l_quantity")


@register("export_per_client", sql(*tb.PEOPLE, """SELECT client, CAST(tree_user_id AS VARCHAR) AS tree_user_id, email,
  CASE WHEN sponsor_id IS NULL THEN '' ELSE CAST(sponsor_id AS VARCHAR) END AS sponsor_id,
  CASE WHEN type = 'Distributor' THEN '1' ELSE '0' END AS seller,
  CAST(created AS VARCHAR) AS created, 'say "' || client_type || '"' AS note FROM users"""))
def export_per_client(spark, d):
    """Users exported as gzip CSV, one folder per client, and read back."""
    work = work_folder(spark)
    rows = tb.users(spark, d).select(
        "client", "tree_user_id", "email", "sponsor_id", (F.col("type") == "Distributor").alias("seller"), "created",
        F.concat(F.lit('say "'), "client_type", F.lit('"')).alias("note"),
    )
    columns = [c for c in rows.columns if c != "client"]
    export_csv_per_client(rows, work, columns)
    schema = ", ".join(f"{c} string" for c in [*columns, "client"])
    back = spark.read.schema(schema).option("header", True).option("escape", "\\").csv(work)
    return back.select("client", *[F.coalesce(c, F.lit("")).alias(c) for c in columns])


@register("batched_lookup", sql(tb.ENTITIES, f"""SELECT entity_id, c AS client, CAST(length(entity_id) + CASE c WHEN 'beta' THEN 1 ELSE 0 END AS BIGINT) AS score
  FROM entities, (VALUES ('acme'), ('beta')) t(c)
  WHERE date_sub('hour', ingestion_timestamp, TIMESTAMP '{tb.AS_OF}') <= 480"""))
def batched_lookup(spark, d):
    """Recent entities scored in batches by a stand-in for the score service."""

    def fetch(ids):
        return 200, [{"entity_id": i, "acme": len(i), "beta": len(i) + 1} for i in ids]

    entities = tb.entities(spark, d)
    none_scored = entities.select("entity_id").filter(F.lit(False))
    scores = import_scores(entities, none_scored, fetch, "match-score", ts(tb.AS_OF), 480, tb.AS_OF, batch_size=50)
    return unnest(scores, "scores", ["entity_id"])
