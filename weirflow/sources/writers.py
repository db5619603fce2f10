"""Writers: conformed appends, exports, upserts of partitioned tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from weirflow.functions.conform import booleans_to_ints, conform, nulls_to_empty, stringify_dates
from weirflow.lineage import work_folder, written
from weirflow.operators.positions import batches_by_size
from weirflow.operators.versions import newest, replace_into

PARTITION = "client_partition_id"
BUCKET = "key_bucket"    # second partition level of keyed tables: a hash bucket of the key
BUCKETS = 16
BATCH_CHARACTERS = 8_000_000
VERSION_SORT = ("event_eid", "ingestion_timestamp")


def _laid_out(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str] = ()) -> DataFrame:
    """Rows gathered by partition value and sorted inside it.

    Adaptive execution sizes the tasks: small partition values share one, a hot value is split
    over many, so neither thousands of tiny files nor one huge task come out.
    """
    placed = df.hint("rebalance", *partition_by) if partition_by else df
    by = [c for c in (*partition_by, *sort_by) if c in df.columns]
    return placed.sortWithinPartitions(*by) if by else placed


def append(
    df: DataFrame,
    path: str,
    target: T.StructType | None = None,
    partition_by: Sequence[str] = (PARTITION,),
    sort_by: Sequence[str] = VERSION_SORT,
    rows_per_file: int = 0,
) -> None:
    """Append by name to the target schema, partitioned by client and sorted by version, so
    that client and version filters skip files and row groups.  A value that does not cast fails."""
    out = conform(df, target, strict=True) if target is not None else df
    parts = [c for c in partition_by if c in out.columns]
    writer = _laid_out(out, parts, sort_by).write.mode("append")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(*parts) if parts else writer).parquet(path)


def append_existing(df: DataFrame, table: str) -> None:
    """Append to a table that must exist, matched by name; never creates it."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        raise ValueError(f"no table {table}")
    conform(df, spark.table(table).schema, strict=True).write.insertInto(table)


def recreate(df: DataFrame, path: str) -> None:
    """Drop, create and load."""
    df.write.mode("overwrite").parquet(path)


def create_table_as(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").saveAsTable(table)


def characters(df: DataFrame) -> Column:
    """Code points of a row's values as text; nulls have none."""
    lengths = [F.coalesce(F.char_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) for f in df.schema.fields
               if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.BinaryType)]
    lengths += [F.coalesce(F.char_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0)) for f in df.schema.fields
                if not isinstance(f.dataType, T.AtomicType)]
    return sum(lengths, F.lit(0)).cast("long")


def append_batches(df: DataFrame, path: str, order: Sequence[Column | str], limit: int = BATCH_CHARACTERS) -> DataFrame:
    """Append in batches of at most ``limit`` characters, along ``order``: one folder ``batch=n`` each.

    Only a row that is longer by itself makes a larger batch.  Returns (batch, rows, characters).
    """
    sized = df.withColumn("_characters", characters(df))
    numbered = written(batches_by_size(sized, order, "_characters", limit, "batch"), work_folder(df.sparkSession))
    _laid_out(numbered.drop("_characters"), ["batch"]).write.mode("append").partitionBy("batch").parquet(path)
    return numbered.groupBy("batch").agg(F.count("*").alias("rows"), F.sum("_characters").alias("characters"))


def append_posted(
    requests: DataFrame, schema: T.StructType, path: str, required: Sequence[str], id_col: str = "request_id",
    body_col: str = "body", **stamps: Column,
) -> DataFrame:
    """Append posted requests, each all or nothing: (request id, body), the body a JSON array of records.

    Ids are distinct; a single record counts as an array of one.  A body that is no array of records, a missing required field or a value of the wrong
    type rejects its whole request and no other.  Records are checked where they lie; nothing passes
    through the driver.  Returns (request id, records, fault): fault is null for requests that were
    appended, else what the first bad record lacks.  Rows are appended with their request's id, so a
    repeated run can be told from a new one.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    parsed = requests.select(
        F.col(id_col), F.from_json(F.col(body_col), T.ArrayType(texts), {"mode": "PERMISSIVE"}).alias("_records"))
    typed = F.struct(*[F.expr(f"try_cast(_r.`{f.name}` AS {f.dataType.simpleString()})").alias(f.name) for f in schema.fields])
    rows = parsed.select(id_col, F.posexplode("_records").alias("_at", "_r")).withColumn("_typed", typed)
    lacking = [F.when(F.col(f"_r.`{c}`").isNull(), F.lit(f"no {c}")) for c in required]
    wrong = [F.when(F.col(f"_r.`{f.name}`").isNotNull() & F.col(f"_typed.`{f.name}`").isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}"))
             for f in schema.fields]
    rows = written(rows.withColumn("_fault", F.coalesce(*lacking, *wrong)), work_folder(requests.sparkSession))
    judged = rows.groupBy(id_col).agg(F.count("*").alias("records"), F.min_by("_fault", F.when(F.col("_fault").isNotNull(), F.col("_at"))).alias("_first"))
    out = parsed.select(id_col, F.col("_records").isNull().alias("_broken")).join(judged, id_col, "left").select(
        id_col, F.coalesce("records", F.lit(0)).cast("long").alias("records"),
        F.coalesce("_first", F.when(F.col("_broken"), F.lit("no array of records"))).alias("fault"))
    out = written(out, work_folder(requests.sparkSession))
    taken = rows.join(out.filter("fault IS NULL").select(id_col), id_col, "left_semi")
    taken.select(id_col, "_typed.*").withColumns(stamps).write.mode("append").parquet(path)
    return out


# --- exports ---------------------------------------------------------------------------------


def export_csv_per_client(
    df: DataFrame, path: str, columns: Sequence[str], client_col: str = "client",
    rows_per_file: int = 1_000_000,
) -> None:
    """Gzip CSV in one folder per client: every field quoted, quotes escaped, a header, no
    client column.  Large clients are written by many tasks as several files."""
    out = booleans_to_ints(stringify_dates(df.select(client_col, *columns)))
    plain = nulls_to_empty(out)
    (
        _laid_out(plain, [client_col]).write.mode("overwrite")
        .partitionBy(client_col)
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", "\\")
        .option("emptyValue", "")
        .option("maxRecordsPerFile", rows_per_file)
        .option("compression", "gzip")
        .csv(path)
    )


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "gzip").json(path)


# --- upserts ---------------------------------------------------------------------------------


def _bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` with its key's bucket, named with the number of buckets, so that the table tells it itself."""
    number = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets))
    return df.withColumn(BUCKET, F.concat(F.lpad(number.cast("string"), 5, "0"), F.lit(f"-of-{buckets:05d}")))


def create_keyed(df: DataFrame, path: str, keys: Sequence[str], partition: str = PARTITION, buckets: int = BUCKETS) -> None:
    """A table for ``upsert_partitions``: partitioned by client and, below it, by a bucket of the key."""
    _laid_out(_bucketed(df, keys, buckets), [partition, BUCKET]).write.mode("overwrite").partitionBy(partition, BUCKET).parquet(path)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table of ``create_keyed``, without its bucket column."""
    return spark.read.parquet(path).drop(BUCKET)


def upsert_partitions(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    work_path: str,
    partition: str = PARTITION,
    keep_newer: bool = False,
) -> None:
    """Upsert into a partitioned Parquet table, rewriting only the partitions that changed.

    In a table of ``create_keyed`` these are the key buckets a batch touches, not whole clients.  With
    ``keep_newer`` a stored row competes with the changes under ``order``; else the changes win.  The
    merged partitions are written to ``work_path`` first and the table is overwritten from
    there, so nothing is read from the folder being replaced and a run that fails half-way can
    be repeated.  Parquet folders have no transactions: a reader may see a partition half replaced, so
    readers start after the upsert.  Keys must include the partition column or never move between
    partitions.
    """
    current = spark.read.parquet(path)
    levels = [partition]
    if BUCKET in current.columns:
        named = current.select(BUCKET).first()
        changes = _bucketed(changes, keys, int(named[0].rpartition("-")[2]) if named else BUCKETS)
        levels.append(BUCKET)
    newest(changes, keys, order).write.mode("overwrite").parquet(f"{work_path}-changes")
    last = spark.read.schema(changes.schema).parquet(f"{work_path}-changes")
    # values of partition columns: as many as the table has folders at most
    touched = [tuple(r) for r in last.select(*levels).distinct().collect()]
    if not touched:
        return
    affected = current.filter(_is_one_of(levels, touched))
    if keep_newer:
        stored = affected.join(last.select(*keys), list(keys), "left_semi")
        last = newest(last.unionByName(stored.select(*last.columns)), keys, order)
    merged = replace_into(affected, last.select(*current.columns), keys)
    _laid_out(merged, levels).write.mode("overwrite").partitionBy(*levels).parquet(work_path)
    (
        spark.read.schema(current.schema).parquet(work_path)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*levels)
        .parquet(path)
    )


def _is_one_of(columns: Sequence[str], rows: Sequence[tuple]) -> Column:
    """A test on partition columns that the planner applies to the list of folders."""
    first, *rest = columns
    by_first: dict = {}
    for value, *more in rows:
        by_first.setdefault(value, []).append(more)
    out = F.lit(False)
    for value, inner in by_first.items():
        same = F.col(first).eqNullSafe(F.lit(value))
        out = out | (same & F.col(rest[0]).isin([x[0] for x in inner]) if rest else same)
    return out
