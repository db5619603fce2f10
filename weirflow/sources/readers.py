"""Readers: tables or queries, selected files, JSON lines, CSV, key ranges over JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

KEY_BATCH = 10_000


def read(spark: SparkSession, query: str | None = None, table: str | None = None) -> DataFrame:
    """A table or a query: exactly one of the two.  A table may be a catalog name or a path."""
    if (query is None) == (table is None):
        raise ValueError("give either a query or a table")
    if query is not None:
        return spark.sql(query)
    return spark.read.parquet(table) if "/" in table else spark.table(table)


# --- files -----------------------------------------------------------------------------------


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def file_seq(path: Column) -> Column:
    """The number behind the last '-' of a file name, null without one."""
    return F.regexp_extract(file_name(path), r"-(\d+)$", 1).try_cast("long")


def select_files(listing: DataFrame, path_col: str, prefix: str = "", contains: str = "") -> DataFrame:
    """Paths of a listing whose file name starts with, and holds, the given texts; with their
    number as ``file_seq``.  Sort by it for the order of arrival."""
    name = file_name(F.col(path_col))
    return listing.filter(name.startswith(prefix) & name.contains(contains)).withColumn(
        "file_seq", file_seq(F.col(path_col))
    )


def read_lines(spark: SparkSession, folder: str, prefix: str = "", contains: str = "") -> DataFrame:
    """Text lines (gzip too) with their file and its number.

    The name test is a glob, so other files are not opened.
    """
    glob = f"{prefix}*{contains}*" if contains else f"{prefix}*"
    lines = spark.read.option("pathGlobFilter", glob).text(folder)
    path = F.col("_metadata.file_path")
    return lines.select("value", file_name(path).alias("file"), file_seq(path).alias("file_seq"))


def parse_json(lines: DataFrame, schema: T.StructType, column: str = "value", rejects: str | None = None) -> DataFrame:
    """JSON text to typed columns, the other columns kept.

    A line that is no record of the schema fails, or is put whole into the column ``rejects``, which
    is null for all other lines.
    """
    others = [c for c in lines.columns if c != column]
    if rejects is None:
        parsed = F.from_json(column, schema, {"mode": "FAILFAST"})
    else:
        shape = T.StructType([*schema.fields, T.StructField(rejects, T.StringType())])
        parsed = F.from_json(column, shape, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": rejects})
    return lines.withColumn("_row", parsed).select("_row.*", *others)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_csv(spark: SparkSession, path: str, names: Sequence[str], types: Sequence[str]) -> DataFrame:
    """CSV without a header under the given names; no pass over the file to guess types."""
    schema = ", ".join(f"`{n}` {t}" for n, t in zip(names, types))
    return spark.read.schema(schema).csv(path)


# --- key ranges ------------------------------------------------------------------------------


def key_ranges(df: DataFrame, key: str, batch: int = KEY_BATCH) -> DataFrame:
    """(low, high): closed ranges over the key's minimum to maximum without gap or overlap.

    An empty table gives no range.  The ranges are made on the executors, however many.
    """
    low, high = df.agg(F.min(key).cast("long"), F.max(key).cast("long")).first()
    spark = df.sparkSession
    starts = spark.range(0) if low is None else spark.range(low, high + 1, batch)
    return starts.select(
        F.col("id").alias("low"),
        F.least(F.col("id") + (batch - 1), F.lit(high).cast("long")).alias("high"),
    )


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str, partitions: int,
    properties: dict | None = None,
) -> DataFrame:
    """A database table read in ``partitions`` parallel key ranges.

    The bounds come from one aggregate the database answers.  Spark's strides only split the
    key axis - the first and last range are open - so no id is lost outside them.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**(properties or {}))
    low, high = (
        reader.option("query", f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}").load().first()
    )
    whole = spark.read.format("jdbc").option("url", url).options(**(properties or {})).option("dbtable", table)
    if low is None:
        return whole.load()
    return (
        whole.option("partitionColumn", key)
        .option("lowerBound", int(low))
        .option("upperBound", int(high) + 1)
        .option("numPartitions", partitions)
        .load()
    )


# --- profile ---------------------------------------------------------------------------------


def profile(tables: Sequence[tuple[str, DataFrame, str | None]]) -> DataFrame:
    """(tbl, cnt, min, max) per (name, frame, time column); one aggregate each, no shuffle of
    rows.  A table without a time column has null bounds."""
    out = None
    for name, frame, time_col in tables:
        low = F.min(time_col) if time_col else F.lit(None)
        high = F.max(time_col) if time_col else F.lit(None)
        part = frame.agg(
            F.count(F.lit(1)).alias("cnt"),
            low.cast("timestamp_ntz").alias("min"),
            high.cast("timestamp_ntz").alias("max"),
        ).select(F.lit(name).alias("tbl"), "cnt", "min", "max")
        out = part if out is None else out.unionByName(part)
    return out
