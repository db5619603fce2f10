"""Change files to the lake and change feeds to a keyed table, as Structured Streaming.

Both run as ``availableNow`` micro-batches: a scheduled start reads what arrived since the last
commit and stops.  No new files means no batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from weirflow.functions.codecs import decrypt_line
from weirflow.functions.conform import conform, parse_dates, stamp, zero_dates_to_null
from weirflow.lineage import drop_folder, work_folder, written
from weirflow.operators.versions import newest
from weirflow.sources.readers import file_name, file_seq
from weirflow.sources.writers import BUCKETS, create_keyed, upsert_partitions

# what reading says before the first batch has written the table
NO_TABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def text_schema(target: T.StructType) -> T.StructType:
    """``target`` with dates as text at every depth: the shape of the records in the files."""

    def as_text(t: T.DataType) -> T.DataType:
        if isinstance(t, T.StructType):
            return text_schema(t)
        if isinstance(t, T.ArrayType):
            return T.ArrayType(as_text(t.elementType), t.containsNull)
        if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return T.StringType()
        return t

    return T.StructType([T.StructField(f.name, as_text(f.dataType)) for f in target.fields])


def change_lines(spark: SparkSession, folder: str, prefix: str = "", archive: str | None = None,
                 files_per_batch: int = 1000) -> DataFrame:
    """Stream of lines with their file; read files are moved to ``archive`` once committed."""
    reader = (
        spark.readStream.format("text")
        .option("pathGlobFilter", f"{prefix}*")
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    path = F.col("_metadata.file_path")
    return reader.load(folder).select(
        "value", file_name(path).alias("file"), file_seq(path).alias("file_seq")
    )


BROKEN, FAULTS = "_broken_line", "_faults"


def decode(lines: DataFrame, target: T.StructType, keys: Sequence[str] = ()) -> DataFrame:
    """Lines (encrypted when keys are given) to rows of ``target``, and what is wrong with each.

    ``_broken_line`` holds a line that no key decrypts (as it came) or that is no JSON record of the target's
    shape, ``_faults`` names the columns whose text is no date.  Blank lines are no records.
    """
    shape = T.StructType([*text_schema(target).fields, T.StructField(BROKEN, T.StringType())])
    read = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    # a line that no key fits goes on as it is: it is no JSON, so it is broken like any other
    text = F.coalesce(decrypt_line(F.col("value"), keys), F.col("value")) if keys else F.col("value")
    parsed = lines.filter(F.trim("value") != "").select(text.alias("_text")).filter(F.trim("_text") != "").select(
        F.from_json("_text", shape, read).alias("r")).select("r.*")
    dated = parse_dates(zero_dates_to_null(parsed), target, rejects=FAULTS)
    extra = T.StructType([*target.fields, T.StructField(BROKEN, T.StringType()), T.StructField(FAULTS, T.ArrayType(T.StringType()))])
    return conform(dated, extra)


def store_batch(
    lines: DataFrame, batch_id: int, lake: str, target: T.StructType, batch_time: str, keys: Sequence[str] = (),
    rejects: str | None = None,
) -> None:
    """One batch of lines to its folder of the lake, decoded once.

    The decoded rows are written to a work folder; the good ones and the bad ones are copied from
    there.  Without ``rejects`` a bad row fails the batch before anything reaches the lake.
    """
    spark = lines.sparkSession
    at = F.lit(batch_time).cast("timestamp_ntz")
    folder = work_folder(spark)
    rows = written(stamp(decode(lines, target, keys), ingestion_timestamp=at), folder)
    bad = F.col(BROKEN).isNotNull() | (F.size(FAULTS) > 0)
    if rejects:
        rows.filter(bad).write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")
        good = rows.filter(~bad)
    else:
        why = F.concat(F.lit("bad record: "), F.coalesce(BROKEN, F.array_join(FAULTS, ", ")))
        good = rows.filter(F.when(bad, F.raise_error(why).cast("boolean")).otherwise(F.lit(True)))
    good.drop(BROKEN, FAULTS).write.mode("overwrite").parquet(f"{lake}/batch_id={batch_id}")
    drop_folder(spark, folder)


def ingest_changes(
    spark: SparkSession,
    folder: str,
    lake: str,
    target: T.StructType,
    checkpoint: str,
    batch_time: Callable[[], str],
    keys: Sequence[str] = (),
    prefix: str = "",
    archive: str | None = None,
    rejects: str | None = None,
) -> StreamingQuery:
    """Append new files to the lake, partitioned by the batch.

    Each micro-batch overwrites its own ``batch_id`` folder, so a batch repeated after a
    failure leaves no duplicates.  A broken line or a text that is no date fails the batch, or goes
    to the folder ``rejects`` beside the lake: the row as far as it was read, the broken line and the
    columns at fault.  Either way no such row reaches the lake as nulls.
    """
    lines = change_lines(spark, folder, prefix, archive)

    def write(batch: DataFrame, batch_id: int) -> None:
        store_batch(batch, batch_id, lake, target, batch_time(), keys, rejects)

    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_stream(
    changes: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    checkpoint: str,
    work_path: str,
    partition: str = "client_partition_id",
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Newest version per key of a change feed, kept in a table of ``create_keyed``.

    A late older version must not replace a newer one, so each batch competes with the stored
    row under ``order``; that also makes a repeated batch harmless.  A batch rewrites the key buckets
    that it touches.  The number of ``buckets`` is set when the table is made.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        work = f"{work_path}/batch_id={batch_id}"
        try:
            spark.read.parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() not in NO_TABLE:
                raise
            create_keyed(newest(batch, keys, order), path, keys, partition, buckets)
            return
        upsert_partitions(spark, path, batch, keys, order, work, partition, keep_newer=True)

    return (
        changes.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
