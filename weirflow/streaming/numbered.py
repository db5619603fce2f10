"""Change files as a stream in the order of the number in their names, whatever their times say.

A Python data source: its offset is the last file number that was read.  ``ingest_numbered`` sets how
far each batch goes, so batches hold a bounded number of files and come in number order.
"""

from __future__ import annotations

import gzip
import io
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from weirflow.streaming.ingest import store_batch

LINES = 10_000  # of a batch passed on at a time
SCHEMA = "value string, file string, file_seq long"
NUMBER = re.compile(r"-(\d+)(?:\.\w+)*$")


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path inside it; a path without a scheme is local."""
    return fs.FileSystem.from_uri(path if ":" in path.split("/")[0] else f"file://{path}")


def numbered_files(folder: str, prefix: str = "") -> list[tuple[int, str]]:
    """(number, path) of the files of a folder that have one, in order; equal numbers by name."""
    system, inside = _opened(folder)
    found = system.get_file_info(fs.FileSelector(inside, allow_not_found=True))
    names = [(NUMBER.search(x.base_name), x) for x in found if x.type == fs.FileType.File and x.base_name.startswith(prefix)]
    return sorted((int(m[1]), x.path) for m, x in names if m)


class _File(InputPartition):
    def __init__(self, number: int, path: str):
        self.number, self.path = number, path


class NumberedReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.folder, self.prefix = options["path"], options.get("prefix", "")
        self.until = int(options["until"]) if "until" in options else None

    def initialOffset(self) -> dict:
        return {"number": -1}

    def latestOffset(self) -> dict:
        there = [n for n, _ in numbered_files(self.folder, self.prefix)]
        last = max(there, default=-1)
        return {"number": last if self.until is None else self.until}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [_File(n, p) for n, p in numbered_files(self.folder, self.prefix) if start["number"] < n <= end["number"]]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        system, _ = _opened(self.folder)
        name = partition.path.rpartition("/")[2]
        with system.open_input_stream(partition.path, compression=None) as raw:
            lines = io.TextIOWrapper(gzip.open(raw) if name.endswith(".gz") else io.BufferedReader(raw), encoding="utf-8", newline="\n")
            part: list[str] = []
            for line in lines:
                part.append(line.rstrip("\r\n"))
                if len(part) == LINES:
                    yield self._batch(part, name, partition.number)
                    part = []
            if part:
                yield self._batch(part, name, partition.number)

    @staticmethod
    def _batch(lines: list[str], name: str, number: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(lines, pa.string()), pa.array([name] * len(lines), pa.string()), pa.array([number] * len(lines), pa.int64())],
            names=["value", "file", "file_seq"])


class NumberedFiles(DataSource):
    """``spark.readStream.format("numbered_files")``: lines of a folder's files with their name and number.

    Options: ``path``, ``prefix`` of the names, ``until`` (the last number of this run).  A name's number is
    what stands behind its last '-'; files without one are left alone.  Gzip files are unpacked.
    A file that appears later with a number that was passed already is not read: numbers only grow.
    """

    @classmethod
    def name(cls) -> str:
        return "numbered_files"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: T.StructType) -> NumberedReader:
        return NumberedReader(self.options)


def _passed(spark: SparkSession, ledger: str) -> int:
    """The last number that a finished batch wrote down."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return -1
    return spark.read.schema("number long").parquet(ledger).agg(F.max("number")).first()[0] or -1


def ingest_numbered(
    spark: SparkSession, folder: str, lake: str, target: T.StructType, checkpoint: str, batch_time: Callable[[], str],
    keys: Sequence[str] = (), prefix: str = "", files_per_batch: int = 1000, rejects: str | None = None,
) -> int:
    """Append new change files to the lake in the order of their numbers; returns the number of batches.

    Like ``ingest_changes``: a batch overwrites its own ``batch_id`` folder.  Each holds the next
    ``files_per_batch`` files; what it reached is written beside the checkpoint before the stream commits, so
    after a failure the same files are read into the same folder again, and none twice.
    """
    spark.dataSource.register(NumberedFiles)
    ledger, batches = f"{checkpoint.rstrip('/')}-numbers", 0
    while True:
        passed = _passed(spark, ledger)
        waiting = [n for n, _ in numbered_files(folder, prefix) if n > passed]
        if not waiting:
            return batches
        # files that share the last number belong together
        until = waiting[min(files_per_batch, len(waiting)) - 1]

        def write(batch: DataFrame, batch_id: int, until: int = until) -> None:
            store_batch(batch, batch_id, lake, target, batch_time(), keys, rejects)
            spark.createDataFrame([(until,)], "number long").coalesce(1).write.mode("overwrite").parquet(f"{ledger}/batch_id={batch_id}")

        lines = spark.readStream.format("numbered_files").option("prefix", prefix).option("until", str(until)).load(folder)
        query: StreamingQuery = (
            lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        batches += 1
