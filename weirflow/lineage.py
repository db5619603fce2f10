"""Cutting long lineages on storage that outlives an executor."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names and all executors share.

    Where it is unset, local mode takes a folder in the warehouse, which is where its tables are; a
    cluster fails, since nothing says which folder its executors share.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named is None:
        named = sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints-{uuid.uuid4().hex}"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and read it back from there.

    The files go when the frame is no longer used, if ``spark.cleaner.referenceTracking.cleanCheckpoints``
    is set, as ``build_session`` does.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_MADE: set[str] = set()  # work folders of this process that nobody has deleted yet


def work_folder(spark: SparkSession) -> str:
    """A new folder name below the checkpoint folder, for tables between two steps of a job.

    A frame that is returned may still read it: ``drop_work_folders`` deletes what is left once the
    results of a job have been written or used.
    """
    folder = f"{checkpoint_dir(spark).rstrip('/')}/work-{uuid.uuid4().hex}"
    _MADE.add(folder)
    return folder


def written(df: DataFrame, folder: str) -> DataFrame:
    """``df`` as a Parquet table in ``folder``, read back with its real size known to the planner."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of ``work_folder`` once nothing reads it any more."""
    if "/work-" not in folder:
        raise ValueError(f"not a work folder: {folder}")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _MADE.discard(folder)


def drop_work_folders(spark: SparkSession) -> None:
    """Delete all work folders of this process: no frame made so far may be read afterwards."""
    for folder in list(_MADE):
        drop_folder(spark, folder)
