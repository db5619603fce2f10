"""Ratings: matrix factorisation, error over folds, top items."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, Window, functions as F

from weirflow.lineage import checkpoint_dir, cut_lineage, work_folder, written
from weirflow.operators.shares import top_n


def dense_index(df: DataFrame, column: str, out: str) -> DataFrame:
    """(column, out): distinct values numbered 0.. without a one-task sort.

    Values are range-partitioned and numbered inside their partition; only the partition sizes
    meet in one window.
    """
    parts = (
        df.select(column).distinct().repartitionByRange(column)
        .withColumn("_part", F.spark_partition_id())
    )
    parts = cut_lineage(parts)
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(column)) - 1
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    offset = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    offsets = sizes.select("_part", offset.alias("_offset"))
    return parts.withColumn("_i", inside).join(offsets, "_part").select(
        column, (F.col("_offset") + F.col("_i")).cast("int").alias(out)
    )


def with_int_ids(ratings: DataFrame) -> DataFrame:
    """ALS wants int ids: users and items are numbered, whatever their ids are."""
    return ratings.join(dense_index(ratings, "user_id", "user"), "user_id").join(
        dense_index(ratings, "product_id", "item"), "product_id"
    )


def with_folds(ratings: DataFrame, folds: int = 3, seed: int = 42) -> DataFrame:
    """A fold per (user, item), the same on every run."""
    return ratings.withColumn(
        "fold", F.pmod(F.xxhash64("user_id", "product_id", F.lit(seed)), F.lit(folds)).cast("int")
    )


def _als(rank: int, seed: int) -> ALS:
    # an iteration's shuffle files go with its checkpoint; without one all of them stay until the last
    return ALS(
        rank=rank, maxIter=10, regParam=0.1, userCol="user", itemCol="item", ratingCol="rating",
        coldStartStrategy="nan", seed=seed, checkpointInterval=1,
    )


def fold_predictions(ratings: DataFrame, folds: int = 3, rank: int = 10, seed: int = 42) -> DataFrame:
    """Held-out predictions of every fold: user_id, product_id, rating, prediction, fold.

    A user or item that the fold's model has not seen gets the mean rating it was fitted on, so every
    rating is predicted once.  Ratings and predictions are kept as Parquet tables; of a model no more than
    an iteration's shuffle files lie on disk.
    """
    spark = ratings.sparkSession
    checkpoint_dir(spark)  # ALS checkpoints only where one is set
    once = written(ratings.select("user_id", "product_id", "rating"), work_folder(spark))
    indexed = written(with_folds(with_int_ids(once), folds, seed), work_folder(spark))
    out = None
    for fold in range(folds):
        seen = indexed.filter(F.col("fold") != fold)
        mean = seen.agg(F.avg("rating")).first()[0]
        if mean is None:
            continue
        model = _als(rank, seed).fit(seen)
        part = model.transform(indexed.filter(F.col("fold") == fold)).select(
            "user_id", "product_id", "rating", F.nanvl(F.col("prediction").cast("double"), F.lit(mean)).alias("prediction"), "fold"
        )
        out = part if out is None else out.unionByName(part)
    return out


def fold_errors(predictions: DataFrame) -> DataFrame:
    """(fold, rmse)."""
    squared = (F.col("prediction") - F.col("rating")) ** 2
    return predictions.groupBy("fold").agg(F.sqrt(F.avg(squared)).alias("rmse"))


def rmse(predictions: DataFrame) -> float:
    return RegressionEvaluator(labelCol="rating", predictionCol="prediction", metricName="rmse").evaluate(predictions)


def top_items(predictions: DataFrame, n: int = 5) -> DataFrame:
    """The n best predicted items of each user among the predicted pairs."""
    order = [F.col("prediction").desc(), F.col("product_id")]
    return top_n(predictions, ["user_id"], order, n).select("user_id", "product_id", "prediction", "rank")
