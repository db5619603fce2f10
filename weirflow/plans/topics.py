"""Topic contrast and recommender jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirflow.lineage import work_folder, written
from weirflow.operators.joins import enrich
from weirflow.operators.recommend import fold_errors, fold_predictions, top_items
from weirflow.operators.text import join_phrases, phrases, topic_contrast, topic_tokens
from weirflow.sources.readers import read_csv


def contrast_corpora(
    docs: DataFrame, text_col: str, doc: str, label_col: str, labels: Sequence, with_phrases: bool = False,
    **options,
) -> DataFrame:
    """Topics of each label's texts, with two-word phrases as single terms on request."""
    # texts are cut into words once
    prepared = written(docs.select(doc, label_col, topic_tokens(F.col(text_col)).alias("tokens")), work_folder(docs.sparkSession))
    if with_phrases:
        prepared = join_phrases(prepared, doc, "tokens", phrases(prepared, "tokens"))
    return topic_contrast(prepared, "tokens", label_col, labels, **options)


def ratings_from_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, ["product_id", "user_id", "rating"], ["long", "long", "double"])


def recommend(ratings: DataFrame, n: int = 5, folds: int = 3) -> tuple[DataFrame, DataFrame]:
    """(top items per user among the held-out pairs, error per fold)."""
    predicted = fold_predictions(ratings, folds)
    return top_items(predicted, n), fold_errors(predicted)


def play_log(streams: DataFrame, tracks: DataFrame, users: DataFrame) -> DataFrame:
    """Plays with their track and user; a play without either fails the job."""
    return enrich(streams, (tracks, "track_id"), (users, "user_id"), strict=True)
