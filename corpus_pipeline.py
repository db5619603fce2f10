"""A corpus pipeline of five stages, each one of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame.  ``run`` writes each result as Parquet
in the shared folder and reads it back as the next stage's documents; a lost executor or a broken
run costs one stage.  All but the last stage return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weirflow.lineage import drop_folder, work_folder, written
from weirflow.llm import bpe, decontamination, ngram_join, pii, registry, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain doesn't reject; it learns from the labelled ones among ``docs``."""
    return toxicity.without_toxic(docs, toxicity.learn(docs, registry.labels(spark, sf_dir)))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar 5-word runs, the one with the smallest id."""
    return ngram_join.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark's windows don't make up a twentieth of."""
    return decontamination.clean_documents(docs, registry.benchmark(spark, sf_dir))


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates."""
    return pii.replace_entities(docs, registry.KEY)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token count and digests of its ids and of what they decode to."""
    return registry.token_digests(bpe.encode_decode(docs, *registry.public_vocabulary()))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", one_of_each_group),
    ("decontamination", decontaminate),
    ("pii", replace_private),
    ("byte_bpe", encode),
]

#: a model, a similarity join's classes, keyed surrogates and BPE merges have no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    folder = work_folder(spark)
    docs = registry.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{name}")
    for name, _ in STAGES[:-1]:
        drop_folder(spark, f"{folder}/{name}")
    return docs
