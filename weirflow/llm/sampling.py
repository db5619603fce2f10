"""Which labelled rows the models of this package learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no model may learn from; a row without an id can't be told, so it is one of them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(True))


def early(rows: DataFrame, order: Column, by: str, most: int) -> DataFrame:
    """Rows that may be among the first ``most`` of their ``by`` under ``order``, a 64-bit hash.

    Of n rows those in the first 3 * ``most`` / n of all hashes stay, so what is sorted afterwards
    does not grow with the rows, and all first ``most`` are among them but for a chance below 10**-100.
    """
    counts = rows.groupBy(by).agg(F.count("*").alias("_n"))
    share = (order.cast("double") + 2.0**63) / 2.0**64
    joined = rows.withColumn("_share", share).join(counts, rows[by].eqNullSafe(counts[by])).drop(counts[by])
    return joined.filter(F.col("_share") * F.col("_n") <= 3 * most).drop("_share", "_n")


def sample_ids(rows: DataFrame, id_col: str, label_col: str, most: int) -> DataFrame:
    """At most ``most`` distinct ids, dealt from all labels in turn, in an order that only the id decides.

    An id that stands on several rows counts once, with the least of its labels.  The bound makes the
    result safe to broadcast.
    """
    order = F.xxhash64(F.col(id_col))
    turn = F.row_number().over(Window.partitionBy(label_col).orderBy(order, F.col(id_col)))
    once = rows.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(label_col).alias(label_col))
    ranked = early(once, order, label_col, most).withColumn("_turn", turn).filter(F.col("_turn") <= most)
    return ranked.orderBy("_turn", label_col).limit(most).select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))


def sample_texts(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, label_col: str | None = None) -> DataFrame:
    """(_id, _label, text) of the ids in ``sample_ids``: one text an id, its least, so never more rows than ids.

    With ``label_col`` only rows that carry the id's label count.  Ids without a text are left out.
    """
    texts = docs.filter(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("_own"), F.col(text_col).cast("string").alias("text"), *([F.col(label_col).alias("_of")] if label_col else []))
    match = F.col("_own") == F.col("_id")
    if label_col:
        match &= F.col("_of") == F.col("_label")
    joined = texts.join(F.broadcast(chosen), match)
    return joined.groupBy("_id", "_label").agg(F.min("text").alias("text"))
