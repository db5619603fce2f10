"""Quality rules with DataFrame functions only: base counts, and a log-likelihood ratio of hashed n-grams.

Word unigrams and bigrams are hashed into buckets.  Two multinomials over the buckets are counted,
one from the trusted documents and one from the whole corpus; a document's score is its mean log
ratio of the two.  Counting leaves one row a bucket, and the ratios, one number a bucket, are a
constant in the scoring query: scoring is one pass without a shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

BUCKETS = 1 << 14
WINDOW = 8
MIN_WORDS = 20
MOST_REPEATED = 30     # per cent of the words
MIN_RATIO = -0.08      # mean log ratio per n-gram below which a text is unlike the trusted ones
SMOOTHING = 1.0
TRUSTED_BYTES = 16 << 20  # trusted ids up to this size are broadcast, so that no text moves
_WORD = r"[^\x20\x09-\x0D]+"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(_WORD), F.lit(0))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once a row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _starts(words: Column, width: int) -> Column:
    return F.when(F.size(words) >= width, F.sequence(F.lit(1), F.size(words) - (width - 1))).otherwise(
        F.array().cast("array<int>"))


def _slots(words: Column) -> Column:
    """Buckets of a text's unigrams and bigrams."""
    bucket = lambda x: F.pmod(F.xxhash64(x), F.lit(BUCKETS)).cast("int")
    return F.concat(
        F.transform(words, bucket),
        F.transform(_starts(words, 2), lambda i: bucket(F.slice(words, i, 2))),
    )


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """How many words lie in windows that the text holds twice or more, the first ones included."""

    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return _let(ordered, lambda s: _let(
            F.sort_array(F.transform(
                F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])),
                lambda x: x["i"])),
            lambda at: F.aggregate(
                at, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-width).alias("last")),
                lambda acc, i: F.struct((acc["n"] + F.least(F.lit(width), i - acc["last"])).alias("n"), i.alias("last")),
                lambda acc: acc["n"])))

    return _let(
        F.transform(_starts(words, width), lambda i: F.xxhash64(F.slice(words, i, width))),
        lambda hashes: F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(covered(hashes)))


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[float]:
    """ln p(bucket | trusted) - ln p(bucket | corpus) for every bucket.

    ``trusted`` holds the ids of the trusted documents; they are broadcast up to ``TRUSTED_BYTES``, and the
    planner chooses how to join more of them.  All documents are counted; ``BUCKETS`` rows
    reach the driver, whatever the corpus.  Buckets no document has, and an empty corpus, give the
    smoothed values.
    """
    good = trusted.select(F.col(id_col).alias("_good")).filter("_good IS NOT NULL").distinct()
    size = good.agg(F.sum(F.octet_length(F.col("_good").cast("string")) + 16)).first()[0] or 0
    side = F.broadcast(good) if size <= TRUSTED_BYTES else good
    marked = docs.select(F.col(id_col), F.col(text_col)).join(side, docs[id_col] == good["_good"], "left")
    slots = marked.select(
        F.col("_good").isNotNull().cast("long").alias("good"),
        F.explode(_let(_words(F.col(text_col)), _slots)).alias("bucket"),
    )
    counts = slots.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("good").alias("target")).collect()
    raw, target = [0] * BUCKETS, [0] * BUCKETS
    for bucket, in_raw, in_target in counts:
        raw[bucket], target[bucket] = in_raw, in_target
    below = math.log(sum(target) + SMOOTHING * BUCKETS) - math.log(sum(raw) + SMOOTHING * BUCKETS)
    return [math.log(t + SMOOTHING) - math.log(r + SMOOTHING) - below for t, r in zip(target, raw)]


def _table(ratios: list[float]) -> Column:
    """A constant array; the optimizer folds the split and the cast into one literal."""
    return F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")


def mean_ratio(words: Column, ratios: list[float]) -> Column:
    """A text's mean log ratio over its n-grams; null without words."""
    table = _table(ratios)
    return _let(_slots(words), lambda slots: F.when(F.size(slots) > 0, F.aggregate(
        slots, F.lit(0.0), lambda acc, b: acc + F.get(table, b)) / F.size(slots)))


def measure(docs: DataFrame, ratios: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's counts, score and verdict.

    Returns (id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio,
    kept), a row for each row of ``docs``.  Words stand between ASCII white space.  A null or empty
    text has no words and fails the base rules.  Equal texts get equal values; repeated ids stay
    repeated rows; other columns are not read.  Windows and buckets are told apart by 64-bit hashes.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    size = lambda c: F.size(c).cast("long")
    measured = docs.select(
        F.col(id_col),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
        F.inline(F.transform(F.array(_words(F.col(text_col))), lambda w: F.struct(
            size(w).alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda acc, x: acc + F.length(x)).alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
            mean_ratio(w, ratios).alias("ratio"),
        ))),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("ratio") >= MIN_RATIO)
    ).select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio", "kept")


def passing(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns; ids should be unique."""
    good = measure(docs, log_ratios(docs, trusted, id_col, text_col), id_col, text_col).filter("kept")
    good = good.select(F.col(id_col).alias("_kept")).distinct()
    return docs.join(good, docs[id_col] == good["_kept"], "left_semi")
