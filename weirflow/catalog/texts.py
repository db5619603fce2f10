"""Tokens, vocabulary, TF-IDF, phrases, topics, recommendations, codecs."""

from __future__ import annotations

import base64
import gzip
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Window, functions as F, types as T

from weirflow.catalog.testbed import comparable, sql, table
from weirflow.functions import fixed
from weirflow.functions.codecs import compress_long, decrypt_line, gunzip, inflate
from weirflow.lineage import cut_lineage, work_folder, written
from weirflow.operators import factors
from weirflow.operators.recommend import fold_errors, fold_predictions, top_items
from weirflow.operators.skew import widen
from weirflow.operators.text import (
    document_frequency, join_phrases, lemmatize, phrases, term_counts, tfidf, tokens, topic_tokens, vocabulary,
)
from weirflow.plans.topics import contrast_corpora

# executors get these functions by value: the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUERIES: dict = {}


def register(name, sql_text):
    def add(fn):
        QUERIES[name] = (lambda spark, d: comparable(fn(spark, d)), sql_text)
        return fn
    return add


def documents(spark, d):
    """Every document; the driver writes them as one row group, which is one task."""
    return widen(table(spark, d, "documents").select("doc_id", "text"))


def docs(spark, d):
    """Every document with its topic tokens."""
    return documents(spark, d).select("doc_id", topic_tokens(F.col("text")).alias("tokens"))


_PATTERN = fixed.TOKEN_PATTERN.replace("'", "''")
_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in fixed.STOP_WORDS)

WORDS = f"""words AS (
  SELECT doc_id, i, CASE WHEN regexp_matches(t, '^(https?://|www[.])') THEN 'URL'
       WHEN starts_with(t, '@') THEN 'SCREEN_NAME' ELSE lower(t) END AS term
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{_PATTERN}')) AS t,
               generate_subscripts(regexp_extract_all(text, '{_PATTERN}'), 1) AS i FROM documents))"""
TOPIC_WORDS = f"""topic_words AS (SELECT * FROM words WHERE length(term) > 4 AND term NOT IN ({_STOP}))"""


@register("tokens", sql(WORDS, """SELECT doc_id, term, count(*) AS n FROM words GROUP BY doc_id, term"""))
def all_tokens(spark, d):
    every = documents(spark, d).select("doc_id", tokens(F.col("text")).alias("tokens"))
    return term_counts(every, "doc_id", "tokens").withColumnRenamed("tf", "n")


VOCAB = f"""vocab AS (SELECT term, count(DISTINCT doc_id) AS df FROM topic_words GROUP BY term
  HAVING count(DISTINCT doc_id) >= {fixed.VOCAB_MIN_DOCS}
  AND count(DISTINCT doc_id) <= floor((SELECT count(*) FROM documents) * {fixed.VOCAB_MAX_SHARE})
  ORDER BY df DESC, term LIMIT {fixed.VOCAB_MAX_TERMS})"""


@register("vocab_limits", sql(WORDS, TOPIC_WORDS, VOCAB, "SELECT * FROM vocab"))
def vocab_limits(spark, d):
    return vocabulary(docs(spark, d), "tokens")


@register("document_frequency", sql(WORDS, TOPIC_WORDS, "SELECT term, count(DISTINCT doc_id) AS df FROM topic_words GROUP BY term"))
def frequencies(spark, d):
    return document_frequency(docs(spark, d), "tokens")


@register("tfidf", sql(WORDS, TOPIC_WORDS, VOCAB,
  "counted AS (SELECT doc_id, term, count(*) AS tf FROM topic_words GROUP BY doc_id, term)",
  "weighted AS (SELECT c.*, tf * log2((SELECT count(*) FROM documents) / v.df) AS raw FROM counted c JOIN vocab v ON c.term = v.term)",
  """SELECT doc_id, term, tf, round(coalesce(raw / NULLIF(sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 0), 0), 6) AS weight FROM weighted"""))
def weights(spark, d):
    return tfidf(docs(spark, d), "doc_id", "tokens")


NEXT_WORDS = "seq AS (SELECT doc_id, term AS a, lead(term) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM topic_words)"


@register("phrases", sql(WORDS, TOPIC_WORDS, NEXT_WORDS,
  "ab AS (SELECT a, b, count(*) AS n FROM seq WHERE b IS NOT NULL GROUP BY a, b)",
  "w AS (SELECT term, count(*) AS n FROM topic_words GROUP BY term)",
  """SELECT a, b, n, round(score, 6) AS score FROM (
    SELECT a, b, ab.n, (ab.n - 5)::DOUBLE / wa.n / wb.n * ((SELECT count(*) FROM w) + (SELECT count(*) FROM ab)) AS score
    FROM ab JOIN w wa ON ab.a = wa.term JOIN w wb ON ab.b = wb.term WHERE ab.n > 5) WHERE score > 10"""))
def found_phrases(spark, d):
    return phrases(docs(spark, d), "tokens")


def _phrase_round(n: int, source: str) -> list[str]:
    """Phrases of ``source`` (doc_id, i, term) joined; a run of starts joins at every second place."""
    return [
        f"seq{n} AS (SELECT doc_id, i, term AS a, lead(term) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM {source})",
        f"ab{n} AS (SELECT a, b, count(*) AS n FROM seq{n} WHERE b IS NOT NULL GROUP BY a, b)",
        f"w{n} AS (SELECT term, count(*) AS n FROM {source} GROUP BY term)",
        f"""found{n} AS (SELECT a, b FROM (SELECT a, b, (ab.n - 5)::DOUBLE / wa.n / wb.n * ((SELECT count(*) FROM w{n}) + (SELECT count(*) FROM ab{n})) AS score
          FROM ab{n} ab JOIN w{n} wa ON ab.a = wa.term JOIN w{n} wb ON ab.b = wb.term WHERE ab.n > 5) WHERE score > 10)""",
        f"""starts{n} AS (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM seq{n} JOIN found{n} USING (a, b))""",
        f"""joining{n} AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY i) AS place FROM starts{n}) WHERE place % 2 = 1)""",
        f"""joined{n} AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY s.i) AS i,
          CASE WHEN j.i IS NULL THEN a ELSE a || '_' || b END AS term FROM seq{n} s LEFT JOIN joining{n} j USING (doc_id, i)
          WHERE (s.doc_id, s.i - 1) NOT IN (SELECT doc_id, i FROM joining{n}))""",
    ]


NUMBERED = "numbered AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS i, term FROM topic_words)"


@register("phrase_tokens", sql(WORDS, TOPIC_WORDS, NUMBERED, *_phrase_round(1, "numbered"), *_phrase_round(2, "joined1"),
  "SELECT term, count(DISTINCT doc_id) AS df FROM joined2 WHERE contains(term, '_') GROUP BY term"))
def phrase_tokens(spark, d):
    """Two- and three-word phrases as single terms, with the number of documents using each."""
    # each is read by the counts, the places and the texts themselves: cut into words and joined once
    one = written(docs(spark, d), work_folder(spark))
    two = written(join_phrases(one, "doc_id", "tokens", phrases(one, "tokens")), work_folder(spark))
    three = join_phrases(two, "doc_id", "tokens", phrases(two, "tokens"))
    return document_frequency(three, "tokens").filter(F.col("term").contains("_"))


LEMMAS = "lemmas AS (SELECT DISTINCT term AS word, left(term, length(term) - 1) AS lemma FROM topic_words WHERE term LIKE '%s')"


@register("lemmatized", sql(WORDS, TOPIC_WORDS, LEMMAS, """SELECT coalesce(lemma, term) AS term, count(DISTINCT doc_id) AS df
  FROM topic_words LEFT JOIN lemmas ON term = word GROUP BY 1"""))
def lemmatized(spark, d):
    """Documents per lemma, under a dictionary that takes a final s away."""
    every = docs(spark, d)
    ending = document_frequency(every, "tokens").filter(F.col("term").endswith("s")).select(
        F.col("term").alias("word"), F.expr("left(term, length(term) - 1)").alias("lemma"))
    return document_frequency(lemmatize(every, "doc_id", "tokens", ending), "tokens")


TOPIC_FACTS = """SELECT CAST(q AS BIGINT) AS quality, CAST(t AS BIGINT) AS topic, CAST(10 AS BIGINT) AS terms, true AS known, true AS descending
  FROM (VALUES (0), (1)) a(q), range(0, 10) b(t)"""


def topic_facts(spark, d, **options):
    """What has to hold of any topics: ten terms each, all of them from the texts, by falling weight."""
    labelled = documents(spark, d).join(table(spark, d, "labels"), "doc_id")
    found = cut_lineage(contrast_corpora(labelled, "text", "doc_id", "quality", [1, 0], max_share=0.5, **options))
    every = document_frequency(docs(spark, d), "tokens").select("term", F.lit(True).alias("in_texts"))
    before = F.lag("weight").over(Window.partitionBy("quality", "topic").orderBy("rank"))
    # a phrase is known by its words; the marker of @names holds the joining sign itself
    marker = F.lit(fixed.SCREEN_NAME_TOKEN)
    parts = found.withColumn("falls", F.coalesce(before >= F.col("weight"), F.lit(True))).select(
        "quality", "topic", "rank", "falls", F.explode(F.split(F.replace("term", marker, F.lit("@")), "_")).alias("term"))
    known = parts.join(every, "term", "left")
    return known.groupBy("quality", "topic").agg(
        F.count_distinct("rank").alias("terms"), F.every(F.coalesce("in_texts", F.col("term") == "@")).alias("known"), F.every("falls").alias("descending"))


@register("topic_facts", TOPIC_FACTS)
def plain_topics(spark, d):
    return topic_facts(spark, d)


@register("topic_facts_phrases", TOPIC_FACTS)
def phrase_topics(spark, d):
    """Two-word phrases as terms, weighted by inverse document frequency."""
    return topic_facts(spark, d, with_phrases=True, with_idf=True, min_docs=2)


@register("lda_topics", None)
def lda_topics(spark, d):
    """Topics of good and bad documents over one vocabulary."""
    labelled = documents(spark, d).join(table(spark, d, "labels"), "doc_id")
    return contrast_corpora(labelled, "text", "doc_id", "quality", [1, 0], max_share=0.5)


# --- recommendations -------------------------------------------------------------------------


def ratings(spark, d):
    """One rating per buyer and product: the mean over the buyer's lines."""
    lines = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("product_id")).agg(
        F.avg(F.col("l_quantity").cast("long") % 5 + 1).alias("rating")
    )


@register("als_top5", None)
def als_top5(spark, d):
    return top_items(fold_predictions(ratings(spark, d)), 5)


RATINGS = """ratings AS (SELECT o_custkey AS user_id, l_partkey AS product_id, avg(CAST(l_quantity AS BIGINT) % 5 + 1) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)"""


@register("als_facts", sql(RATINGS, """SELECT user_id, count(*) AS predicted, sum(product_id)::BIGINT AS products,
  CAST(round(sum(rating) * 1000) AS BIGINT) AS ratings, least(count(*), 5) AS top, true AS ordered FROM ratings GROUP BY user_id"""))
def als_facts(spark, d):
    """Every rating is predicted once, and a user's top items are the best predicted, in order."""
    predicted = cut_lineage(fold_predictions(ratings(spark, d)))
    whole = predicted.groupBy("user_id").agg(
        F.count("*").alias("predicted"), F.sum("product_id").alias("products"), F.round(F.sum("rating") * 1000).cast("long").alias("ratings"))
    before = F.lag("prediction").over(Window.partitionBy("user_id").orderBy("rank"))
    top = top_items(predicted, 5).withColumn("falls", F.coalesce(before >= F.col("prediction"), F.lit(True)))
    listed = top.groupBy("user_id").agg(F.count_distinct("product_id").alias("top"), F.every("falls").alias("ordered"))
    return whole.join(listed, "user_id")


@register("als_rmse", None)
def als_rmse(spark, d):
    return fold_errors(fold_predictions(ratings(spark, d)))


#: of the registered run; the library's own settings are those of ``factors``
SVD = {"rank": 8, "epochs": 6}
FOLDS = """folds AS (SELECT *, CAST('0x' || substr(md5(user_id || ':' || product_id), 1, 8) AS BIGINT) % 3 AS fold FROM ratings)"""


@register("svd_facts", sql(RATINGS, FOLDS, """means AS (SELECT f.fold, avg(r.rating) AS mean FROM (SELECT DISTINCT fold FROM folds) f JOIN folds r ON r.fold <> f.fold GROUP BY f.fold)""",
  """SELECT fold, count(*) AS predicted, sum(user_id)::BIGINT AS users, round(sqrt(avg((rating - mean) * (rating - mean))), 6) AS mean_rmse,
  true AS within FROM folds JOIN means USING (fold) GROUP BY fold"""))
def svd_facts(spark, d):
    """Each fold's error by the biased model beside the error of its plain mean, which bounds it (and a twentieth)."""
    predicted = cut_lineage(factors.fold_predictions(ratings(spark, d), **SVD))
    # a row a fold: what the other folds hold is the total without its own
    of, all_folds = predicted.groupBy("fold").agg(F.sum("rating").alias("s"), F.count("*").alias("n")), Window.partitionBy()
    means = of.select("fold", ((F.sum("s").over(all_folds) - F.col("s")) / (F.sum("n").over(all_folds) - F.col("n"))).alias("mean"))
    squared = (F.col("rating") - F.col("mean")) ** 2
    errors = fold_errors(predicted)
    return predicted.join(means, "fold").groupBy("fold").agg(
        F.count("*").alias("predicted"), F.sum("user_id").alias("users"), F.round(F.sqrt(F.avg(squared)), 6).alias("mean_rmse")).join(
        errors, "fold").withColumn("within", F.col("rmse") <= 1.05 * F.col("mean_rmse")).drop("rmse")


@register("svd_rmse", None)
def svd_rmse(spark, d):
    return fold_errors(factors.fold_predictions(ratings(spark, d), **SVD))


# --- codecs ----------------------------------------------------------------------------------


@register("compress_long", "SELECT doc_id, length(text) > 1000 AS packed, md5(text) AS digest FROM documents")
def compressed(spark, d):
    """Long texts packed, then unpacked again: the digest must be the text's own."""
    text = F.col("text")
    packed = documents(spark, d).select("doc_id", (F.length(text) > 1000).alias("packed"), compress_long(text).alias("stored"))
    # an expression with several Python calls on one column runs them in one pass
    back = F.when(F.col("packed"), inflate(F.when(F.col("packed"), F.col("stored")))).otherwise(F.col("stored"))
    return packed.select("doc_id", "packed", F.md5(back).alias("digest"))


@register("gunzip_column", "SELECT page_id, md5(html) AS digest, length(html) AS n FROM pages")
def gunzip_column(spark, d):
    """Half of the pages are packed; the others, which are no gzip text, come back as they are."""
    packed = F.when(F.col("page_id") % 2 == 0, F.base64(_pack(F.col("html")))).otherwise(F.col("html"))
    stored = table(spark, d, "pages").select("page_id", packed.alias("html"))
    return stored.select("page_id", gunzip(F.col("html")).alias("html")).select(
        "page_id", F.md5("html").alias("digest"), F.length("html").alias("n")
    )


# keys of the sample lines, made for this query
SAMPLE_KEYS = [base64.b64encode(bytes([n] * 32)).decode("ascii") for n in (1, 2)]


@F.pandas_udf(T.BinaryType())
def _pack(s: pd.Series) -> pd.Series:
    return s.map(lambda t: gzip.compress(t.encode("utf-8"), mtime=0), na_action="ignore")


def encrypted(text, salt, second):
    """A text packed and encrypted as a change line, with the second sample key where ``second`` holds."""
    iv = F.unhex(F.md5(salt))
    key = F.when(second, SAMPLE_KEYS[1]).otherwise(SAMPLE_KEYS[0])
    body = F.hex(F.aes_encrypt(_pack(text), F.unbase64(key), F.lit("CBC"), F.lit("PKCS"), iv))
    # Spark puts the iv in front of the encrypted bytes
    return F.concat(F.hex(iv), F.lit(":"), F.substring(body, F.lit(33), F.length(body)))


@register("decrypt_lines", "SELECT conv_id, turn, CASE WHEN role = 'user' THEN NULL ELSE md5(text) END AS digest FROM conversations")
def decrypt_lines(spark, d):
    """Turns packed and encrypted as change lines, the user's with a key nobody has."""
    lost = base64.b64encode(bytes([9] * 32)).decode("ascii")
    iv = F.unhex(F.md5(F.concat_ws(":", "conv_id", "turn")))
    key = F.when(F.col("role") == "user", lost).otherwise(SAMPLE_KEYS[1])
    body = F.aes_encrypt(_pack("text"), F.unbase64(key), F.lit("CBC"), F.lit("PKCS"), iv)
    lines = table(spark, d, "conversations").select("conv_id", "turn", iv.alias("iv"), F.hex(body).alias("h"))
    # Spark puts the iv in front of the encrypted bytes
    lines = lines.select("conv_id", "turn", F.concat(F.hex("iv"), F.lit(":"), F.expr("substring(h, 33)")).alias("line"))
    return lines.select("conv_id", "turn", F.md5(decrypt_line(F.col("line"), SAMPLE_KEYS)).alias("digest"))
