"""Tokens, vocabulary, TF-IDF, phrases and topics over whole texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import LDA
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from weirflow.functions import fixed
from weirflow.lineage import cut_lineage, work_folder, written


def _starts(t: Column, starts: Sequence[str]) -> Column:
    out = t.startswith(starts[0])
    for s in starts[1:]:
        out = out | t.startswith(s)
    return out


def tokens(text: Column) -> Column:
    """Lower-cased words; web addresses and @names become one marker each, blanks vanish."""
    found = F.regexp_extract_all(text, F.lit(fixed.TOKEN_PATTERN), F.lit(0))
    return F.transform(
        found,
        lambda t: F.when(_starts(t, fixed.URL_STARTS), fixed.URL_TOKEN)
        .when(t.startswith("@"), fixed.SCREEN_NAME_TOKEN)
        .otherwise(F.lower(t)),
    )


def topic_tokens(text: Column, longer_than: int = 4) -> Column:
    """Tokens long enough to carry a topic, without stop words."""
    return F.filter(
        tokens(text), lambda t: (F.length(t) > longer_than) & ~t.isin(fixed.STOP_WORDS)
    )


def lemmatize(df: DataFrame, doc: str, tokens_col: str, lemmas: DataFrame) -> DataFrame:
    """Tokens replaced by their lemma where the dictionary (word, lemma) has one.

    Distinct words are looked up once each; a document gets its own small map back.
    """
    words = df.select(doc, F.explode(F.array_distinct(tokens_col)).alias("word"))
    maps = (
        words.join(lemmas.select("word", "lemma"), "word")
        .groupBy(doc)
        .agg(F.map_from_entries(F.collect_list(F.struct("word", "lemma"))).alias("_lemmas"))
    )
    swap = F.transform(tokens_col, lambda t: F.coalesce(F.col("_lemmas")[t], t))
    return (
        df.join(maps, doc, "left")
        .withColumn(tokens_col, F.when(F.col("_lemmas").isNull(), F.col(tokens_col)).otherwise(swap))
        .drop("_lemmas")
    )


def term_counts(df: DataFrame, doc: str, tokens_col: str) -> DataFrame:
    """(doc, term, tf)."""
    return (
        df.select(doc, F.explode(tokens_col).alias("term"))
        .groupBy(doc, "term")
        .agg(F.count("*").alias("tf"))
    )


def document_frequency(df: DataFrame, tokens_col: str) -> DataFrame:
    """(term, df): repeats inside a document are removed before any row is shuffled."""
    return (
        df.select(F.explode(F.array_distinct(tokens_col)).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("df"))
    )


def _limited(frequency: DataFrame, docs: int, min_docs: int, max_share: float, max_terms: int) -> DataFrame:
    kept = (F.col("df") >= min_docs) & (F.col("df") <= F.floor(F.lit(docs) * F.lit(max_share)))
    return frequency.filter(kept).orderBy(F.col("df").desc(), "term").limit(max_terms)


def vocabulary(
    df: DataFrame,
    tokens_col: str,
    min_docs: int = fixed.VOCAB_MIN_DOCS,
    max_share: float = fixed.VOCAB_MAX_SHARE,
    max_terms: int = fixed.VOCAB_MAX_TERMS,
) -> DataFrame:
    """(term, df): in at least ``min_docs`` documents, at most ``max_share`` of them, and the
    ``max_terms`` most frequent of those."""
    return _limited(document_frequency(df, tokens_col), df.count(), min_docs, max_share, max_terms)


def tfidf(
    df: DataFrame, doc: str, tokens_col: str, vocab: DataFrame | None = None, digits: int = 6,
    min_docs: int = fixed.VOCAB_MIN_DOCS, max_share: float = fixed.VOCAB_MAX_SHARE, max_terms: int = fixed.VOCAB_MAX_TERMS,
) -> DataFrame:
    """(doc, term, tf, weight): tf * log2(docs / df), scaled to length 1 per document.

    Texts are cut into words, shuffled and counted once; the stored counts, one row per document and
    term, give the vocabulary too.  ``doc`` is unique.
    """
    docs = df.count()
    counted = cut_lineage(term_counts(df.select(doc, tokens_col), doc, tokens_col))
    frequency = counted.groupBy("term").agg(F.count("*").alias("df"))
    words = _limited(frequency, docs, min_docs, max_share, max_terms) if vocab is None else vocab
    raw = F.col("tf") * F.log2(F.lit(docs) / F.col("df"))
    weighted = counted.join(words, "term").withColumn("raw", raw)
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(doc)))
    return weighted.withColumn("norm", norm).select(
        doc, "term", "tf",
        F.round(F.coalesce(F.try_divide("raw", "norm"), F.lit(0.0)), digits).alias("weight"),
    )


def token_pairs(tokens_col: Column | str) -> Column:
    """Adjacent tokens as (a, b) structs."""
    c = F.col(tokens_col) if isinstance(tokens_col, str) else tokens_col
    left = F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0)))
    right = F.when(F.size(c) > 1, F.slice(c, F.lit(2), F.size(c) - 1)).otherwise(left)
    return F.zip_with(left, right, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def phrases(
    df: DataFrame,
    tokens_col: str,
    min_count: int = fixed.PHRASE_MIN_COUNT,
    threshold: float = fixed.PHRASE_THRESHOLD,
    digits: int = 6,
) -> DataFrame:
    """(a, b, n, score) of pairs that appear together more than their words explain.

    score = (n_ab - min_count) / n_a / n_b * (distinct words + distinct pairs)
    """
    # words (b is null) and pairs counted in one pass over the texts; the counts are used
    # four times below and are far smaller than the texts
    single = F.transform(tokens_col, lambda t: F.struct(t.alias("a"), F.lit(None).cast("string").alias("b")))
    counts = written(
        df.select(F.explode(F.concat(single, token_pairs(tokens_col))).alias("p"))
        .groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b"))
        .agg(F.count("*").alias("n")),
        work_folder(df.sparkSession),
    )
    size = counts.agg(F.count("*")).scalar()
    words = counts.filter(F.col("b").isNull())
    score = (F.col("n") - F.lit(min_count)) / F.col("n_a") / F.col("n_b") * size
    return (
        counts.filter(F.col("b").isNotNull() & (F.col("n") > min_count))
        .join(words.select("a", F.col("n").alias("n_a")), "a")
        .join(words.select(F.col("a").alias("b"), F.col("n").alias("n_b")), "b")
        .withColumn("score", score)
        .filter(F.col("score") > threshold)
        .select("a", "b", "n", F.round("score", digits).alias("score"))
    )


HASHES = 2_000_000  # hashes of phrases that every task may hold: some hundred megabytes at most


def join_phrases(df: DataFrame, doc: str, tokens_col: str, found: DataFrame) -> DataFrame:
    """Tokens with each phrase joined by '_', left to right; a token joins at most once.

    Where phrases overlap, places at which one begins follow each other in a run: the first of a run
    joins, and every second one after it.  The work grows with the number of tokens.  Applying it a
    second time to phrases of the result gives three-word phrases.
    """
    pairs = df.select(doc, F.posexplode(token_pairs(tokens_col)).alias("i", "p")).select(
        doc, "i", "p.a", "p.b"
    )
    # stored, so that their real size decides how they are joined; hashes are far smaller than words, so the
    # pairs of the texts are held against them where they lie, and only those that pass meet the phrases
    known = written(found.select("a", "b"), work_folder(df.sparkSession))
    hashes = known.select(F.xxhash64("a", "b").alias("_hash"))
    if known.count() <= HASHES:
        hashes = F.broadcast(hashes)
    likely = pairs.join(hashes, F.xxhash64(pairs["a"], pairs["b"]) == hashes["_hash"], "left_semi")
    starts = likely.join(known, ["a", "b"], "left_semi").select(doc, "i")
    run = F.col("i") - F.row_number().over(Window.partitionBy(doc).orderBy("i"))
    place = F.row_number().over(Window.partitionBy(doc, "_run").orderBy("i"))
    joining = starts.withColumn("_run", run).withColumn("_place", place).filter("_place % 2 = 1")
    # for each joining place the tokens between it and the one before: flags by position, built in one go
    gap = F.col("i") - F.coalesce(F.lag("i").over(Window.partitionBy(doc).orderBy("i")), F.lit(-1)) - 1
    flags = (
        joining.withColumn("_gap", gap).groupBy(doc)
        .agg(F.array_sort(F.collect_list(F.struct("i", "_gap"))).alias("_at"))
        .select(doc, F.flatten(F.transform("_at", lambda x: F.array_append(
            F.array_repeat(F.lit(False), x["_gap"].cast("int")), F.lit(True)))).alias("_flags"))
    )

    def token(t: Column, i: Column) -> Column:
        begins = F.coalesce(F.get("_flags", i), F.lit(False))
        goes = F.coalesce(F.get("_flags", i - 1), F.lit(False))
        return F.when(begins, F.concat_ws("_", t, F.get(tokens_col, i + 1))).when(~goes, t)

    out = F.filter(F.transform(tokens_col, token), lambda t: t.isNotNull())
    joined = F.when(F.col("_flags").isNull(), F.col(tokens_col)).otherwise(out)
    return df.join(flags, doc, "left").withColumn(tokens_col, joined).drop("_flags")


def bag_of_words(df: DataFrame, tokens_col: str, with_idf: bool = False, **limits) -> tuple[DataFrame, Sequence[str]]:
    """Spark ML count vectors under the vocabulary limits, and the vocabulary."""
    model = CountVectorizer(
        inputCol=tokens_col,
        outputCol="bag",
        minDF=float(limits.get("min_docs", fixed.VOCAB_MIN_DOCS)),
        maxDF=limits.get("max_share", fixed.VOCAB_MAX_SHARE),
        vocabSize=limits.get("max_terms", fixed.VOCAB_MAX_TERMS),
    ).fit(df)
    out = model.transform(df)
    if with_idf:
        out = IDF(inputCol="bag", outputCol="weighted").fit(out).transform(out)
        out = out.drop("bag").withColumnRenamed("weighted", "bag")
    return out, model.vocabulary


LDA_RATE = 0.05  # share of the documents in one step of the online optimizer


def topics(bags: DataFrame, vocab: Sequence[str], k: int = 10, passes: int = 2, words: int = 10, seed: int = 2018) -> DataFrame:
    """(topic, rank, term, weight) of an LDA model over the bags.

    Steps times their share of the documents make ``passes`` over all of them, at any size.
    """
    steps = round(passes / LDA_RATE)
    model = LDA(k=k, maxIter=steps, subsamplingRate=LDA_RATE, optimizer="online", featuresCol="bag", seed=seed).fit(bags)
    names = bags.sparkSession.createDataFrame(list(enumerate(vocab)), "term_id int, term string")
    top = model.describeTopics(words).select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "t")
    )
    return top.select(
        "topic", "rank", F.col("t.termIndices").alias("term_id"), F.col("t.termWeights").alias("weight")
    ).join(names, "term_id").select("topic", "rank", "term", "weight")


def topic_contrast(df: DataFrame, tokens_col: str, label_col: str, labels: Sequence, **options) -> DataFrame:
    """Topics of each label's documents over one shared vocabulary."""
    limits = {k: options.pop(k) for k in ("min_docs", "max_share", "max_terms", "with_idf") if k in options}
    bags, vocab = bag_of_words(df, tokens_col, **limits)
    # each step of each label's model samples the bags anew: they are stored once, without the texts
    bags = written(bags.select(label_col, "bag"), work_folder(df.sparkSession))
    out = None
    for label in labels:
        part = topics(bags.filter(F.col(label_col) == label), vocab, **options).withColumn(
            label_col, F.lit(label)
        )
        out = part if out is None else out.unionByName(part)
    return out
