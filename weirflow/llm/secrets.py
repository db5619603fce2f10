"""Secret scans with a random forest that removes false findings.

Every run of twelve or more characters that could be a key is a candidate.  Its features are its
length and make-up, how likely its character transitions are in the corpus, how much of it
dictionary words cover, and how often labelled findings on such a path and beside such words are
true.  The forest is trained from labelled findings and decides on every candidate.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F, types as T

from weirflow.lineage import drop_folder, work_folder, written
from weirflow.llm import arrowtext
from weirflow.llm.sampling import early

CANDIDATE = re.compile(r"[A-Za-z0-9+/_\-]{12,}={0,2}")
DICTIONARY = 5_000       # most frequent words of the corpus
SAMPLE = 4_000           # labelled findings the forest learns from, half of them true where there are so many
TREES, DEPTH, SEED = 40, 8, 11
ACCEPTED = 0.5
SMOOTHING = 2.0
_BEFORE = re.compile(r"([A-Za-z_]*)[^A-Za-z_\n]{0,4}$")
_AFTER = re.compile(r"^[^A-Za-z_\n]{0,4}([A-Za-z_]*)")
MEASURES = ["length", "digits", "upper", "lower", "symbols", "changes", "entropy", "hex", "likelihood", "coverage"]
RATES = ["before", "after", "path"]
_FOUND = T.StructType([
    T.StructField("start", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("before", T.StringType()), T.StructField("mark", T.StringType()), T.StructField("after", T.StringType()),
    *[T.StructField(m, T.DoubleType()) for m in MEASURES],
])


def transitions(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log probability of each byte after each other, counted over all texts; 65,536 sums reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(65_536, np.int64)
        for batch in batches:
            for block in arrowtext.blocks(batch.column(0)):
                data = block.data.astype(np.int64)
                total += np.bincount(data[:-1] * 256 + data[1:], minlength=65_536)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["pair", "n"])

    pairs = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    table = np.full(65_536, 0.5)
    for pair, n in pairs.collect():
        table[pair] += n
    table = table.reshape(256, 256)
    return np.log(table / table.sum(1, keepdims=True))


def dictionary(docs: DataFrame, text_col: str = "text", most: int = DICTIONARY) -> list[str]:
    """The most frequent words of three to twelve letters over all texts, ties by the word."""
    words = docs.select(F.explode(F.split(F.lower(F.col(text_col).cast("string")), r"[^\p{L}]+")).alias("word"))
    counts = words.filter(F.length("word").between(3, 12)).groupBy("word").agg(F.count("*").alias("n"))
    return [r.word for r in counts.orderBy(F.desc("n"), "word").limit(most).select("word").collect()]


def measures(text: str, log_p: np.ndarray, words: ahocorasick.Automaton) -> tuple[float, ...]:
    """The features of a candidate's own characters, in the order of ``MEASURES``."""
    raw = np.frombuffer(text.encode(), np.uint8)
    n = len(raw)
    digit = (raw >= 48) & (raw <= 57)
    upper = (raw >= 65) & (raw <= 90)
    lower = (raw >= 97) & (raw <= 122)
    kind = digit + 2 * upper + 3 * lower
    counts = Counter(text)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    covered = np.zeros(n, bool)
    if len(words):
        for end, size in words.iter(text.lower()):
            covered[end - size + 1 : end + 1] = True
    return (
        float(n), digit.mean(), upper.mean(), lower.mean(), 1 - (kind > 0).mean(),
        np.count_nonzero(kind[1:] != kind[:-1]) / (n - 1), entropy,
        float(all(c in "0123456789abcdefABCDEF" for c in counts)),
        log_p[raw[:-1], raw[1:]].mean(), covered.mean(),
    )


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """Every candidate of every text with its features and neighbours.

    Returns (id, path, start, text, before, mark, after, measures...); ``start`` counts characters
    from 0.  Null and empty texts have none; a null path is ''.
    """
    shared = docs.sparkSession.sparkContext.broadcast((transitions(docs, text_col), dictionary(docs, text_col)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_p, known = shared.value
        words = ahocorasick.Automaton()
        for word in known:
            words.add_word(word, len(word))
        if known:
            words.make_automaton()
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                rows, at = [], []
                for i, text in enumerate(part.column(2).to_pylist()):
                    for m in CANDIDATE.finditer(text or ""):
                        a, b = m.span()
                        left, right = text[max(0, a - 32) : a], text[b : b + 32]
                        before, after = _BEFORE.search(left), _AFTER.search(right)
                        rows.append((a, m[0], before[1].lower() if before else "", left[-1:], after[1].lower() if after else "",
                                     *measures(m[0], log_p, words)))
                        at.append(i)
                if rows:
                    take = pa.array(at, pa.int64())
                    kinds = [pa.int64(), *[pa.string()] * 4, *[pa.float64()] * len(MEASURES)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(take), part.column(1).take(take), *[pa.array(c, k) for c, k in zip(zip(*rows), kinds)]],
                        names=schema.names)

    picked = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"), F.col(text_col).cast("string").alias("body"))
    schema = T.StructType([picked.schema["id"], T.StructField("path", T.StringType()), *_FOUND.fields])
    return picked.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def seed_label() -> Column:
    """1 or 0 where formats leave no doubt, null elsewhere: labelled findings to start from.

    True are access keys of a fixed shape and mixed values assigned to a password or token; false are
    plain numbers and plain words that nothing is assigned to.
    """
    assigned = F.col("mark").isin("=", ":", '"', "'") & F.col("before").isin("password", "passwd", "secret", "token", "api_key")
    mixed = (F.col("digits") > 0) & (F.col("digits") < 1)
    return F.when(F.col("text").rlike("^AKIA[A-Z0-9]{16}$") & mixed, 1).when(assigned & mixed, 1).when(
        ~assigned & ((F.col("digits") == 1) | (F.col("digits") == 0)), 0)


class Forest:
    """The forest, and the smoothed shares of true findings by neighbouring word and path."""

    def __init__(self, model: RandomForestClassificationModel, rates: dict[str, DataFrame], share: float):
        self.model, self.rates, self.share = model, rates, share


def learn(found: DataFrame, id_col: str = "doc_id") -> Forest | None:
    """Train on at most ``SAMPLE`` labelled findings (``label`` 1 or 0); None without both kinds.

    Which ones is decided by their place alone, so a run repeats.
    """
    spark = found.sparkSession
    order = F.xxhash64(id_col, "start")
    columns = ["label", *RATES, *MEASURES]
    first = early(found, order, "label", SAMPLE // 2)
    halves = [
        first.filter(F.col("label") == k).orderBy(order, id_col, "start").limit(SAMPLE // 2).select(*columns).collect() for k in (0, 1)
    ]
    if not all(halves):
        return None
    rows = [r for half in halves for r in half]
    share = len(halves[1]) / len(rows)
    rates = {}
    for name in RATES:
        true, all_of = Counter(r[name] for r in halves[1]), Counter(r[name] for r in rows)
        # a row's own label is left out of its rate in training only by the smoothing
        rates[name] = [(v, (true[v] + SMOOTHING * share) / (all_of[v] + SMOOTHING)) for v in sorted(all_of)]
    tables = {name: spark.createDataFrame(pairs, f"{name} string, {name}_rate double") for name, pairs in rates.items()}
    kinds = ", ".join(["label int", *[f"{c} string" for c in RATES], *[f"{c} double" for c in MEASURES]])
    sample = spark.createDataFrame(rows, kinds).coalesce(1)  # some thousand rows, as bounded above
    forest = Forest(None, tables, share)
    # a fixed order of the rows, and with the seed the same forest each time
    sample = _vectors(sample, forest).select("label", "features")
    forest.model = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt").fit(sample)
    return forest


def _vectors(found: DataFrame, forest: Forest) -> DataFrame:
    for name, table in forest.rates.items():  # a row for each word of the sample: a few thousand at most
        found = found.join(F.broadcast(table), name, "left").fillna({f"{name}_rate": forest.share})
    inputs = [*MEASURES, *[f"{name}_rate" for name in RATES]]
    return VectorAssembler(inputCols=inputs, outputCol="features").transform(found)


def judged(found: DataFrame, forest: Forest | None, id_col: str = "doc_id") -> DataFrame:
    """Every candidate with ``score``, the forest's share of votes that it is a secret."""
    if forest is None:
        return found.select(id_col, "path", "start", "text", F.lit(0.0).alias("score"))
    scored = forest.model.transform(_vectors(found, forest))
    return scored.select(id_col, "path", "start", "text", F.round(vector_to_array("probability")[1], 6).alias("score"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """The secrets of all texts: (id, path, start, text, score), one row for each accepted finding.

    Candidates are found once, written to the shared folder and read for training and for scoring.
    Without findings of both labels nothing can be learnt and nothing is accepted.  Equal texts have
    equal findings; repeated ids keep a finding for each row; other columns are not read.
    """
    spark = docs.sparkSession
    folder = work_folder(spark)
    found = written(candidates(docs, id_col, text_col, path_col), f"{folder}/found").withColumn("label", seed_label().cast("int"))
    forest = learn(found.filter("label IS NOT NULL"), id_col)
    out = written(judged(found, forest, id_col).filter(F.col("score") >= ACCEPTED), f"{folder}/out")
    drop_folder(spark, f"{folder}/found")
    return out
