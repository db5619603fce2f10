"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models on counts of telling words and beginnings of words.
Each model also sees the probabilities that the earlier ones gave, so it can use how categories go
together.  While training, those are out-of-fold predictions: a row's earlier probabilities come
from models that have not seen the row, as they will when the chain runs on new documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from weirflow.lineage import drop_folder, work_folder, written
from weirflow.llm import arrowtext
from weirflow.llm.sampling import sample_ids, sample_texts

SAMPLE = 6_000           # labelled rows, dealt from both labels in turn: the bound of what the driver gets
ROWS = 512               # texts whose term counts a task holds at once
TERMS = 256              # telling words and beginnings of words
STARTS = (4, 5, 6, 7)    # code points of a beginning
FOLDS = 5
RIDGE = 0.1
REJECTED = 0.5
#: distinct telling words from which on a toxic text also belongs to the category
GRADES = {"severe": 6, "repeated": 3}
CHAIN = (*GRADES, "toxic")
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_GAP = np.ones(256, bool)
_GAP[48:58] = _GAP[97:123] = _GAP[128:] = False


def _term_set(text: Column) -> Column:
    """The distinct words of a text, and the beginnings of the longer ones marked with a star."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _UPPER.lower())
    words = F.regexp_extract_all(lower, F.lit(_WORD), F.lit(0))

    def starts(held: Column, size: int) -> Column:
        longer = F.filter(held, lambda w: F.length(w) > size)
        return F.transform(longer, lambda w: F.concat(F.substring(w, 1, size), F.lit("*")))

    return F.flatten(F.transform(F.array(F.array_distinct(words)), lambda held: F.array_distinct(
        F.concat(held, *[starts(held, n) for n in STARTS]))))


def _hash(terms: Sequence[str]) -> np.ndarray:
    """Hashes of terms as ``term_values`` computes them."""
    raw = [t.rstrip("*").encode() for t in terms]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(w) for w in raw]).astype(np.int64)
    own = arrowtext.span_hashes(data, np.concatenate(([0], ends[:-1])).astype(np.int64), ends)
    return np.where([t.endswith("*") for t in terms], ~own, own)


def term_values(block: arrowtext.Block, hashes: np.ndarray) -> np.ndarray:
    """A row for each text of the block: log2(1 + count) of the (sorted) term hashes."""
    data = arrowtext.LOWER[block.data]
    starts, ends = arrowtext.spans(_GAP[data], block.offsets)
    counts = np.zeros(block.rows * len(hashes), np.int64)

    def mark(own: np.ndarray, starts: np.ndarray) -> None:
        at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
        known = hashes[at] == own
        row = np.searchsorted(block.offsets, starts[known], side="right") - 1
        counts[:] += np.bincount(row * len(hashes) + at[known], minlength=len(counts))

    mark(arrowtext.span_hashes(data, starts, ends), starts)
    letter = np.flatnonzero((data & 0xC0) != 0x80)  # where a code point begins
    first = np.searchsorted(letter, starts)
    letter = np.append(letter, [len(data)] * (max(STARTS) + 1))
    for n in STARTS:
        cut = letter[first + n]
        longer = cut < ends
        mark(~arrowtext.span_hashes(data, starts[longer], cut[longer]), starts[longer])
    return np.log2(1 + counts).reshape(block.rows, len(hashes))


def logistic(rows: np.ndarray, labels: np.ndarray, ridge: float = RIDGE, steps: int = 10) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression by Newton steps; the last one is the intercept.

    Both classes weigh the same in sum.
    """
    share = np.where(labels > 0, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1)) * len(labels)
    x = np.column_stack((rows, np.ones(len(rows))))
    penalty = np.append(np.full(rows.shape[1], ridge), 1e-3)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = np.maximum(p * (1 - p), 1e-6) * share
        step = np.linalg.solve((x * curve[:, None]).T @ x + np.diag(penalty), x.T @ (share * (labels - p)) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


def probability(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(rows @ weights[:-1] + weights[-1], -30, 30)))


class Chain:
    """Telling words (sorted hashes) and a weight vector for each category, in the order of the chain."""

    def __init__(self, hashes: np.ndarray, models: dict[str, np.ndarray]):
        self.hashes, self.models = hashes, models

    def predict(self, rows: np.ndarray) -> dict[str, np.ndarray]:
        out: dict[str, np.ndarray] = {}
        for name, weights in self.models.items():
            out[name] = probability(np.column_stack((rows, *out.values())), weights)
        return out


def fit(hashes: np.ndarray, rows: np.ndarray, labels: Mapping[str, np.ndarray], folds: np.ndarray,
        chosen: Mapping[int, np.ndarray] | None = None, final: np.ndarray | None = None) -> Chain:
    """Train the chain in the order of ``labels``; ``folds`` numbers each row's fold.

    ``chosen`` says which columns the model that predicts a fold may use, namely the terms chosen without
    that fold; ``final`` is what the chain itself uses.  Without them all columns are used.
    """
    final = np.ones(len(hashes), bool) if final is None else final
    models, earlier = {}, []
    for name, label in labels.items():
        out_of_fold = np.zeros(len(rows))
        for k in np.unique(folds):
            x = np.column_stack((rows[:, final if chosen is None else chosen[k]], *earlier)).astype(np.float64)
            out_of_fold[folds == k] = probability(x[folds == k], logistic(x[folds != k], label[folds != k]))
        models[name] = logistic(np.column_stack((rows[:, final], *earlier)).astype(np.float64), label)
        earlier.append(out_of_fold)
    return Chain(hashes[final], models)


def telling_terms(texts: DataFrame, most: int = TERMS) -> dict[int, list[tuple[str, float]]]:
    """The ``most`` terms that tell toxic texts (``label`` 1) from others, with their log odds.

    The list under -1 is chosen over all texts, the one under k over all but those of ``fold`` k.  A
    term has to stand in one toxic text in two hundred, and in three at least.
    """
    spark = texts.sparkSession
    totals = {r.fold: (r.n_bad, r.n_good) for r in texts.groupBy("fold").agg(
        F.sum("label").alias("n_bad"), F.sum(1 - F.col("label")).alias("n_good")).collect()}
    part = lambda value, k: F.sum(F.when(F.col("fold") == k, value).otherwise(0))
    counts = texts.select("fold", "label", F.explode(_term_set(F.col("text"))).alias("word")).groupBy("word").agg(
        F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"),
        *[part(F.col("label"), k).alias(f"bad_{k}") for k in totals],
        *[part(1 - F.col("label"), k).alias(f"good_{k}") for k in totals])
    folder = work_folder(spark)
    counts = written(counts.filter("bad >= 3"), folder)

    def told(k: int) -> list[tuple[str, float]]:
        toxic, clean = [sum(n[i] for fold, n in totals.items() if fold != k) for i in (0, 1)]
        bad, good = (F.col("bad"), F.col("good")) if k < 0 else (F.col("bad") - F.col(f"bad_{k}"), F.col("good") - F.col(f"good_{k}"))
        odds = F.log((bad + 0.5) / F.lit(toxic + 1.0)) - F.log((good + 0.5) / F.lit(clean + 1.0))
        top = counts.filter(bad >= max(3, toxic // 200)).select("word", F.round(odds, 6).alias("odds"))
        return [(r.word, r.odds) for r in top.orderBy(F.desc("odds"), "word").limit(most).collect()]

    out = {k: told(k) for k in (-1, *sorted(totals))}
    drop_folder(spark, folder)
    return out


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> Chain | None:
    """Train on at most ``SAMPLE`` labelled ids, one text each; None without any toxic one.

    The last category is the label itself; the ones before it grade it by how many distinct telling
    words a toxic text holds.  The terms that an out-of-fold model reads are chosen without its fold.
    Null labels and null texts teach nothing; an id with several labels or
    texts has the least of them.
    """
    known = labels.select(F.col(id_col), F.col(label_col)).filter(F.col(label_col).isNotNull())
    texts = sample_texts(docs, sample_ids(known, id_col, label_col, SAMPLE), id_col, text_col).select(
        "text", F.col("_label").cast("long").alias("label"), F.xxhash64("_id").alias("o"))
    texts = texts.withColumn("fold", F.pmod("o", F.lit(FOLDS)).cast("int"))
    told = telling_terms(texts)
    if not told[-1]:
        return None
    terms = sorted({w for words in told.values() for w, _ in words})
    hashes = _hash(terms)
    order = np.argsort(hashes)
    hashes, terms = hashes[order], [terms[i] for i in order]
    chosen = {k: np.isin(terms, [w for w, _ in words]) for k, words in told.items()}
    strong = np.isin(terms, [w for w, odds in told[-1] if odds >= 3.0 and not w.endswith("*")])

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in arrowtext.blocks(batch.column(0), rows=ROWS):
                values = term_values(block, hashes).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes() for x in values], pa.binary()),
                     *[batch.column(c).slice(block.first, block.rows) for c in (1, 2, 3)]], names=["terms", "label", "o", "fold"])

    got = sorted(texts.mapInArrow(held, "terms binary, label long, o long, fold int").collect(), key=lambda r: (r.o, r.label, r.terms))
    rows = np.array([np.frombuffer(r.terms, np.float16) for r in got], np.float64)
    toxic = np.array([r.label for r in got], np.float64)
    hits = (rows[:, strong] > 0).sum(1)
    graded = {name: toxic * (hits >= least) for name, least in GRADES.items()} | {"toxic": toxic}
    return fit(hashes, rows, graded, np.array([r.fold for r in got]), chosen, chosen[-1])


def score(docs: DataFrame, chain: Chain | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id with a probability for every category of the chain.

    Whole texts are scored.  A null or empty text holds no telling word and gets what the chain says
    of such a text; without a chain all probabilities are 0.  Repeated ids stay repeated rows; other
    columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        for batch in batches:
            for block in arrowtext.blocks(batch.column(1), rows=ROWS):
                found = {} if chain is None else chain.predict(term_values(block, chain.hashes))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, block.rows)]
                    + [pa.array(found.get(name, np.zeros(block.rows)), pa.float64()) for name in CHAIN], names=["id", *CHAIN])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", picked.schema["id"].dataType), *[T.StructField(c, T.DoubleType()) for c in CHAIN]])
    return picked.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def without_toxic(docs: DataFrame, chain: Chain | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the chain does not reject, with their own columns and in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        for batch in batches:
            for block in arrowtext.blocks(batch.column(place).cast(pa.string()), rows=ROWS):
                part = batch.slice(block.first, block.rows)
                if chain is not None:
                    part = part.filter(pa.array(chain.predict(term_values(block, chain.hashes))["toxic"] < REJECTED))
                yield part

    return docs.mapInArrow(run, docs.schema)
