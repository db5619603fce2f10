"""Quality by nearest-neighbour voting in a latent-semantic space.

A text's terms are its byte trigrams, hashed into slots, and marks of how much of it repeats itself.
Weighted counts of a bounded sample of labelled texts give the latent space by a truncated singular
value decomposition; the sample's vectors and labels are broadcast.  Every document is projected
and compared with all of them, block by block, by exact cosine products; the nearest vote with
their labels, each by its similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from weirflow.llm import arrowtext
from weirflow.llm.sampling import held_out, sample_ids, sample_texts

SLOTS = 2_048
MARK_STEPS = np.array([0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9])  # a mark for each share reached
MARK_WEIGHT = 0.4        # of a mark, where all trigrams together weigh 1
RUN = 8                  # words of a run
MARKS = 2 * len(MARK_STEPS)  # shares of repeated runs, and of words that follow themselves
TERMS = SLOTS + MARKS
SAMPLE = 3_000           # labelled texts, dealt from both labels in turn: the bound of the broadcast
ROWS = 512  # texts whose term counts a task holds at once
RANK = 48
NEIGHBOURS = 25
ACCEPTED = 0.7
EMPTY_SCORE = 0.0


def term_counts(block: arrowtext.Block) -> np.ndarray:
    """A row of term counts for each text of a block."""
    data, offsets = block.data.astype(np.uint64), block.offsets
    row = np.repeat(np.arange(block.rows), np.diff(offsets))
    if len(data) > 2:
        gram = (data[:-2] * np.uint64(0x1000193) + data[1:-1]) * np.uint64(0x1000193) + data[2:]
        slot = ((gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(SLOTS)
        whole = row[:-2] == row[2:]
        at = row[:-2][whole] * TERMS + slot[whole].astype(np.int64)
        counts = np.bincount(at, minlength=block.rows * TERMS)
    else:
        counts = np.zeros(block.rows * TERMS, np.int64)
    counts = counts.reshape(block.rows, TERMS).astype(np.float32)
    hashes, where = arrowtext.words(block)
    runs, edges = arrowtext.shingles(hashes, where, RUN)
    for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        if b - a > 1:
            counts[i, SLOTS : SLOTS + len(MARK_STEPS)] = 1 - len(np.unique(runs[a:b])) / (b - a) >= MARK_STEPS
    if len(hashes) > 1:
        of_word = np.repeat(np.arange(block.rows), np.diff(where))
        again = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
        share = np.bincount(of_word[1:][again], minlength=block.rows) / np.maximum(np.diff(where) - 1, 1)
        counts[:, SLOTS + len(MARK_STEPS) :] = share[:, None] >= MARK_STEPS
    return counts


class Model:
    """Term weights, projection (terms x rank), neighbours (rank x sample, unit length) and their labels."""

    def __init__(self, weights: np.ndarray, projection: np.ndarray, neighbours: np.ndarray, labels: np.ndarray):
        self.weights, self.projection = weights.astype(np.float32), projection.astype(np.float32)
        self.neighbours, self.labels = neighbours.astype(np.float32), labels.astype(np.float32)

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return _unit(weighted(counts, self.weights) @ self.projection)

    def votes(self, counts: np.ndarray) -> np.ndarray:
        likeness = np.clip(self.vectors(counts) @ self.neighbours, 0, None)
        k = min(NEIGHBOURS, likeness.shape[1])
        nearest = np.argpartition(-likeness, k - 1, axis=1)[:, :k]
        weight = np.take_along_axis(likeness, nearest, 1) ** 8  # the nearest of the near count most
        total = weight.sum(1)
        return np.where(total > 0, (weight * self.labels[nearest]).sum(1) / np.maximum(total, 1e-12), self.labels.mean())


def weighted(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    grams = _unit(np.log1p(counts[:, :SLOTS]) * weights[:SLOTS])
    return _unit(np.concatenate((grams, counts[:, SLOTS:] * weights[SLOTS:]), axis=1))


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(1, keepdims=True))
    return rows / np.maximum(length, 1e-12)


def fit(counts: np.ndarray, labels: np.ndarray) -> Model | None:
    """Latent space and neighbours of a labelled sample; None if it is empty."""
    if not len(counts):
        return None
    holds = (counts > 0).sum(0)
    weights = np.log((1 + len(counts)) / (1 + holds)) + 1
    weights[SLOTS:] = MARK_WEIGHT
    rows = weighted(counts.astype(np.float64), weights)
    rank = min(RANK, *rows.shape)
    basis = np.linalg.qr(rows.T @ np.random.default_rng(7).standard_normal((len(rows), min(rank + 16, min(rows.shape)))))[0]
    for _ in range(4):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0]
    _, _, turn = np.linalg.svd(rows @ basis, full_matrices=False)
    projection = basis @ turn[:rank].T
    return Model(weights, projection, _unit(rows @ projection).T, labels)


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> Model | None:
    """Fit on at most ``SAMPLE`` labelled ids that are not held out, one text each; null labels and texts teach
    nothing, an id with several labels or texts has the least of them."""
    known = labels.select(F.col(id_col), F.col(label_col)).filter(F.col(label_col).isNotNull() & ~held_out(id_col))
    texts = sample_texts(docs, sample_ids(known, id_col, label_col, SAMPLE), id_col, text_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in arrowtext.blocks(batch.column(0), rows=ROWS):
                counts = np.minimum(term_counts(block), 65_535).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes() for x in counts], pa.binary()), batch.column(1).slice(block.first, block.rows),
                     batch.column(2).slice(block.first, block.rows)], names=["counts", "label", "o"])

    picked = texts.select("text", F.col("_label").cast("double").alias("label"), F.xxhash64("_id").alias("o"))
    rows = sorted(picked.mapInArrow(count, "counts binary, label double, o long").collect(), key=lambda r: (r.o, r.label, r.counts))
    counts = np.array([np.frombuffer(r.counts, np.uint16) for r in rows], np.float32).reshape(len(rows), TERMS)
    return fit(counts, np.array([r.label for r in rows]))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id with ``score``, 0 to 1: how likely its label is 1.

    Whole texts are scored.  A null text or one without a word has score 0, and so has any text
    where there was nothing to learn from.  Equal texts get equal scores; repeated ids stay repeated
    rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for block in arrowtext.blocks(batch.column(1), rows=ROWS):
                counts = term_counts(block)
                scores = np.full(block.rows, EMPTY_SCORE)
                if model is not None:
                    _, where = arrowtext.words(block)
                    some = np.flatnonzero(np.diff(where) > 0)
                    for a in range(0, len(some), 512):
                        scores[some[a : a + 512]] = np.clip(model.votes(counts[some[a : a + 512]]), 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, block.rows), pa.array(scores, pa.float64())], names=["id", "score"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", picked.schema["id"].dataType), T.StructField("score", T.DoubleType())])
    return picked.mapInArrow(run, schema).withColumnRenamed("id", id_col)
