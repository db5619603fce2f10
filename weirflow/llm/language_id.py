"""Language identification by a string kernel.

Two texts are as alike as the share of character n-grams (n = 1..3) that both hold: the blended
spectrum kernel on presence, normalised by the sizes of both sets.  Nyström landmarks, a bounded
sample of labelled texts, turn the kernel into a feature vector, and ridge regression of one
language against the rest is solved on those vectors.  A block of texts is scored by two matrix
products: presence by landmarks, and kernel values by weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from weirflow.llm import arrowtext
from weirflow.llm.sampling import held_out, sample_ids, sample_texts

GRAM_SLOTS = 1 << 14     # n-grams are hashed to so many slots
LONGEST = 3
LANDMARKS = 192          # texts the kernel is evaluated against
SAMPLE = 2_000           # labelled texts the regression is fitted on, the bound of what the driver gets
RIDGE = 1e-3
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def presence(texts: list[str]) -> np.ndarray:
    """A row of 0/1 for each text: which slots its n-grams fall into.  Non-letters count as a space."""
    # no n-gram of up to three characters spans letters of two texts, and all texts hold three spaces
    codes = [np.frombuffer(("  " + t.lower() + "   ").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    flat = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
    row = np.repeat(np.arange(len(texts), dtype=np.int64), [len(c) for c in codes]) * GRAM_SLOTS
    flat = np.where(_letters()[flat], flat, 32).astype(np.uint64)
    out = np.zeros(len(texts) * GRAM_SLOTS, np.uint8)
    gram = np.zeros(len(flat), np.uint64)
    for n in range(LONGEST):
        gram[: len(flat) - n] = gram[: len(flat) - n] * np.uint64(0x100000001B3) + flat[n:]
        top = len(flat) - n
        slots = ((gram[:top] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 14)
        out[row[:top] + slots.astype(np.int64)] = 1
    return out.reshape(len(texts), GRAM_SLOTS)


class Model:
    """Landmarks (slots x landmarks), their sizes, weights (landmarks x languages), language names."""

    def __init__(self, landmarks: np.ndarray, weights: np.ndarray, languages: list[str]):
        self.landmarks = landmarks.T.astype(np.float32)
        self.sizes = np.sqrt(landmarks.sum(1, dtype=np.float32))
        self.weights = weights.astype(np.float32)
        self.languages = languages

    def kernel(self, held: np.ndarray) -> np.ndarray:
        sizes = np.sqrt(held.sum(1, dtype=np.float32))
        return (held.astype(np.float32) @ self.landmarks) / np.maximum(np.outer(sizes, self.sizes), 1)

    def margins(self, held: np.ndarray) -> np.ndarray:
        return self.kernel(held) @ self.weights


def fit(held: np.ndarray, languages: list[str]) -> Model | None:
    """One-versus-rest kernel ridge regression on Nyström features; None without a labelled text."""
    names = sorted(set(languages))
    if not names:
        return None
    kind = np.array([names.index(x) for x in languages])
    turn = np.zeros(len(kind), np.int64)  # landmarks are taken from all languages in turn
    for k in range(len(names)):
        turn[kind == k] = np.arange((kind == k).sum())
    landmarks = held[np.lexsort((kind, turn))[:LANDMARKS]]
    unit = Model(landmarks, np.eye(len(landmarks)), names)
    values, vectors = np.linalg.eigh(unit.kernel(landmarks).astype(np.float64))
    root = vectors * (1 / np.sqrt(np.maximum(values, 1e-6)))
    features = unit.kernel(held).astype(np.float64) @ root
    target = np.where(kind[:, None] == np.arange(len(names)), 1.0, -1.0)
    share = 1 / np.maximum(np.bincount(kind, minlength=len(names)), 1)[kind]  # each language weighs the same
    left = (features * share[:, None]).T @ features + RIDGE * np.eye(features.shape[1])
    weights = root @ np.linalg.solve(left, (features * share[:, None]).T @ target)
    return Model(landmarks, weights, names)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> Model | None:
    """Fit on at most ``SAMPLE`` labelled ids that are not held out, one text each; null texts teach nothing, an
    id with several labels or texts has the least of them."""
    rows = docs.filter(~held_out(id_col) & F.col(label_col).isNotNull())
    texts = sample_texts(rows, sample_ids(rows, id_col, label_col, SAMPLE), id_col, text_col, label_col)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                held = np.packbits(presence(part.column(0).to_pylist()), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes() for x in held], pa.binary()), part.column(1), part.column(2)], names=["bits", "label", "o"])

    picked = texts.select("text", F.col("_label").cast("string").alias("label"), F.xxhash64("_id").alias("o"))
    rows = sorted(picked.mapInArrow(bits, "bits binary, label string, o long").collect(), key=lambda r: (r.o, r.label, r.bits))
    if not rows:
        return None
    held = np.unpackbits(np.array([np.frombuffer(r.bits, np.uint8) for r in rows]).reshape(len(rows), -1), axis=1)
    return fit(held, [r.label for r in rows])


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id with ``lang_pred`` and ``score`` (0 to 1).

    Whole texts are scored.  A null text, one without a letter, and any text where there was nothing
    to learn from, is ``und`` with score 0.  Ties go to the language first in order.  Rows that
    repeat an id stay; other columns are not read.  The model (some megabytes, bounded by
    ``LANDMARKS`` and ``GRAM_SLOTS``) is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(1)
            for block in arrowtext.blocks(texts):
                part = texts.slice(block.first, block.rows).to_pylist()
                names, scores = [UNKNOWN] * len(part), np.zeros(len(part))
                known = [i for i, t in enumerate(part) if t and _LETTER.search(t)] if model else []
                for a in range(0, len(known), 512):
                    some = known[a : a + 512]
                    margins = model.margins(presence([part[i] for i in some]))
                    best = margins.argmax(1)
                    scores[some] = np.clip((margins[np.arange(len(some)), best] + 1) / 2, 0, 1)
                    for i, k in zip(some, best.tolist()):
                        names[i] = model.languages[k]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, block.rows), pa.array(names, pa.string()), pa.array(scores)],
                    names=["id", "lang_pred", "score"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", picked.schema["id"].dataType),
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return picked.mapInArrow(run, schema).withColumnRenamed("id", id_col)
