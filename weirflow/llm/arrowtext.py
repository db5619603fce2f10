"""Texts of Arrow batches as flat byte arrays, and hashes of spans of them, without a loop per word.

Everything here works on one block of rows inside a task; Spark partitions and shuffles the work.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

BLOCK_BYTES = 1 << 20
PART_BYTES = 32 << 20  # bytes of text for each partition of what is grouped in Python workers
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0xD6E8FEB86659FD93  # odd, so that it has an inverse modulo 2**64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: bytes 20 and 09-0D, which end a word; all of them are single bytes of UTF-8
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1_000):
    """Jobs started inside pass their rows to Python in batches of ``rows``: texts of thousands of
    bytes each need no larger ones, and every task holds a batch on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def parts_of(texts: DataFrame, text_col: str = "text") -> int:
    """Partitions for what is cut from ``texts`` and grouped: the session's, or more where there is more text.

    So what one group holds stays the same size, however the session is set.  Reads the texts' lengths once.
    """
    size = texts.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(8, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))


def dealt(rows: DataFrame, by: str, parts: int) -> DataFrame:
    """Rows ready to be grouped by ``by`` in ``parts`` partitions; the session's own number is left to the grouping."""
    wanted = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, by) if parts > max(8, wanted) else rows


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    inverse = pow(_STEP, -1, 1 << 64)
    up, down = np.empty(n, np.uint64), np.empty(n, np.uint64)
    for out, base in ((up, _STEP), (down, inverse)):
        out[0] = 1
        size = 1
        while size < n:
            out[size : 2 * size] = out[:size] * np.uint64(pow(base, size, 1 << 64))
            size *= 2
    return up, down


class Block:
    """Some rows' texts: bytes, offsets of the rows in them, and the row range in the batch."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first
        self.rows = len(offsets) - 1


def blocks(column: pa.Array, limit: int = BLOCK_BYTES, rows: int | None = None) -> Iterator[Block]:
    """The column's texts in blocks of about ``limit`` bytes and at most ``rows`` rows, at least one row each;
    null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(len(column) if rows is None else min(len(column), row + rows), max(end, row + 1))
        yield Block(data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row], row)
        row = end


def spans(gap: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs without a gap; no run crosses a row's end."""
    n = len(gap)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty(n + 1, bool)
    before[0] = before[n] = True
    before[1:n] = gap[:-1]
    before[offsets] = True  # before[i]: a run that holds byte i would begin there
    after = np.empty(n, bool)
    after[:-1] = gap[1:]
    after[-1] = True
    cut = offsets[(offsets > 0)] - 1
    after[cut] = True
    solid = ~gap
    return np.flatnonzero(solid & before[:n]), np.flatnonzero(solid & after) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges: equal bytes get equal hashes wherever they stand."""
    bits = max(len(data), 1).bit_length()
    up, down = _powers(max(bits, 20))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * up[: len(data)], out=sums[1:])
    flat = (sums[ends] - sums[starts]) * down[starts]
    return mix(flat + (ends - starts).astype(np.uint64) * _GOLDEN)


def words(block: Block, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the block's words, and offsets of the rows in them."""
    data = LOWER[block.data] if lower else block.data
    starts, ends = spans(SPACE[data], block.offsets)
    return span_hashes(data, starts, ends), np.searchsorted(starts, block.offsets)


def shingles(word_hashes: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of ``width`` words, and their offsets.

    A row with fewer words, but not none, has one: the whole sequence.
    """
    counts = np.diff(offsets)
    many = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out_offsets = np.concatenate(([0], np.cumsum(many)))
    total = int(out_offsets[-1])
    row = np.repeat(np.arange(len(counts)), many)
    at = np.arange(total) - out_offsets[row] + offsets[row]
    padded = np.concatenate((word_hashes, np.zeros(width, np.uint64)))
    short = counts[row] < width
    acc = np.zeros(total, np.uint64)
    for k in range(width):
        part = padded[at + k]
        if short.any():
            part = np.where(short & (k >= counts[row]), np.uint64(0), part)
        acc = acc * np.uint64(_STEP) + part
    acc += np.where(short, counts[row], width).astype(np.uint64) * _GOLDEN
    return mix(acc), out_offsets
