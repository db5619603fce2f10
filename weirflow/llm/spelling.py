"""Spelling variants: words one edit apart, found by probing Bloom filters with generated edits.

The vocabulary is cut into shards by word length; each shard has a blocked Bloom filter whose blocks
are 64-bit words.  Every word's deletions are probed in the shard one letter shorter, its
replacements by a higher letter in its own shard: of two near words exactly one generates the other.
Edits are hashed from prefix sums of the word's own hash, without being spelled out; only positive
ones become strings, are shuffled, and are joined to the vocabulary, which removes false positives.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weirflow.lineage import drop_folder, work_folder, written
from weirflow.llm import arrowtext

LEAST_LENGTH, LEAST_COUNT = 6, 5
TIMES = 5                # so much more often its form has to occur than a word
SHARDS = 64              # lengths from here on share the last shard
KEY_BITS = 20            # of a filter for each word
SLICE = 1 << 17          # 64-bit blocks a slice of a filter holds: a megabyte
PASS_SLICES = 64         # slices broadcast at once, whatever the vocabulary's size; more take more passes
HELD = 200_000           # words a task counts before it passes them on
CUT = 4 << 20            # bytes of a text that are cut into runs at a time
CELLS = 1 << 17          # edits hashed at a time
_PROBES = 5
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_GOLDEN = 0xD6E8FEB86659FD93
_BREAK = re.compile(rb"[^A-Za-z\x80-\xFF]")


def _slices(raw: bytes, size: int) -> Iterator[bytes]:
    """The text in pieces of about ``size`` bytes, cut where no run can be."""
    start = 0
    while len(raw) - start > size:
        gap = _BREAK.search(raw, start + size)
        if gap is None:
            break
        yield raw[start : gap.start()]
        start = gap.start()
    yield raw[start:] if start else raw


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, misspell: int | None = None
) -> DataFrame:
    """(word, n): how often each run of letters stands in all texts, A-Z lower-cased.

    Letters are A-Z, a-z and U+00C0 to U+00FF; words have ``least_length`` code points or more.  With
    ``misspell`` every run whose crc32(``<id>:<run>``) it divides loses the code point at crc32 %
    length first: mistakes whose right form is known.  Null texts have no words, a null id counts as
    an empty one.  Counts leave a task in parts of ``HELD`` words and are summed in a shuffle.
    """
    find = re.compile(rb"(?:[a-z]|\xC3[\x80-\xBF]){%d,}" % least_length).findall
    held, size = HELD, CUT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part in _slices(raw.as_py() or b"", size):
                    found = Counter(find(part.lower()))
                    if misspell:
                        found = _misspelt(found, (doc_id or "").encode() + b":", misspell, least_length)
                    for word, n in found.items():
                        counts[word] = counts.get(word, 0) + n
                    if len(counts) >= held:
                        yield _counted(counts)
                        counts = {}
        yield _counted(counts)

    picked = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return picked.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _misspelt(found: dict[bytes, int], prefix: bytes, every: int, least_length: int) -> dict[bytes, int]:
    begun, crc = zlib.crc32(prefix), zlib.crc32
    hit = [(word, h, n) for word, n in found.items() if not (h := crc(word, begun)) % every]
    for word, _, _ in hit:
        del found[word]
    for word, h, n in hit:
        run = word.decode()
        at = h % len(run)
        if len(run) > least_length:
            left = (run[:at] + run[at + 1 :]).encode()
            found[left] = found.get(left, 0) + n
    return found


def _counted(counts: dict[bytes, int]) -> pa.RecordBatch:
    words = pa.array(list(counts), pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def _shard(length: np.ndarray | int):
    return np.minimum(length, SHARDS)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions in ``words``, code points as rows) for the words of each length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == size)
        step = max(1, CELLS // max(size, 1))
        for a in range(0, len(at), step):
            part = at[a : a + step]
            codes = np.frombuffer("".join([words[k] for k in part.tolist()]).encode("utf-32-le"), "<u4")
            yield part, codes.reshape(len(part), size).astype(np.uint64)


def _powers(size: int) -> np.ndarray:
    out = np.ones(size + 1, np.uint64)
    np.cumprod(np.full(size, _BASE, np.uint64), out=out[1:])
    return out


def _final(sums: np.ndarray, length: int) -> np.ndarray:
    return arrowtext.mix(sums + np.uint64(length * _GOLDEN % (1 << 64)))


def _blocks(hashes: np.ndarray, blocks: int) -> np.ndarray:
    """Block of a filter of ``blocks`` blocks that a hash falls into."""
    return ((hashes >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def _bit(hashes: np.ndarray, k: int) -> np.ndarray:
    return hashes >> np.uint64(6 * k) & np.uint64(63)


def _filter_sizes(vocabulary: DataFrame) -> dict[int, int]:
    """Blocks of each shard's filter; at most ``SHARDS`` rows reach the driver."""
    shard = F.least(F.char_length("word"), F.lit(SHARDS))
    return {r.shard: -(-r.many * KEY_BITS // 64) for r in vocabulary.groupBy(shard.alias("shard")).agg(F.count("*").alias("many")).collect()}


def filters(vocabulary: DataFrame, sizes: dict[int, int], of_slice: int) -> DataFrame:
    """(shard, slice, bits): the blocked Bloom filters of (word), in slices of ``of_slice`` blocks."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, codes in _by_length(batch.column(0).to_pylist()):
                size = codes.shape[1]
                hashes = _final((codes * _powers(size)[:size]).sum(1, dtype=np.uint64), size)
                shard = int(_shard(size))
                block = _blocks(hashes, sizes[shard])
                for part in np.unique(block // of_slice).tolist():
                    own = block // of_slice == part
                    rows.append((shard, part, (block[own] % of_slice).astype(np.int32).tobytes(), hashes[own].tobytes()))
            columns = zip(*rows) if rows else ((),) * 4
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["shard", "slice", "block", "hash"])

    def fill(table: pa.Table) -> pa.Table:
        shard, part = table.column("shard")[0].as_py(), table.column("slice")[0].as_py()
        bits = np.zeros(min(of_slice, sizes[shard] - part * of_slice), np.uint64)
        for block, hashes in zip(table.column("block").to_pylist(), table.column("hash").to_pylist()):
            block, hashes = np.frombuffer(block, np.int32), np.frombuffer(hashes, np.uint64)
            for k in range(_PROBES):
                np.bitwise_or.at(bits, block, np.uint64(1) << _bit(hashes, k))
        return pa.table([pa.array([shard], pa.int32()), pa.array([part], pa.int32()), pa.array([bits.tobytes()], pa.binary())],
                        names=["shard", "slice", "bits"])

    placed = vocabulary.select("word").mapInArrow(place, "shard int, slice int, block binary, hash binary")
    return placed.groupBy("shard", "slice").applyInArrow(fill, "shard int, slice int, bits binary")


class Filters:
    """Some slices of the filters; a probe for another slice is negative here and made in its own pass."""

    def __init__(self, sizes: dict[int, int], slices: dict[tuple[int, int], bytes], of_slice: int = SLICE):
        self.sizes = sizes
        self.slices = slices
        self.of_slice = of_slice
        self.shards = {shard for shard, _ in slices}

    def positive(self, hashes: np.ndarray, shard: int) -> np.ndarray:
        """Positions of the hashes that the shard's filter may hold."""
        if shard not in self.shards:
            return np.zeros(0, np.int64)
        block = _blocks(hashes, self.sizes[shard])
        part, out = block // self.of_slice, []
        for own in [k for s, k in self.slices if s == shard]:
            bits = np.frombuffer(self.slices[shard, own], np.uint64)
            at = np.flatnonzero(part == own)
            held, left = bits[block[at] - own * self.of_slice], hashes[at]
            for k in range(_PROBES):
                there = np.flatnonzero(held >> _bit(left, k) & np.uint64(1))
                at, held, left = at[there], held[there], left[there]
            out.append(at)
        return np.concatenate(out)


def _edits(word_list: list[str], found: Filters, letters: np.ndarray) -> Iterator[tuple[int, str]]:
    """(position of the word, edit) for each deletion and each raised letter that the filters may hold."""
    for at, codes in _by_length(word_list):
        n, size = codes.shape
        if not found.shards & {int(_shard(size)), int(_shard(size - 1))}:
            continue
        powers = _powers(size)
        terms = codes * powers[:size]
        upto = np.zeros((n, size + 1), np.uint64)
        np.cumsum(terms, axis=1, out=upto[:, 1:])
        whole = upto[:, -1:]
        if size > 1:
            # of equal letters in a row only the last is deleted: all give the same word
            last = np.ones((n, size), bool)
            last[:, :-1] = codes[:, :-1] != codes[:, 1:]
            row, i = np.nonzero(last)
            shorter = upto[row, i] + (whole[row, 0] - upto[row, i + 1]) * _INVERSE
            for k in found.positive(_final(shorter, size - 1), int(_shard(size - 1))).tolist():
                word = word_list[at[row[k]]]
                yield at[row[k]], word[: i[k]] + word[i[k] + 1 :]
        for letter in letters.tolist():
            row, i = np.nonzero(codes < letter)
            raised = whole[row, 0] + (np.uint64(letter) - codes[row, i]) * powers[i]
            for k in found.positive(_final(raised, size), int(_shard(size))).tolist():
                word = word_list[at[row[k]]]
                yield at[row[k]], word[: i[k]] + chr(letter) + word[i[k] + 1 :]


def candidates(vocabulary: DataFrame, filters: Filters, letters: list[int]) -> DataFrame:
    """(word, n, edit) for the edits of (word, n) that are positive in these slices of the filters."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(filters)
    own = np.array(sorted(letters), np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            words = batch.column(0).to_pylist()
            at, edits = [], []
            for k, edit in _edits(words, found, own):
                at.append(k)
                edits.append(edit)
                if len(at) >= CELLS:
                    yield _positive(batch, at, edits)
                    at, edits = [], []
            yield _positive(batch, at, edits)

    with_counts = vocabulary.select("word", "n")
    return with_counts.mapInArrow(run, "word string, n long, edit string")


def _positive(batch: pa.RecordBatch, at: list[int], edits: list[str]) -> pa.RecordBatch:
    own = batch.take(pa.array(at, pa.int64()))
    return pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(edits, pa.string())], names=["word", "n", "edit"])


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(word, n, other, other_n) for every two words that differ by one inserted, deleted or replaced code
    point; each pair once.

    ``vocabulary`` is a stored table of distinct (word, n).  The filters are broadcast in passes of at
    most ``PASS_SLICES`` megabytes, so the bound holds for any vocabulary; an edit is probed in the
    pass that holds its slice.
    """
    spark = vocabulary.sparkSession
    folder = work_folder(spark)
    sizes = _filter_sizes(vocabulary)
    letters = [ord(r.c) for r in vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().collect() if r.c]
    of_slice = SLICE
    stored = written(filters(vocabulary, sizes, of_slice), f"{folder}/filters")
    keys = [(s, k) for s in sorted(sizes) for k in range(-(-sizes[s] // of_slice))]
    found = []
    for a in range(0, len(keys), PASS_SLICES):
        wanted = keys[a : a + PASS_SLICES]
        chosen = F.struct("shard", "slice").isin([F.struct(F.lit(s), F.lit(k)) for s, k in wanted])
        slices = {(r.shard, r.slice): r.bits for r in stored.filter(chosen).toLocalIterator()}
        found.append(written(candidates(vocabulary, Filters(sizes, slices, of_slice), letters), f"{folder}/pass-{a}"))
    if not found:
        return vocabulary.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n")).filter("false")
    positive = found[0]
    for more in found[1:]:
        positive = positive.unionByName(more)
    others = vocabulary.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    return positive.join(others, positive["edit"] == others["other"]).select("word", "n", "other", "other_n")


def roots(forms: DataFrame, steps: int, folder: str) -> DataFrame:
    """(word, root) for (word, form): the end of each word's forms, at most ``steps`` of them, by doubling."""
    now = written(forms.select("word", F.col("form").alias("root")), f"{folder}/roots-0")
    for k in range(max(0, math.ceil(math.log2(max(steps, 1))))):
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        now = written(now.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root")), f"{folder}/roots-{k + 1}")
    return now


def group_variants(counts: DataFrame, least_count: int = LEAST_COUNT, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of (word, n) that occurs ``least_count`` times or more.

    Near words differ by one code point.  A word's form is its near word of largest n (ties: smallest in
    code-point order) if that n is ``times`` the word's n or more, else null; the root is where the
    forms lead, the word itself without a form.  Counts grow along the forms, so they can't circle.

    Words are distinct and not null.  An empty vocabulary gives no rows.
    """
    spark = counts.sparkSession
    folder = work_folder(spark)
    vocabulary = written(counts.filter(F.col("n") >= least_count).select("word", "n"), f"{folder}/vocabulary")
    pairs = written(near_pairs(vocabulary), f"{folder}/pairs")
    both = pairs.unionByName(pairs.select(
        F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best: Column = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("word")))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.word").alias("best"), (-F.col("best.less")).alias("best_n"))
    enough = F.col("best_n") >= times * F.col("n")
    judged = written(vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best")).alias("form"), F.when(enough, F.col("best_n")).alias("form_n")), f"{folder}/judged")
    most = vocabulary.agg(F.max("n")).first()[0] or 1
    steps = int(math.log(max(most / least_count, 1), times)) + 1  # each form has ``times`` the count of the one before
    named = roots(judged.filter("form IS NOT NULL"), steps, folder)
    out = written(judged.join(named, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), f"{folder}/out")
    drop_folder(spark, f"{folder}/pairs")
    return out
