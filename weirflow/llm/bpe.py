"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token's bytes form a linked list.  Every pair of neighbours that may merge lies in the bucket
of its merge rank; a bitmap in two levels says which buckets hold anything, so the next rank is two
find-first-set steps away, however long the pre-token is.  An entry whose pair has changed since is
skipped when it comes up.  One step costs the same in a pre-token of ten bytes or ten million.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

MEMO_SLOTS = 1 << 20  # of the memo, a power of two: 27 bytes each with ids below 65,536, else 43
MEMO_IDS = 8          # pre-tokens of more ids are not remembered
PIECES = 1 << 16      # pre-tokens after which a batch of texts is looked up
_WORD = 256           # bits of a bitmap word
_NONE = -1


def read_ranks(path: str) -> dict[bytes, int]:
    """The merge ranks of a vocabulary file with a base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


class ByteBPE:
    """Encoder and decoder for one vocabulary; ``pattern`` cuts a text into pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.vocabulary = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.size = max(ranks.values(), default=0) + 1
        self.byte_ids = [ranks.get(bytes([b]), _NONE) for b in range(256)]
        # left id -> {right id: rank of the merged token}
        self.pairs: list[dict[int, int]] = [{} for _ in range(self.size)]
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left][right] = rank
        # the bitmap: bit r of its lower level says that bucket r holds entries, and bit w of the
        # upper level that word w of the lower one is not zero.  All is zero between two pre-tokens.
        self.lower = [0] * (self.size // _WORD + 1)
        self.word_of = [r // _WORD for r in range(self.size)]
        self.bit_of = [1 << (r % _WORD) for r in range(self.size)]
        self.memo = _Memo(self.size)
        self.text_of = {rank: str(rank) for rank in self.vocabulary}

    def merge(self, raw: bytes) -> tuple[int, ...]:
        """The ids of one pre-token's bytes."""
        whole = self.ranks.get(raw)
        if whole is not None:
            return (whole,)
        byte_ids = self.byte_ids
        ids = [byte_ids[b] for b in raw]
        if _NONE in ids:
            raise ValueError("the vocabulary lacks a single byte")
        pairs, lower, word_of, bit_of, end = self.pairs, self.lower, self.word_of, self.bit_of, len(ids)
        upper, buckets = 0, {}
        after = list(range(1, end + 1))
        before = list(range(-1, end - 1))
        rank_at = [pairs[a].get(b, _NONE) for a, b in pairwise(ids)]  # rank of the pair that begins there
        rank_at.append(_NONE)

        for i, rank in enumerate(rank_at):
            if rank >= 0:
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
                    word = word_of[rank]
                    lower[word] |= bit_of[rank]
                    upper |= 1 << word
        while upper:
            # find first set, twice: the lowest rank with entries
            word = (upper & -upper).bit_length() - 1
            bits = lower[word]
            rank = word * _WORD + (bits & -bits).bit_length() - 1
            bits &= bits - 1
            lower[word] = bits
            if not bits:
                upper &= upper - 1
            entries = buckets.pop(rank)
            if len(entries) > 1:
                entries.sort()  # leftmost first
            for n, i in enumerate(entries):
                if rank_at[i] != rank:
                    continue  # stale: the pair has changed since
                j = after[i]
                k = after[j]
                ids[i] = rank
                rank_at[j] = _NONE
                after[i] = k
                new = lowest = _NONE
                if k < end:
                    before[k] = i
                    new = pairs[rank].get(ids[k], _NONE)
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(i)
                        else:
                            buckets[new] = [i]
                            word = word_of[new]
                            lower[word] |= bit_of[new]
                            upper |= 1 << word
                        lowest = new
                rank_at[i] = new
                h = before[i]
                if h >= 0:
                    new = pairs[ids[h]].get(rank, _NONE)
                    rank_at[h] = new
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(h)
                        else:
                            buckets[new] = [h]
                            word = word_of[new]
                            lower[word] |= bit_of[new]
                            upper |= 1 << word
                        if lowest < 0 or new < lowest:
                            lowest = new
                if 0 <= lowest < rank:  # a lower rank has come up: it goes before the rest of this bucket
                    for rest in entries[n + 1 :]:
                        if rank in buckets:
                            buckets[rank].append(rest)
                        else:
                            buckets[rank] = [rest]
                            word = word_of[rank]
                            lower[word] |= bit_of[rank]
                            upper |= 1 << word
                    break
        out, i = [], 0
        while i < end:
            out.append(ids[i])
            i = after[i]
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def encode_all(self, texts: Sequence[str | None]) -> list[list[int]]:
        """The ids of each text; null has none."""
        out: list[list[int]] = []
        pieces: list[str] = []
        ends: list[int] = []
        for text in texts:
            if text:
                pieces += self.find(text)
            ends.append(len(pieces))
            if len(pieces) >= PIECES:
                out += self._looked_up(pieces, ends)
                pieces, ends = [], []
        return out + self._looked_up(pieces, ends) if ends else out

    def _looked_up(self, pieces: list[str], ends: list[int]) -> list[list[int]]:
        """Ids of the pre-tokens up to each of ``ends``: remembered ones at once, others by merging."""
        hashes = np.fromiter(map(hash, pieces), np.int64, len(pieces))
        known, counts, rows = self.memo.get(hashes)
        new: dict[str, tuple[int, ...]] = {}
        missing = np.flatnonzero(~known)
        found = []
        for i in missing.tolist():
            piece = pieces[i]
            ids = new.get(piece)
            if ids is None:
                ids = new[piece] = self.merge(piece.encode())
            found.append(ids)
        self.memo.put(new)
        counts[missing] = [len(ids) for ids in found]
        edges = np.concatenate(([0], np.cumsum(counts)))
        flat = np.empty(edges[-1], np.int32)
        own = np.ones(len(flat), bool)
        starts, many = edges[missing], counts[missing]
        total = int(many.sum())
        at = np.arange(total) + np.repeat(starts - (np.cumsum(many) - many), many)
        own[at] = False
        flat[at] = np.fromiter((x for ids in found for x in ids), np.int32, total)
        held = counts[known]
        flat[own] = rows[known][np.arange(MEMO_IDS) < held[:, None]]
        cuts = edges[ends].tolist()
        ids = flat.tolist()
        return [ids[a:b] for a, b in zip([0, *cuts], cuts)]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))


class _Memo:
    """Ids by a pre-token's 64-bit hash, in arrays of a fixed size.

    A hash has one slot; a newer pre-token takes it over, so frequent ones are there most of the time
    and the memory is the same whatever the corpus holds.
    """

    def __init__(self, size: int):
        self.keys = np.zeros(MEMO_SLOTS, np.int64)  # no pre-token's hash is 0: that is the empty string's
        self.counts = np.zeros(MEMO_SLOTS, np.uint8)
        self.rows = np.zeros((MEMO_SLOTS, MEMO_IDS), np.uint16 if size <= 1 << 16 else np.int32)

    def get(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which hashes are remembered, and for those how many ids and the ids in front of their row."""
        slots = hashes & (MEMO_SLOTS - 1)
        return self.keys[slots] == hashes, self.counts[slots].astype(np.int64), self.rows[slots]

    def put(self, new: dict[str, tuple[int, ...]]) -> None:
        short = [(hash(piece), len(ids), ids + (0,) * (MEMO_IDS - len(ids))) for piece, ids in new.items() if len(ids) <= MEMO_IDS]
        if short:
            hashes, counts, rows = zip(*short)
            # of new ones with one slot the last stays, in all three arrays
            slot_of = {h & (MEMO_SLOTS - 1): k for k, h in enumerate(hashes)}
            slots, last = list(slot_of), list(slot_of.values())
            self.keys[slots] = np.array(hashes, np.int64)[last]
            self.counts[slots] = np.array(counts, np.uint8)[last]
            self.rows[slots] = np.array(rows, self.rows.dtype)[last]


_CODER: list[tuple[str, ByteBPE]] = []  # a worker's last one: vocabulary, tables and memo, about 60 MB


def _coder(key: str, ranks: dict[bytes, int], pattern: str) -> ByteBPE:
    if not _CODER or _CODER[0][0] != key:
        _CODER[:] = [(key, ByteBPE(ranks, pattern))]
    return _CODER[0][1]


def encode_texts(
    docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Each row's id with ``ids`` array<int> and ``ids_text``, the ids in decimal joined by commas.

    The vocabulary (about a megabyte) goes to the executors as one broadcast.  Null and empty texts
    have no ids; rows with equal ids or texts stay separate rows; other columns are not read.  A
    row is encoded whole in its task; lost tasks are repeated from the input.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_ranks(vocabulary_path))
    key = f"{vocabulary_path}\n{pattern}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(key, shared.value, pattern)
        names = coder.text_of.__getitem__
        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                part = batch.slice(start, 100)
                ids = coder.encode_all(part.column(1).to_pylist())
                texts = [",".join(map(names, x)) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())],
                    names=["id", "ids", "ids_text"],
                )

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("id", picked.schema["id"].dataType),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("ids_text", T.StringType()),
    ])
    return picked.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def encode_decode(
    docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode each text and decode its ids again in the same task.

    Returns the id, ``n_tokens``, ``ids_text`` and ``decoded`` (the bytes the ids stand for).  Cases
    as in ``encode_texts``; a null or empty text gives 0, '' and no bytes.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_ranks(vocabulary_path))
    key = f"{vocabulary_path}\n{pattern}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(key, shared.value, pattern)
        names = coder.text_of.__getitem__
        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                part = batch.slice(start, 100)
                counts, texts, decoded = [], [], []
                for ids in coder.encode_all(part.column(1).to_pylist()):
                    counts.append(len(ids))
                    texts.append(",".join(map(names, ids)))
                    decoded.append(coder.decode(ids))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(texts, pa.string()),
                     pa.array(decoded, pa.binary())],
                    names=["id", "n_tokens", "ids_text", "decoded"],
                )

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("id", picked.schema["id"].dataType),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_text", T.StringType()),
        T.StructField("decoded", T.BinaryType()),
    ])
    return picked.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode_ids(
    rows: DataFrame, vocabulary_path: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """Each row's id with ``decoded``, the bytes of its ids; null ids give no bytes.

    An id outside the vocabulary fails the task: such a row is broken and must not pass as text.
    """
    shared = rows.sparkSession.sparkContext.broadcast(
        {rank: token for token, rank in read_ranks(vocabulary_path).items()}
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for batch in batches:
            raw = [b"".join(map(token, ids or ())) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["id", "decoded"])

    picked = rows.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    schema = T.StructType([T.StructField("id", picked.schema["id"].dataType), T.StructField("decoded", T.BinaryType())])
    return picked.mapInArrow(run, schema).withColumnRenamed("id", id_col)
