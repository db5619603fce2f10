"""Jaccard join of documents on word n-grams by vertical partitioning.

The global order of n-grams is cut into fragments.  A document's set falls into one segment a
fragment, and whatever has to be counted is counted in each fragment on its own and summed:

1. per fragment, how many sets hold each n-gram; per set, the sum of those that others hold too.
   A set of which too little is shared with anything can have no partner and ends here;
2. per fragment, the partial overlap of each candidate pair; the sum per pair decides the link.

Candidate pairs come from the rarest-first prefixes of the remaining sets: linked sets share an
n-gram there.  First every set meets the centres of n-gram groups that it shares most with, which
joins a group of near copies by as many pairs as it has members; then all pairs that share a prefix
n-gram and are not yet connected are counted too, so no link that connects anything is missed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from weirflow.lineage import drop_folder, work_folder, written
from weirflow.llm import arrowtext

WIDTH, PERCENT = 5, 80
SEGMENTS = 8             # cuts of the global order in which a pair's partial overlaps are counted
WHOLE = 2_000            # n-grams up to which a pair's segments travel in one row
CENTRES = 5              # sets that stand for an n-gram in a round of stars
MEETS = 2                # of them that a set is compared with, by either measure
ROUNDS = 2               # of stars; what they leave unconnected is compared in full
BLOCK = 1 << 20
FRAGMENTS_A_PART = 2     # fragments for each partition: what one group holds is small
_TOKEN_BYTES = 6
_LOW = np.uint64((1 << (8 * _TOKEN_BYTES)) - 1)

_RUNS = T.StructType([
    T.StructField("fragment", T.LongType()),
    T.StructField("ids", T.BinaryType()),      # set ids, or document ids where fragment < 0
    T.StructField("sizes", T.BinaryType()),    # set sizes
    T.StructField("counts", T.BinaryType()),   # n-grams of the set in this fragment
    T.StructField("tokens", T.BinaryType()),   # those n-grams, or set ids where fragment < 0
    T.StructField("marks", T.BinaryType()),    # hashes of the documents' texts where fragment < 0
])
_COUNTED = T.StructType([T.StructField("part", T.LongType()), *_RUNS.fields, T.StructField("shared", T.BinaryType())])
_SETS = T.StructType([
    T.StructField("set_id", T.LongType()),
    T.StructField("n", T.LongType()),
    T.StructField("alone", T.LongType()),     # n-grams that no other set holds
    T.StructField("typical", T.LongType()),   # the median of how many sets hold one of its n-grams
    T.StructField("prefix", T.ArrayType(T.LongType())),
    T.StructField("segments", T.ArrayType(T.ArrayType(T.LongType()))),
])


def _pack(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_TOKEN_BYTES].tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    short = np.frombuffer(raw, np.uint8).reshape(-1, _TOKEN_BYTES)
    full = np.zeros((len(short), 8), np.uint8)
    full[:, :_TOKEN_BYTES] = short
    return full.view("<u8").reshape(-1)


def _column(table: pa.Table, name: str, kind) -> np.ndarray:
    cells = [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]
    return np.concatenate(cells) if cells else np.zeros(0, kind)


def _cut(fragments: int, width: int):
    """Documents to their sets' segments, one row a fragment and block of texts.

    A set's id is a digest of its n-grams, so copies have one id wherever they are met; a task
    passes each set on once.  Texts without a column of marks are all marked 0.  Rows with a negative fragment say which set each document has; they are
    spread over as many groups as there are fragments.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            doc_ids, *told = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 2) if c < batch.num_columns]
            marks = told[0] if told else np.zeros_like(doc_ids)
            for block in arrowtext.blocks(batch.column(1), BLOCK):
                grams, offsets = arrowtext.shingles(*arrowtext.words(block), width)
                ids, sizes, parts, fresh = [], [], [], []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    one = np.unique(grams[a:b])
                    digest = hashlib.blake2b(one.tobytes(), digest_size=8).digest()
                    key = int.from_bytes(digest, "little", signed=True)
                    ids.append(key)
                    sizes.append(len(one))
                    if len(one) and key not in seen:
                        seen.add(key)
                        parts.append(one)
                        fresh.append(len(ids) - 1)
                own, mark = [x[block.first : block.first + block.rows] for x in (doc_ids, marks)]
                rows = [(-1 - _spread(own, fragments), own.tobytes(),
                         np.array(sizes, np.int32).tobytes(), b"", np.array(ids, np.int64).tobytes(), mark.tobytes())]
                if parts:
                    rows += _segments(np.array(ids, np.int64)[fresh], parts, fragments)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] + [pa.binary()] * 5)], names=_RUNS.names
                )

    return run


def _spread(docs: np.ndarray, groups: int) -> int:
    """The group that takes a block's memberships: blocks are dealt out by their first document."""
    return int(arrowtext.mix(docs[:1].astype(np.int64).view(np.uint64))[0] % np.uint64(groups))


def _segments(ids: np.ndarray, parts: list[np.ndarray], fragments: int) -> list[tuple]:
    sizes = np.array([len(p) for p in parts], np.int32)
    tokens = np.concatenate(parts)
    owner = np.repeat(np.arange(len(parts)), sizes)
    fragment = ((tokens >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(fragment, kind="stable")
    fragment, owner, tokens = fragment[order], owner[order], tokens[order]
    edges = np.searchsorted(fragment, np.arange(fragments + 1))
    rows = []
    for f in np.flatnonzero(np.diff(edges)).tolist():
        a, b = edges[f], edges[f + 1]
        own, counts = np.unique(owner[a:b], return_counts=True)
        rows.append((f, ids[own].tobytes(), sizes[own].tobytes(), counts.astype(np.int32).tobytes(), _pack(tokens[a:b]), b""))
    return rows


def _count(parts: int):
    """One fragment: in how many sets each n-gram is; those in more than one, dealt out by set."""

    def run(table: pa.Table) -> pa.Table:
        fragment = table.column("fragment")[0].as_py()
        if fragment < 0:
            rows = zip(*[table.column(c).to_pylist() for c in _RUNS.names])
            return _table([(-1, *row, b"") for row in rows])
        ids, first = np.unique(_column(table, "ids", np.int64), return_index=True)
        counts = _column(table, "counts", np.int32)
        run_of = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        once = np.zeros(len(counts), bool)  # a set that several tasks met counts once
        once[first] = True
        kept = once[run_of]
        tokens = _unpack(b"".join(table.column("tokens").to_pylist()))
        if not once.all():
            tokens, run_of = tokens[kept], run_of[kept]
        del kept
        order = np.argsort(tokens).astype(np.int32 if len(tokens) < 1 << 31 else np.int64)
        ordered = tokens[order]
        edges = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, np.int64)
        times = np.diff(np.append(edges, len(ordered)))
        shared = np.empty(len(tokens), np.int32)
        shared[order] = np.repeat(times.astype(np.int32), times)
        del order, ordered, edges
        more = shared > 1
        tokens, run_of, shared = tokens[more], run_of[more], shared[more]
        all_ids, sizes = _column(table, "ids", np.int64), _column(table, "sizes", np.int32)
        del table
        part = (arrowtext.mix(all_ids.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((run_of, part[run_of]))
        tokens, run_of, shared = tokens[order], run_of[order], shared[order]
        edges = np.searchsorted(part[run_of], np.arange(parts + 1))
        rows = []
        for p in np.flatnonzero(np.diff(edges)).tolist():
            a, b = edges[p], edges[p + 1]
            runs, many = np.unique(run_of[a:b], return_counts=True)
            rows.append((p, fragment, all_ids[runs].tobytes(), sizes[runs].tobytes(), many.astype(np.int32).tobytes(),
                         _pack(tokens[a:b]), b"", shared[a:b].astype(np.int64).tobytes()))
        return _table(rows)

    return run


def _table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int64(), pa.int64()] + [pa.binary()] * 6
    columns = list(zip(*rows)) if rows else [()] * 8
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=_COUNTED.names)


def _survivors(fragments: int, percent: int):
    """The sets of one part that share enough n-grams with others, with prefix and segments."""

    def run(table: pa.Table) -> pa.Table:
        ids, counts = _column(table, "ids", np.int64), _column(table, "counts", np.int32)
        low = _unpack(b"".join(table.column("tokens").to_pylist()))
        shared = _column(table, "shared", np.int64)
        fragment = np.concatenate([
            np.full(len(x) // _TOKEN_BYTES, f, np.int64)
            for f, x in zip(table.column("fragment").to_pylist(), table.column("tokens").to_pylist())
        ])
        keys, first, run_set = np.unique(ids, return_index=True, return_inverse=True)
        n = _column(table, "sizes", np.int32)[first].astype(np.int64)
        owner = np.repeat(run_set, counts)
        held = np.bincount(owner, minlength=len(keys))
        stays = 100 * held >= percent * n
        kept = stays[owner]
        owner, low, shared, fragment = owner[kept], low[kept], shared[kept], fragment[kept]
        # beyond 65,536 fragments the upper bits of a fragment fall away; what is left still has 57 bits at 100 TB
        token = ((fragment.astype(np.uint64) << np.uint64(8 * _TOKEN_BYTES)) | low).view(np.int64)
        rows = np.flatnonzero(stays)
        place = np.cumsum(stays) - 1
        owner = place[owner]
        n, held = n[rows], held[rows]
        alone = n - held
        # n - ceil(percent * n / 100) + 1 n-grams, of which those that no other set holds come first
        length = n - -(-percent * n // 100) + 1 - alone
        order = np.lexsort((token, shared, owner))
        start = np.concatenate(([0], np.cumsum(held)))
        typical = shared[order][start[:-1] + n // 2 - alone] if len(rows) else n
        rank = np.arange(len(order)) - start[owner[order]]
        prefix = token[order][rank < length[owner[order]]]
        segment = fragment * SEGMENTS // fragments
        order = np.lexsort((token, segment, owner))
        many = np.bincount(owner * SEGMENTS + segment, minlength=len(rows) * SEGMENTS)
        inner = pa.ListArray.from_arrays(pa.array(_offsets(many), pa.int32()), pa.array(token[order], pa.int64()))
        return pa.table(
            [pa.array(keys[rows], pa.int64()), pa.array(n, pa.int64()), pa.array(alone, pa.int64()), pa.array(typical, pa.int64()),
             pa.ListArray.from_arrays(pa.array(_offsets(length), pa.int32()), pa.array(prefix, pa.int64())),
             pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * SEGMENTS, pa.int32()), inner)],
            names=_SETS.names,
        )

    return run


def _offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)))


def _memberships(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = pa.Table.from_batches([batch])
        yield pa.RecordBatch.from_arrays(
            [pa.array(_column(table, "ids", np.int64)), pa.array(_column(table, "sizes", np.int32).astype(np.int64)),
             pa.array(_column(table, "tokens", np.int64)), pa.array(_column(table, "marks", np.int64))],
            names=["doc", "n", "set_id", "mark"],
        )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, n_a, n_b) whose summed partial overlaps reach the similarity.

    Prefixes alone rule most out: what the set whose prefix ends first shares beyond that end can't be
    more than the rest of it.
    """
    prefix = sets.select("set_id", "prefix")
    pairs = pairs.join(prefix.select(F.col("set_id").alias("b"), F.col("prefix").alias("prefix_b")), "b").join(
        prefix.select(F.col("set_id").alias("a"), F.col("prefix").alias("prefix_a")), "a")
    beyond = F.greatest(*[F.ceil(percent * F.col(n) / 100) - 1 for n in ("n_a", "n_b")])
    most = F.size(F.array_intersect("prefix_a", "prefix_b")) + beyond
    pairs = pairs.filter((100 + percent) * most >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b", "n_a", "n_b")
    # a pair of small sets travels with all its segments in one row, a pair with a large set with one segment a row
    pairs = pairs.withColumn("cut", F.greatest("n_a", "n_b") > WHOLE)
    whole = sets.filter(F.col("n") <= WHOLE).select("set_id", F.lit(False).alias("cut"), F.lit(0).alias("row"), "segments")
    large = sets.filter(100 * F.col("n") >= percent * WHOLE)  # the smaller set of a large pair is no smaller
    parts = whole.unionByName(large.select("set_id", F.lit(True).alias("cut"), F.posexplode("segments").alias("row", "tokens")).select(
        "set_id", "cut", "row", F.array("tokens").alias("segments")))
    one = parts.select(F.col("set_id").alias("a"), "cut", "row", F.col("segments").alias("of_a"))
    two = parts.select(F.col("set_id").alias("b"), "cut", "row", F.col("segments").alias("of_b"))
    overlaps = F.zip_with("of_a", "of_b", lambda x, y: F.size(F.array_intersect(x, y)))
    partial = pairs.join(two, ["b", "cut"]).join(one, ["a", "cut", "row"]).select(
        "a", "b", "n_a", "n_b", F.aggregate(overlaps, F.lit(0), lambda total, n: total + n).cast("long").alias("overlap")
    )
    summed = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap"))
    return summed.filter(100 * F.col("overlap") >= percent * (F.col("n_a") + F.col("n_b") - F.col("overlap")))


def _fits(percent: int, n_a, n_b):
    """Set sizes that can reach the similarity at all."""
    return (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b))


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, component) for the nodes of edges (a, b); a component is named by its least node.

    Alternates large and small stars: each round hangs the neighbours of a node on the least of
    them, until nothing changes.  Only counts and sums reach the driver.
    """
    spark = edges.sparkSession
    now = written(edges.select("a", "b").filter("a <> b").distinct(), f"{folder}/0")
    state, step = None, 0
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        step += 1
        now = written(small.filter("a <> b").distinct(), f"{folder}/{step}")
        seen = now.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    named = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return named.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def link_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """Each document with the size of its n-gram set and the class of documents it is linked with.

    Words are what stands between ASCII white space, A-Z lower-cased.  A set holds the distinct runs
    of ``width`` words; a shorter text is one run; a text without words has an empty set and no link.
    Two documents are linked if 100 * intersection >= ``percent`` * union; the class is the smallest
    id reachable over links.  Returns (id, n_shingles, component_id), a row for each row of ``docs``.

    Null texts count as empty.  Rows with a null id can't be named by a link: they are returned with
    null in the other columns.  Repeated ids stay repeated; equal texts have one set and one class.
    Ids are integers.  Other columns of ``docs`` are not read.  N-grams and sets are told apart by
    64-bit hashes.  The docs should be a stored table, so that a repeated task reads the same rows.
    """
    out = _classes(docs, id_col, text_col, width, percent).select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
    nameless = docs.filter(F.col(id_col).isNull()).select(
        F.lit(None).cast("long").alias(id_col), F.lit(None).cast("long").alias("n_shingles"),
        F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(nameless)


def _mark(text_col: str):
    """What tells the texts of rows with one id apart."""
    return F.xxhash64(F.col(text_col).cast("string"))


def _classes(docs: DataFrame, id_col: str, text_col: str, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc, n, set_id, mark, component_id) for each row with an id."""
    spark = docs.sparkSession
    folder = work_folder(spark)
    picked = docs.select(
        F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"), _mark(text_col).alias("mark"))
    partitions = arrowtext.parts_of(picked)
    fragments = FRAGMENTS_A_PART * partitions
    cut = picked.filter("doc IS NOT NULL").mapInArrow(_cut(fragments, width), _RUNS)
    with arrowtext.small_batches(spark):
        counted = written(arrowtext.dealt(cut, "fragment", partitions).groupBy("fragment").applyInArrow(_count(fragments), _COUNTED), f"{folder}/counted")
    sets = written(
        arrowtext.dealt(counted.filter("part >= 0"), "part", partitions).groupBy("part").applyInArrow(_survivors(fragments, percent), _SETS),
        f"{folder}/sets",
    )
    members = written(
        counted.filter("part < 0").select("ids", "sizes", "tokens", "marks").mapInArrow(_memberships, "doc long, n long, set_id long, mark long"),
        f"{folder}/members",
    )
    drop = lambda name: drop_folder(spark, f"{folder}/{name}")
    drop("counted")
    postings = written(
        sets.select("set_id", "n", "alone", "typical", F.posexplode("prefix").alias("at", "token"))
        .select("token", "set_id", "n", "alone", "typical", (F.col("alone") + F.col("at")).alias("at")),
        f"{folder}/postings",
    )

    # rounds of stars: every set against the centres it shares most of its prefix with; each round
    # takes other centres, and only n-grams whose sets are not one class
    tested = links = None
    placed = postings.withColumns({"component": F.col("set_id"), "largest": F.lit(None).cast("long")})
    for step in range(ROUNDS):
        found = _stars(placed, CENTRES * step, percent)
        if tested is not None:
            found = found.join(tested.select("a", "b"), ["a", "b"], "left_anti")
        found = written(found, f"{folder}/stars-{step}")
        new = written(_verified(found, sets, percent), f"{folder}/links-{step}").select("a", "b")
        tested = found if tested is None else tested.unionByName(found)
        links = new if links is None else links.unionByName(new)
        known = components(links, f"{folder}/classes-{step}").select(F.col("node").alias("set_id"), "component")
        placed = written(_mixed(placed.select(*postings.columns), known), f"{folder}/placed-{step}")
        drop(f"placed-{step - 1}" if step else "postings")

    # what shares a prefix n-gram and is not connected yet: all pairs outside the group's largest class
    x = placed.filter("component <> largest").select(
        "token", "largest", F.col("set_id").alias("x"), F.col("n").alias("n_x"), F.col("at").alias("at_x"), F.col("component").alias("c_x"))
    y = placed.select("token", F.col("set_id").alias("y"), F.col("n").alias("n_y"), F.col("at").alias("at_y"), F.col("component").alias("c_y"))
    room = F.least(F.col("n_x") - F.col("at_x"), F.col("n_y") - F.col("at_y"))
    apart = x.join(y, "token").filter(
        (F.col("c_x") != F.col("c_y"))
        & ((F.col("c_y") == F.col("largest")) | (F.col("x") < F.col("y")))
        & _fits(percent, F.col("n_x"), F.col("n_y"))
        & ((100 + percent) * room >= percent * (F.col("n_x") + F.col("n_y")))
    )
    rest = _pairs(apart, F.col("x"), F.col("n_x"), F.col("y"), F.col("n_y"), percent)
    rest = written(rest.join(tested.select("a", "b"), ["a", "b"], "left_anti"), f"{folder}/rest")
    more = written(_verified(rest, sets, percent), f"{folder}/more")
    drop("sets")
    final = written(
        components(links.unionByName(more.select("a", "b")), f"{folder}/final"), f"{folder}/named")

    # from sets back to documents
    named = members.filter("n > 0").groupBy("set_id").agg(F.min("doc").alias("doc")).join(
        final.select(F.col("node").alias("set_id"), "component"), "set_id", "left"
    ).select("set_id", "doc", F.coalesce("component", "set_id").alias("component"))
    named = written(named, f"{folder}/docs")
    least = named.groupBy("component").agg(F.min("doc").alias("component_id"))
    of_set = written(named.join(least, "component").select("set_id", "component_id"), f"{folder}/of_set")
    out = members.join(of_set, "set_id", "left").select(
        "doc", "n", "set_id", "mark",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc")).alias("component_id"),
    )
    out = written(out, f"{folder}/out")
    of_rounds = [f"{name}-{k}" for name in ("stars", "links", "classes", "placed") for k in range(ROUNDS)]
    for name in ("members", "rest", "more", "final", "named", "docs", "of_set", *of_rounds):
        drop(name)
    return out


def _stars(placed: DataFrame, seed: int, percent: int) -> DataFrame:
    """Pairs of a set and the centres, of other classes, that stand for most of its prefix n-grams.

    An n-gram's centres are the least of its sets in some orders of all sets, so sets that share much
    have few centres between them.  The first is the set whose n-grams most others hold: what has been
    edited least is nearest to all its copies.  A set meets those it shares most n-grams with, and
    those it shares the rarest with.
    """
    own = F.floor(100 * F.col("alone") / F.col("n")).cast("int")
    order = [
        F.struct((own if k % 2 == 0 else F.lit(0)).alias("own"), (-F.col("typical") if k == 0 else F.lit(0)).alias("rank"), F.xxhash64(F.lit(seed + k), "set_id").alias("o"),
                 "set_id", "n", "component")
        for k in range(CENTRES)
    ]
    centres = placed.groupBy("token").agg(F.count("*").alias("many"), F.array_distinct(F.array(*[F.min(o) for o in order])).alias("c"))
    centres = centres.filter("many > 1").select("token", "many", F.explode("c").alias("c")).select(
        "token", "many", F.col("c.set_id").alias("c_id"), F.col("c.n").alias("c_n"), F.col("c.component").alias("c_component"))
    met = placed.join(centres, "token").filter(
        (F.col("component") != F.col("c_component")) & _fits(percent, F.col("n"), F.col("c_n")))
    votes = met.groupBy("set_id", "n", "c_id", "c_n").agg(F.count("*").alias("votes"), F.min("many").alias("rarest"))
    own = Window.partitionBy("set_id")
    chosen = votes.withColumns({
        "most": F.row_number().over(own.orderBy(F.desc("votes"), "c_id")),
        "near": F.row_number().over(own.orderBy("rarest", F.desc("votes"), "c_id")),
    }).filter((F.col("most") <= MEETS) | (F.col("near") <= MEETS))
    return _pairs(chosen, F.col("c_id"), F.col("c_n"), F.col("set_id"), F.col("n"), percent)


def _mixed(postings: DataFrame, known: DataFrame) -> DataFrame:
    """The postings of n-grams whose sets are of several classes, with the set's and the largest class."""
    placed = postings.join(known, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    per_class = placed.groupBy("token", "component").agg(F.count("*").alias("many"))
    mixed = per_class.groupBy("token").agg(
        F.count("*").alias("classes"), F.max_by("component", F.struct("many", "component")).alias("largest")
    ).filter("classes > 1").select("token", "largest")
    return placed.join(mixed, "token")


def _pairs(rows: DataFrame, one, n_one, two, n_two, percent: int) -> DataFrame:
    """Distinct pairs (a < b) with their sizes, if the sizes allow a link."""
    first = one < two
    return rows.filter(_fits(percent, n_one, n_two)).select(
        F.when(first, one).otherwise(two).alias("a"), F.when(first, two).otherwise(one).alias("b"),
        F.when(first, n_one).otherwise(n_two).alias("n_a"), F.when(first, n_two).otherwise(n_one).alias("n_b"),
    ).distinct()


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class of linked rows: the one with the smallest id (then the smallest text hash).

    Rows are told apart by id and text, so an id that stands on several texts keeps or loses each of
    them on its own, and no text goes without a linked one that stays.  Of repeated rows with one id
    and one text one stays.  Rows without an id and texts without words all stay.
    """
    own = [F.col("doc"), F.col("mark")]
    rows = _classes(docs, id_col, text_col).filter("n > 0").groupBy("component_id", "set_id", *own).agg(F.count("*").alias("many"))
    # a class can hold several sets under its smallest id: the least of (id, text hash) names the row that stays
    first = rows.groupBy("component_id").agg(F.min(F.struct(*own)).alias("first"))
    judged = rows.join(first, "component_id").select(
        *own, "many", (F.struct(*own) == F.col("first")).alias("stays"))
    judged = written(judged, work_folder(docs.sparkSession))
    marked = docs.withColumn("_mark", _mark(text_col))
    same = lambda x: (marked[id_col] == x["doc"]) & (marked["_mark"] == x["mark"])
    gone, again = judged.filter("NOT stays"), judged.filter("stays AND many > 1")
    left = marked.join(gone, same(gone), "left_anti")
    once = left.join(again, same(again), "left_anti")
    repeated = left.join(again, same(again), "left_semi").dropDuplicates([id_col, "_mark"])
    return once.unionByName(repeated).drop("_mark").select(*docs.columns)
