"""Conversations as a prefix trie, measured by the Euler-tour technique.

A node is a distinct sequence of first turns.  Each node has an enter and an exit arc; the arc that
follows an arc is the enter arc of the first child or of the next sibling, or an exit arc, so all arcs
form one list.  The list is ranked in rounds: a random half of the arcs absorb their followers
from the other half, until few are left; then the rounds are undone, the last one first, and each
absorbed arc gets its place from the arc that absorbed it.  What stands between a node's two arcs
is its subtree: differences of prefix sums at the two places are sums over the subtree, however deep
or wide the trie is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from weirflow.lineage import drop_folder, work_folder, written

SIBLINGS = 4_096        # nodes a bucket of a parent's children: what one sort of siblings sees
FINISH = 1 << 14        # arcs that one task ranks at the end
#: what is summed along the tour: the arcs themselves, leaves entered, tokens saved
SUMS = ("steps", "leaves", "saved")
_ENTER, _EXIT = "+", "-"
_NO_END = hashlib.sha256(b"").hexdigest()


def digests(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv, at, d1, d2, chars): each turn's place in its conversation, two hashes of it, its text's code points.

    Turns are ordered by ``turn_col``, null first; ties by role, then by the hash of the turn.  Null
    roles and texts become empty.  Rows without a conversation's id belong to none and are left out;
    repeated rows are turns of their own.  Other columns are not read, and texts are not shuffled.
    """
    role, text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col)]
    rows = turns.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.xxhash64(F.lit(1), role, text).alias("d1"), F.xxhash64(F.lit(2), role, text).alias("d2"),
        F.char_length(text).cast("long").alias("chars"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "d1", "d2")
    return rows.select("conv", F.row_number().over(order).alias("at"), "d1", "d2", "chars")


def _prefixes(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv, node, parent, depth, chars, ends): one row for each conversation and node on its path.

    A node is named by two 64-bit sums over (depth, turn); the root, the prefix without turns, by zeros.
    """
    top = conversations.select("conv", F.lit(0).alias("at"), *[F.lit(0).cast("long").alias(c) for c in ("d1", "d2", "chars")])
    path = Window.partitionBy("conv").orderBy("at")
    placed = top.unionByName(turns.select("conv", F.col("at").cast("int"), "d1", "d2", "chars")).withColumn(
        "depth", (F.row_number().over(path) - 1).cast("long"))
    own = placed.withColumns({
        f"x{k}": F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(F.xxhash64("depth", f"d{k}")) for k in (1, 2)})
    far = path.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keyed = own.withColumns({f"k{k}": F.bit_xor(f"x{k}").over(far) for k in (1, 2)})
    name = lambda one, two: F.concat(*[F.lpad(F.hex(c), 16, "0") for c in (one, two)])
    return keyed.select(
        "conv", name(F.col("k1"), F.col("k2")).alias("node"),
        F.when(F.col("depth") > 0, name(F.col("k1").bitwiseXOR(F.col("x1")), F.col("k2").bitwiseXOR(F.col("x2")))).alias("parent"),
        "depth", "chars", F.lead("depth").over(path).isNull().alias("ends"))


_RUNS = "node string, first long, many long, ids string"


def _end_digests(ends: DataFrame) -> DataFrame:
    """(node, n_ends, ends_sha256) of (node, conv): the digest of the ascending ids, joined by commas.

    Ids are sorted by range, so those of a node where a third of all conversations end are put into
    runs by many tasks.  The runs, a row for some thousand ids, stream through the node's hash in
    their order: that takes time, as any such digest does, but no memory.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows, a = [], 0
            while a < len(nodes):
                b = a
                while b < len(nodes) and nodes[b] == nodes[a]:
                    b += 1
                rows.append((nodes[a], ids[a], b - a, ",".join(map(str, ids[a:b]))))
                a = b
            yield _batch(rows, (pa.string(), pa.int64(), pa.int64(), pa.string()), ["node", "first", "many", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, names = (pa.string(), pa.int64(), pa.string()), ["node", "n_ends", "ends_sha256"]
        node, many, state = None, 0, None
        for batch in batches:
            done = []
            for own, more, text in zip(*[batch.column(c).to_pylist() for c in (0, 2, 3)]):
                if own != node:
                    if state is not None:
                        done.append((node, many, state.hexdigest()))
                    node, many, state = own, 0, hashlib.sha256()
                state.update(("," * (many > 0) + text).encode())
                many += more
            yield _batch(done, kinds, names)
        if state is not None:
            yield _batch([(node, many, state.hexdigest())], kinds, names)

    ordered = ends.select("node", "conv").repartitionByRange("node", "conv").sortWithinPartitions("node", "conv")
    runs = ordered.mapInArrow(pack, _RUNS).repartition("node").sortWithinPartitions("node", "first")
    return runs.mapInArrow(digest, "node string, n_ends long, ends_sha256 string")


def _batch(rows: list[tuple], kinds: tuple, names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((),) * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def tour(nodes: DataFrame, buckets: int) -> DataFrame:
    """The arcs (arc, next, steps, leaves, saved) of the Euler tour over (node, parent, chars, n_convs).

    ``next`` is null for the last arc.  Siblings are linked inside buckets of them and then from bucket
    to bucket, so no sort sees all children of one parent.
    """
    below = nodes.filter(F.col("parent").isNotNull()).select(
        "node", "parent", F.pmod(F.xxhash64("node"), F.lit(buckets)).alias("bucket"))
    inside = Window.partitionBy("parent", "bucket").orderBy("node")
    linked = below.withColumns({"sibling": F.lead("node").over(inside), "head": F.first("node").over(inside)})
    across = Window.partitionBy("parent").orderBy("bucket")
    last = linked.filter(F.col("sibling").isNull()).withColumns(
        {"sibling": F.lead("head").over(across), "place": F.row_number().over(across)})
    siblings = linked.filter(F.col("sibling").isNotNull()).select("node", "parent", "sibling").unionByName(
        last.select("node", "parent", "sibling"))
    first = last.filter("place = 1").select(F.col("parent").alias("node"), F.col("head").alias("child"))
    none = F.lit(0).cast("long")
    root = nodes.filter(F.col("parent").isNull()).select("node", F.lit(None).cast("string").alias("parent"), F.lit(None).cast("string").alias("sibling"))
    leaving = siblings.unionByName(root).select(
        F.concat("node", F.lit(_EXIT)).alias("arc"),
        F.when(F.col("sibling").isNotNull(), F.concat("sibling", F.lit(_ENTER))).when(
            F.col("parent").isNotNull(), F.concat("parent", F.lit(_EXIT))).alias("next"),
        F.lit(1).cast("long").alias("steps"), none.alias("leaves"), none.alias("saved"))
    entering = nodes.join(first, "node", "left").select(
        F.concat("node", F.lit(_ENTER)).alias("arc"),
        F.when(F.col("child").isNotNull(), F.concat("child", F.lit(_ENTER))).otherwise(F.concat("node", F.lit(_EXIT))).alias("next"),
        F.lit(1).cast("long").alias("steps"), F.col("child").isNull().cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    return entering.unionByName(leaving)


def ranked(arcs: DataFrame, folder: str, finish: int = FINISH) -> DataFrame:
    """(arc, steps, leaves, saved): for each arc the sums over all arcs before it in the list.

    ``arcs`` has the same columns and ``next``, null at the end of the one list.  A round leaves about
    three quarters of the arcs, so all rounds together move four times the list and back; each is
    written to ``folder``.  At most ``finish`` arcs are ranked in one task.
    """
    now, step = written(arcs, f"{folder}/list-0"), 0
    while now.count() > finish:
        coin = lambda c: F.pmod(F.xxhash64(F.lit(step), c), F.lit(2))
        grows = (coin(F.col("arc")) == 0) & F.col("next").isNotNull() & (coin(F.col("next")) == 1)
        heads = now.filter(grows).select(
            F.col("arc").alias("head"), F.col("next").alias("arc"), *[F.col(c).alias(f"before_{c}") for c in SUMS])
        met = written(now.filter(coin(F.col("arc")) == 1).join(heads, "arc", "left"), f"{folder}/met-{step}")
        absorbed = F.col("head").isNotNull()
        # what a head held, and what it takes over; without a head the arc stays as it is
        kept = met.select(
            F.coalesce("head", "arc").alias("arc"), "next",
            *[F.when(absorbed, F.col(c) + F.col(f"before_{c}")).otherwise(F.col(c)).alias(c) for c in SUMS])
        now = written(now.filter((coin(F.col("arc")) == 0) & ~grows).unionByName(kept), f"{folder}/list-{step + 1}")
        drop_folder(arcs.sparkSession, f"{folder}/list-{step}")
        step += 1

    places = now.groupBy().applyInArrow(_walk, "arc string, steps long, leaves long, saved long")
    places = written(places, f"{folder}/places-{step}")
    for k in reversed(range(step)):
        met = arcs.sparkSession.read.parquet(f"{folder}/met-{k}").filter(F.col("head").isNotNull())
        met = met.select("head", F.col("arc").alias("of"), *[f"before_{c}" for c in SUMS])
        both = places.join(met, places["arc"] == met["head"], "left").select(F.explode(F.array(
            F.struct("arc", *SUMS),
            F.struct(F.col("of").alias("arc"), *[(F.col(c) + F.col(f"before_{c}")).alias(c) for c in SUMS]))).alias("x"))
        places = written(both.select("x.*").filter(F.col("arc").isNotNull()), f"{folder}/places-{k}")
    return places


def _walk(table: pa.Table) -> pa.Table:
    """The sums before each arc of a short list, from its head on."""
    own = {r["arc"]: r for r in table.to_pylist()}
    heads = set(own) - {r["next"] for r in own.values()}
    if len(own) and len(heads) != 1:
        raise ValueError(f"the arcs form {len(heads)} lists, not one")
    out, sums, at = [], [0] * len(SUMS), next(iter(heads), None)
    while at is not None:
        out.append((at, *sums))
        row = own[at]
        sums = [s + row[c] for s, c in zip(sums, SUMS)]
        at = row["next"]
    columns = list(zip(*out)) if out else [()] * 4
    return pa.table([pa.array(c, t) for c, t in zip(columns, [pa.string()] + [pa.int64()] * 3)], names=["arc", *SUMS])


def trie(turns: DataFrame, conversations: DataFrame, finish: int = FINISH) -> DataFrame:
    """One row a node of the trie of (conv, at, d1, d2, chars) over all of ``conversations`` (conv, distinct).

    Returns conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs (members, who
    begin with it), n_children, n_leaves (childless nodes of its subtree, itself included),
    saved_tokens (over the subtree, members but one times the code points of a node's last text),
    n_ends and ends_sha256 (members that end there), first_arc and last_arc (places in the tour, from 0).

    A conversation without turns ends at the root; without conversations there is no node.  Turns are
    told apart by two 64-bit hashes.  Lists, rounds and sums live in the checkpoint folder, so a lost
    executor repeats the step it was part of.
    """
    spark = turns.sparkSession
    folder = work_folder(spark)
    paths = written(_prefixes(turns, conversations), f"{folder}/paths")
    nodes = written(
        paths.groupBy("node", "parent", "depth", "chars").agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")),
        f"{folder}/nodes")
    many = nodes.count()
    places = ranked(tour(nodes, -(-many // SIBLINGS) or 1), f"{folder}/rank", finish)

    named = F.expr("substring(arc, 1, 32)").alias("node")
    leaves, saved, steps = [
        F.sum(F.when(F.col("arc").endswith(_EXIT), F.col(c)).otherwise(-F.col(c))) for c in ("leaves", "saved", "steps")]
    measured = places.groupBy(named).agg(
        leaves.alias("n_leaves"), saved.alias("saved_tokens"), F.min("steps").alias("first_arc"), steps.alias("_span"))
    children = nodes.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    ends = _end_digests(paths.filter("ends"))
    zero = F.lit(0).cast("long")
    out = nodes.join(measured, "node").join(children, "node", "left").join(ends, "node", "left").join(above, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("n_ends", zero).alias("n_ends"), F.coalesce("ends_sha256", F.lit(_NO_END)).alias("ends_sha256"),
        "first_arc", (F.col("first_arc") + F.col("_span")).alias("last_arc"))
    out = written(out, f"{folder}/out")
    for name in ("paths", "nodes", "rank"):
        drop_folder(spark, f"{folder}/{name}")
    return out


def conversation_trie(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The trie of a table of turns; cases as in ``digests`` and ``trie``."""
    own = digests(turns, id_col, turn_col, role_col, text_col)
    ids = turns.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv")).distinct()
    return trie(own, ids)


def with_shared_heads(turns: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt so that many share their first turns: (turns, ids) for ``trie``.

    Of digested turns, a conversation c takes the first h of conversation c - c % ``group`` (all if it has
    fewer, none if it is absent) and then its own after the first h; h is crc32(c) % ``most``.
    """
    ids = turns.select("conv").distinct()
    head = F.crc32(F.col("conv").cast("string")) % most
    lent = turns.filter((F.col("conv") % group == 0) & (F.col("at") < most)).withColumnRenamed("conv", "base")
    heirs = ids.select("conv", (F.col("conv") - F.col("conv") % group).alias("base"), head.alias("h"))
    begun = heirs.join(lent, "base").filter(F.col("at") <= F.col("h")).select("conv", "at", "d1", "d2", "chars")
    return begun.unionByName(turns.filter(F.col("at") > head)), ids
