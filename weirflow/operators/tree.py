"""The sponsor tree: edges, ancestor paths, generations.

All measures walk *up*: every user carries the path of its sponsors, so a step adds one column
entry per user and never multiplies rows.  Users without a sponsor left are scattered over
lanes in the step's join instead of meeting on a null key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.lineage import cut_lineage
from weirflow.operators.skew import lane, only_lane

GENERATIONS = 6
CLIENT = "client_partition_id"  # ids are unique, and sponsor each other, within a client only


def sponsor_edges(users: DataFrame, id_col: str = "tree_user_id", sponsor_col: str = "sponsor_id") -> DataFrame:
    """(client, user_id, sponsor_id) where both ends exist; id 0 sponsors nobody it does not name."""
    nodes = users.select(CLIENT, F.col(id_col).alias("sponsor_id")).distinct()
    edges = users.select(CLIENT, F.col(id_col).alias("user_id"), F.col(sponsor_col).alias("sponsor_id"))
    real = edges.filter(F.col("sponsor_id").isNotNull() & (F.col("user_id") != 0))
    return real.join(nodes, [CLIENT, "sponsor_id"], "left_semi").select(CLIENT, "user_id", "sponsor_id")


def neighbours(edges: DataFrame) -> DataFrame:
    """(client, user_id, neighbour_id, relation): each edge seen from both ends."""
    up = edges.select(CLIENT, "user_id", F.col("sponsor_id").alias("neighbour_id"), F.lit("sponsor").alias("relation"))
    down = edges.select(
        CLIENT, F.col("sponsor_id").alias("user_id"), F.col("user_id").alias("neighbour_id"), F.lit("child").alias("relation")
    )
    return up.unionByName(down)


def _step(left: DataFrame, right: DataFrame) -> DataFrame:
    """Extend each path by the path of its last element."""
    anchor = F.element_at("path", -1)["user_id"]
    keyed = left.withColumn("_anchor", F.when(F.col("open"), anchor))
    keyed = keyed.withColumn("_lane", lane(F.col("_anchor"), F.col("user_id")))
    side = right.select(
        CLIENT,
        F.col("user_id").alias("_anchor"),
        only_lane(F.col("user_id")).alias("_lane"),
        F.col("path").alias("_more"),
        F.col("open").alias("_more_open"),
    )
    # an id seen before closes a cycle: the path ends in front of it
    seen = F.array_append(F.transform("path", lambda p: p["user_id"]), F.col("user_id"))
    more = F.coalesce(F.col("_more"), F.array().cast(left.schema["path"].dataType))
    joined = keyed.join(side, [CLIENT, "_anchor", "_lane"], "left").withColumns({"_seen": seen, "_more": more})
    fresh = F.filter("_more", lambda p: ~F.array_contains(F.col("_seen"), p["user_id"]))
    joined = joined.withColumn("_fresh", fresh)
    still_open = F.coalesce(F.col("_more_open"), F.lit(False)) & (F.size("_fresh") == F.size("_more"))
    return joined.select(CLIENT, "user_id", F.concat("path", "_fresh").alias("path"), still_open.alias("open"))


def _start(edges: DataFrame, attributes: DataFrame | None) -> DataFrame:
    """Paths of length one; ``attributes`` (client, user_id, ...) are carried with each ancestor."""
    if attributes is None:
        step = F.struct(F.col("sponsor_id").alias("user_id"))
        return edges.select(CLIENT, "user_id", F.array(step).alias("path"), F.lit(True).alias("open"))
    names = [c for c in attributes.columns if c not in (CLIENT, "user_id")]
    joined = edges.join(attributes.withColumnRenamed("user_id", "sponsor_id"), [CLIENT, "sponsor_id"])
    step = F.struct(F.col("sponsor_id").alias("user_id"), *names)
    return joined.select(CLIENT, "user_id", F.array(step).alias("path"), F.lit(True).alias("open"))


def sponsor_paths(
    edges: DataFrame, depth: int = GENERATIONS, attributes: DataFrame | None = None
) -> DataFrame:
    """(client, user_id, path): the sponsor, the sponsor's sponsor and so on, ``depth`` levels at most.

    Paths of a power of two are put together, each cut by a checkpoint: six levels are three joins.
    """
    powers = [_start(edges, attributes)]  # powers[k]: paths of up to 2**k
    while 2 << (len(powers) - 1) <= depth:
        powers.append(cut_lineage(_step(powers[-1], powers[-1])))
    paths, reach = powers[-1], 1 << (len(powers) - 1)
    for k in range(len(powers) - 2, -1, -1):
        if reach + (1 << k) <= depth:
            paths, reach = _step(paths, powers[k]), reach + (1 << k)
    return paths.select(CLIENT, "user_id", "path")


def all_sponsor_paths(
    edges: DataFrame, attributes: DataFrame | None = None, max_depth: int | None = None
) -> DataFrame:
    """Paths to the root.  Each round doubles the length, so the rounds are the logarithm of
    the tree's depth; a checkpoint after each keeps the plan small and survives lost executors.

    Cycles end, so the rounds do too; where a ``max_depth`` is given, a deeper tree fails.
    """
    paths = cut_lineage(_start(edges, attributes))
    reach = 1
    while not paths.filter("open").limit(1).isEmpty():
        if max_depth is not None and reach >= max_depth:
            raise ValueError(f"the tree is deeper than {max_depth}")
        paths = cut_lineage(_step(paths, paths))
        reach *= 2
    return paths.select(CLIENT, "user_id", "path")


def closure(paths: DataFrame) -> DataFrame:
    """(upline_id, user_id, depth, ...): one row per ancestor and descendant, with the frame's
    other columns and the ancestor's carried ones as ``upline_...``."""
    own = [c for c in paths.columns if c not in ("user_id", "path")]
    rows = paths.select("user_id", *own, F.posexplode("path").alias("_at", "_up"))
    carried = [f.name for f in paths.schema["path"].dataType.elementType.fields if f.name != "user_id"]
    return rows.select(
        F.col("_up.user_id").alias("upline_id"),
        "user_id",
        (F.col("_at") + 1).cast("long").alias("depth"),
        *own,
        *[F.col(f"_up.{c}").alias(f"upline_{c}") for c in carried],
    )


def refresh_closure(stored: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """The closure (client, upline_id, user_id, depth) after a change of sponsors.

    ``stored`` is the closure of the edges ``before``.  Users whose edge came, went or moved, and
    everybody below them, are affected; only their pairs are taken out and made anew.  Their new
    paths are walked among themselves up to the first user that is not affected, and go on with what
    is stored of that one.  All other pairs stay as they are.  Sponsors form a tree.
    """
    was, now = [e.select(CLIENT, "user_id", F.col("sponsor_id").alias(name)) for e, name in ((before, "_was"), (after, "_now"))]
    moved = was.join(now, [CLIENT, "user_id"], "full").filter(~F.col("_was").eqNullSafe(F.col("_now"))).select(CLIENT, "user_id")
    below = stored.join(moved.withColumnRenamed("user_id", "upline_id"), [CLIENT, "upline_id"]).select(CLIENT, "user_id")
    affected = cut_lineage(moved.unionByName(below).distinct())
    kept = stored.join(affected, [CLIENT, "user_id"], "left_anti").select(CLIENT, "upline_id", "user_id", "depth")
    paths = all_sponsor_paths(after.join(affected, [CLIENT, "user_id"], "left_semi"))
    top = paths.select(CLIENT, "user_id", F.element_at("path", -1)["user_id"].alias("_top"), F.size("path").alias("_reach"))
    known = kept.select(CLIENT, "upline_id", F.col("user_id").alias("_top"), "depth")
    beyond = top.join(known, [CLIENT, "_top"]).select(CLIENT, "upline_id", "user_id", (F.col("_reach") + F.col("depth")).cast("long").alias("depth"))
    return kept.unionByName(closure(paths).select(CLIENT, "upline_id", "user_id", "depth")).unionByName(beyond)


def per_generation(value: Column, depth: Column, name: str, how: str, only: Column | None = None,
                   generations: int = GENERATIONS) -> list[Column]:
    """One aggregate per generation: ``name`` holds ``{g}`` where the generation goes."""
    out = []
    for g in range(1, generations + 1):
        test = (depth == g) if only is None else (depth == g) & only
        picked = F.when(test, value)
        agg = F.count(picked) if how == "count" else F.sum(picked)
        out.append(agg.alias(name.format(g=g)))
    return out
