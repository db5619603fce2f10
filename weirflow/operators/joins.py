"""Joins the refinement jobs are made of.

No join here hints a broadcast.  A side is broadcast when its known or run-time size is under
``spark.sql.autoBroadcastJoinThreshold``; beyond that the same plan is a sort-merge join whose
skewed partitions adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.operators.versions import newest


def with_client(df: DataFrame, clients: DataFrame, on: str = "client") -> DataFrame:
    """Inner join to the client dimension: rows of unknown clients go."""
    return df.join(clients, on, "inner")


def with_lookup(
    df: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str],
    columns: Mapping[str, str],
    order: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Left join to the newest version of a lookup.

    ``on`` maps df columns to lookup columns, ``columns`` maps lookup columns to output names.
    The lookup is reduced to one row per key first, so the join never multiplies rows: the newest
    under ``order``, or without one the greatest by its columns.
    """
    keys = list(on.values())
    latest = newest(lookup, keys, order or [])
    right = latest.select(
        *[F.col(k).alias(f"_lk_{i}") for i, k in enumerate(keys)],
        *[F.col(c).alias(name) for c, name in columns.items()],
    )
    condition = None
    for i, left in enumerate(on):
        test = F.col(left) == F.col(f"_lk_{i}")
        condition = test if condition is None else condition & test
    return df.join(right, condition, "left").drop(*[f"_lk_{i}" for i in range(len(keys))])


def polymorphic_lookup(
    df: DataFrame,
    type_col: str,
    key_col: str,
    lookups: Mapping[str, tuple[DataFrame, str, str]],
    out: str,
) -> DataFrame:
    """A key whose table is named by a type column.

    ``lookups`` maps a type value to (frame, key column, value column).  All lookups become one
    (type, key, value) relation, so the fact side is joined once, however many types there are.
    Types without a lookup, and keys without a match, give null.
    """
    parts = [
        frame.select(
            F.lit(kind).alias("_kind"),
            F.col(key).alias("_key"),
            F.col(value).alias(out),
        )
        for kind, (frame, key, value) in lookups.items()
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    condition = (F.col(type_col) == F.col("_kind")) & (F.col(key_col) == F.col("_key"))
    return df.join(every, condition, "left").drop("_kind", "_key")


def enrich(
    facts: DataFrame, *dimensions: tuple[DataFrame, str], strict: bool = False
) -> DataFrame:
    """Facts with the columns of each (dimension, key); a later side's columns win.

    Rows without a match are dropped, or fail the job with ``strict``.
    """
    out = facts
    for dimension, key in dimensions:
        taken = [c for c in out.columns if c != key and c in dimension.columns]
        side = dimension.withColumn("_hit", F.lit(True))
        joined = out.drop(*taken).join(side, key, "left" if strict else "inner")
        if strict:
            missing = F.raise_error(F.concat(F.lit(f"no {key} = "), F.col(key).cast("string")))
            joined = joined.filter(F.coalesce(F.col("_hit"), missing.cast("boolean")))
        out = joined.drop("_hit")
    return out


def link_entities(
    entities: DataFrame,
    statuses: DataFrame,
    people: DataFrame,
    links: DataFrame,
    person_id: str,
    source_table: str,
    processed: Sequence[str] = ("processed",),
) -> DataFrame:
    """New (entity_id, person_id) rows: same client and e-mail, from a processed file, for
    entities that have no link yet."""
    files = (
        statuses.filter(
            F.col("status").isin(*processed) & F.col("end_date").isNull() & (F.col("table") == source_table)
        )
        .select("client", "file")
    )
    unlinked = entities.join(links.select("entity_id"), "entity_id", "left_anti")
    return (
        unlinked.join(files, ["client", "file"])
        .join(people.select("client", "email", person_id), ["client", "email"])
        .select("entity_id", person_id)
    )


def person_profiles(
    entities: DataFrame,
    links: DataFrame,
    scores: Mapping[str, tuple[DataFrame, str]],
    person_id: str,
    client: str | None = None,
    ids: DataFrame | None = None,
) -> DataFrame:
    """One nested profile per linked person; a person without a score keeps a null there.

    ``scores`` maps an output column to (score frame, its value column).  The client and id
    filters run before the score joins.
    """
    base = entities if client is None else entities.filter(F.col("client") == client)
    wanted = links if ids is None else links.join(ids, person_id, "left_semi")
    out = base.join(wanted, "entity_id").select(
        person_id,
        "entity_id",
        F.struct("entity_id", "email", "phone", "twitter").alias("entity"),
    )
    for name, (frame, value) in scores.items():
        out = out.join(frame.select("entity_id", F.col(value).alias(name)), "entity_id", "left")
    return out.drop("entity_id")
