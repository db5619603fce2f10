"""Nested arrays, first and last rows per group, wide-to-long scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weirflow.lineage import work_folder, written
from weirflow.operators.positions import positions
from weirflow.operators.skew import hot_keys

ARRAY_LIMIT = 100_000


def nest(
    df: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str | Column],
    out: str,
    limit: int = ARRAY_LIMIT,
    counted: DataFrame | None = None,
    whole: int = ARRAY_LIMIT,
) -> DataFrame:
    """Array of structs per key, sorted by the struct's fields, in slices of ``limit`` elements.

    The grain is (key, slice).  Slice 0 holds the first ``limit`` elements in the array's order, slice 1
    the next, and so on: each slice but a key's last is full, the slices put together are the
    whole array, and a key up to the limit has one.  Keys of up to ``whole`` elements are collected and cut
    into slices where they lie; no task holds more of a larger one than a slice.  ``parent_and_rest``
    splits them into the row of the key and its continuation rows.  ``counted`` is a cheaper frame with
    at least the same rows per key, such as the table that ``df`` was computed from.
    """
    rows = df.select(*keys, F.struct(*fields).alias("_element"))
    whole = max(limit, whole)
    sliced = _ranked_slices(rows, keys, limit, whole, (df if counted is None else counted).select(*keys))
    nested = sliced.groupBy(*keys, "slice").agg(F.sort_array(F.collect_list("_element")).alias(out))
    if limit == whole:
        return nested
    # the slices of a key that was collected whole; those of larger ones are no longer than the limit
    at = F.expr(f"sequence(0, CAST((size(`{out}`) - 1) div {limit} AS INT))")
    cut = nested.select(*keys, "slice", out, F.explode(at).alias("_at"))
    return cut.select(*keys, (F.col("slice") + F.col("_at")).alias("slice"), F.expr(f"slice(`{out}`, _at * {limit} + 1, {limit})").alias(out))


def _ranked_slices(rows: DataFrame, keys: Sequence[str], limit: int, whole: int, counted: DataFrame) -> DataFrame:
    """``rows`` (keys, _element) with ``slice``: 0 for keys of up to ``whole`` rows, else by the element's place.

    Only rows of hot keys are placed, by range over many partitions.
    """
    hot = written(hot_keys(counted, keys, whole), work_folder(rows.sparkSession)).select(*keys)
    if hot.isEmpty():
        return rows.withColumn("slice", F.lit(0))
    met = None
    for k in keys:
        same = rows[k].eqNullSafe(hot[k])
        met = same if met is None else met & same
    placed = positions(rows.join(hot, met, "left_semi"), ["_element"], keys, "_place")
    number = F.expr(f"CAST((_place - 1) div {limit} AS INT)")
    return rows.join(hot, met, "left_anti").withColumn("slice", F.lit(0)).unionByName(
        placed.withColumn("slice", number).drop("_place"))


def parent_and_rest(nested: DataFrame, keys: Sequence[str], out: str) -> tuple[DataFrame, DataFrame]:
    """One stored result of ``nest`` as two tables: (keys, out) with each key's first slice, one row a key,
    and (keys, slice, out) with the slices behind it.  Nothing is in both, and nothing in neither."""
    stored = written(nested, work_folder(nested.sparkSession))
    return stored.filter("slice = 0").select(*keys, out), stored.filter("slice > 0").select(*keys, "slice", out)


def nest_many(
    parts: Mapping[str, tuple[DataFrame, Sequence[str]]],
    keys: Sequence[str],
    limit: int = ARRAY_LIMIT,
) -> DataFrame:
    """Several arrays per key side by side: ``{column: (frame, fields)}``, empty where missing.

    All parts are tagged into one relation and grouped once instead of nested one by one and
    joined.  Slices follow the rule of ``nest`` for each array: slice 0 holds the first ``limit``
    elements of each, slice 1 the next of those that are longer.
    """
    tagged = None
    for name, (frame, fields) in parts.items():
        part = frame.select(
            *keys, F.lit(name).alias("_array"),
            F.struct(*[(F.struct(*fields) if other == name else F.lit(None)).alias(other) for other in parts]).alias("_element"))
        tagged = part if tagged is None else tagged.unionByName(part)
    sliced = _ranked_slices(tagged, [*keys, "_array"], limit, limit, tagged.select(*keys, "_array"))
    # collect_list skips nulls, so each array holds only its own part
    return sliced.groupBy(*keys, "slice").agg(
        *[F.sort_array(F.collect_list(F.col(f"_element.{name}"))).alias(name) for name in parts]
    )


def unnest(df: DataFrame, array_col: str, keep: Sequence[str], outer: bool = False) -> DataFrame:
    """One row per array element with the element's fields as columns."""
    explode = F.explode_outer if outer else F.explode
    dtype = df.schema[array_col].dataType.elementType
    rows = df.select(*keep, explode(array_col).alias("_e"))
    if isinstance(dtype, T.StructType):
        return rows.select(*keep, *[F.col(f"_e.{f.name}") for f in dtype.fields])
    return rows.withColumnRenamed("_e", array_col)


def first_of(value: Column, order: Sequence[str], when: Column | None = None) -> Column:
    """Value of the first row under ``order`` among the rows where ``when`` holds."""
    rank = F.struct(*order)
    return F.min_by(value, rank if when is None else F.when(when, rank))


def last_of(
    value: Column, order: Sequence[str], when: Column | None = None, legacy: bool = False
) -> Column:
    """Value of the last row among those where ``when`` holds.

    ``legacy`` looks at the very last row only, and is null unless ``when`` holds for it.
    """
    rank = F.struct(*order)
    if when is None:
        return F.max_by(value, rank)
    if legacy:
        return F.max_by(F.when(when, value), rank)
    return F.max_by(value, F.when(when, rank))


def scores_from_wide(
    df: DataFrame, id_col: str, label: str, value: str, value_type: str | None = None
) -> DataFrame:
    """A wide row of scores -> ``scores``: array of (label, value), one per non-id column."""
    others = [c for c in df.columns if c != id_col]
    items = [
        F.struct(
            F.lit(c).alias(label),
            (F.col(f"`{c}`").cast(value_type) if value_type else F.col(f"`{c}`")).alias(value),
        )
        for c in others
    ]
    return df.select(id_col, F.array(*items).alias("scores"))


def scores_from_json(
    df: DataFrame, json_col: str, id_field: str, label: str, value: str, value_type: str | None = None
) -> DataFrame:
    """The same for rows that arrive as JSON text with an open set of fields."""
    as_map = F.from_json(F.col(json_col), "map<string,string>")
    entries = F.map_entries(F.map_filter(as_map, lambda k, _: k != id_field))
    items = F.transform(
        entries,
        lambda e: F.struct(
            e["key"].alias(label),
            (e["value"].cast(value_type) if value_type else e["value"]).alias(value),
        ),
    )
    return df.select(as_map[id_field].alias(id_field), items.alias("scores"))
