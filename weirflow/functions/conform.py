"""Schema-driven conversions, written as column expressions by walking the schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weirflow.functions.fixed import ZERO_DATE

LeafRule = Callable[[Column, T.DataType], Column]


def map_leaves(c: Column, dtype: T.DataType, rule: LeafRule) -> Column:
    """Apply ``rule`` to every non-nested value of ``c``, inside structs and arrays too."""
    if isinstance(dtype, T.StructType):
        fields = [map_leaves(c[f.name], f.dataType, rule).alias(f.name) for f in dtype.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda e: map_leaves(e, dtype.elementType, rule))
    return rule(c, dtype)


def map_frame(df: DataFrame, rule: LeafRule) -> DataFrame:
    """``map_leaves`` over all columns in one projection."""
    return df.select(
        *[map_leaves(F.col(f"`{f.name}`"), f.dataType, rule).alias(f.name) for f in df.schema.fields]
    )


# --- dates -----------------------------------------------------------------------------------

_ZERO = rf"^{ZERO_DATE}([ T]00:00(:00(\.0+)?)?)?( ?(Z|UTC|[+-]\d{{2}}:?\d{{2}}))?$"


def is_zero_date(c: Column, legacy: bool = False) -> Column:
    """Text that as a whole is a zero date, with or without a zero time and a zone.

    ``legacy`` also takes any text that contains one.
    """
    return c.contains(ZERO_DATE) if legacy else c.rlike(_ZERO)


def zero_dates_to_null(df: DataFrame, legacy: bool = False) -> DataFrame:
    """Null for text that is a zero date.  ``legacy`` nulls any text that contains one."""

    def rule(c: Column, dtype: T.DataType) -> Column:
        if not isinstance(dtype, T.StringType):
            return c
        return F.when(is_zero_date(c, legacy), F.lit(None)).otherwise(c)

    return map_frame(df, rule)


def stringify_dates(
    df: DataFrame, date_format: str | None = None, time_format: str | None = None, legacy: bool = False
) -> DataFrame:
    """Dates and timestamps to text at every depth, text that is a zero date to null.

    ``legacy`` nulls any text that contains one.
    """

    def rule(c: Column, dtype: T.DataType) -> Column:
        if isinstance(dtype, T.DateType):
            return F.date_format(c, date_format) if date_format else c.cast("string")
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, time_format) if time_format else c.cast("string")
        if isinstance(dtype, T.StringType):
            return F.when(is_zero_date(c, legacy), F.lit(None)).otherwise(c)
        return c

    return map_frame(df, rule)


def _parse(c: Column, target: T.DataType) -> Column:
    zero = is_zero_date(c)
    if isinstance(target, T.DateType):
        # the local date of the text, whatever its offset
        parsed = F.substring(c, 1, 10).try_cast("date")
    elif isinstance(target, T.TimestampNTZType):
        # the local wall time of the text, whatever its offset
        parsed = F.regexp_replace(c, r"(Z|[+-]\d{2}:?\d{2})$", "").try_cast("timestamp_ntz")
    else:
        parsed = c.try_cast(target)
    return F.when(~zero, parsed)


def parse_dates(df: DataFrame, target: T.StructType, rejects: str | None = None) -> DataFrame:
    """Text to the date types of ``target``, by name and at every depth.

    Text that does not parse becomes null; ``rejects`` names a column that lists the top-level
    columns where that happened, so a caller can set such rows aside.
    """
    wanted = {f.name: f.dataType for f in target.fields}

    def convert(c: Column, have: T.DataType, want: T.DataType | None) -> Column:
        if want is None:
            return c
        if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
            return F.transform(c, lambda e: convert(e, have.elementType, want.elementType))
        if isinstance(have, T.StructType) and isinstance(want, T.StructType):
            inner = {f.name: f.dataType for f in want.fields}
            fields = [convert(c[f.name], f.dataType, inner.get(f.name)).alias(f.name)
                      for f in have.fields]
            return F.when(c.isNotNull(), F.struct(*fields))
        is_date = isinstance(want, (T.DateType, T.TimestampType, T.TimestampNTZType))
        return _parse(c, want) if isinstance(have, T.StringType) and is_date else c

    columns, failed = [], []
    for f in df.schema.fields:
        source = F.col(f"`{f.name}`")
        parsed = convert(source, f.dataType, wanted.get(f.name))
        columns.append(parsed.alias(f.name))
        if isinstance(f.dataType, T.StringType) and parsed is not source:
            bad = source.isNotNull() & ~is_zero_date(source) & parsed.isNull()
            failed.append(F.when(bad, F.lit(f.name)))
    if rejects:
        names = F.array(*failed) if failed else F.array().cast("array<string>")
        columns.append(F.filter(names, lambda n: n.isNotNull()).alias(rejects))
    return df.select(*columns)


# --- other leaves ----------------------------------------------------------------------------


def stringify_decimals(df: DataFrame) -> DataFrame:
    def rule(c: Column, dtype: T.DataType) -> Column:
        return c.cast("string") if isinstance(dtype, T.DecimalType) else c

    return map_frame(df, rule)


def nulls_to_empty(df: DataFrame) -> DataFrame:
    """Every top-level column as text, null as ''."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def booleans_to_ints(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("int").alias(f.name)
            if isinstance(f.dataType, T.BooleanType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --- target schemas --------------------------------------------------------------------------


def conform(df: DataFrame, target: T.StructType, strict: bool = False) -> DataFrame:
    """Columns of ``target`` by name and in its order: missing ones are null, types are cast.

    ``strict`` fails on values that do not cast; otherwise they become null.  Extra columns go.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for f in target.fields:
        if f.name not in have:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] == f.dataType:
            columns.append(F.col(f"`{f.name}`"))
        else:
            c = F.col(f"`{f.name}`")
            nested = isinstance(f.dataType, (T.StructType, T.ArrayType))
            columns.append((c.cast(f.dataType) if strict or nested else c.try_cast(f.dataType))
                           .alias(f.name))
    return df.select(*columns)


def missing_required(df: DataFrame, target: T.StructType) -> Column:
    """True where a required column of ``target`` is null."""
    required = [F.col(f.name).isNull() for f in target.fields if not f.nullable]
    out = F.lit(False)
    for c in required:
        out = out | c
    return out


def with_version_columns(target: T.StructType, extra: T.StructType) -> T.StructType:
    """``target`` plus the required columns it does not have yet."""
    names = set(target.fieldNames())
    return T.StructType(target.fields + [f for f in extra.fields if f.name not in names])


def relax(target: T.StructType, *names: str) -> T.StructType:
    """The named columns made nullable."""
    return T.StructType(
        [T.StructField(f.name, f.dataType, f.nullable or f.name in names) for f in target.fields]
    )


def insert_column(target: T.StructType, field: T.StructField, after: str | None = None) -> T.StructType:
    """``field`` added behind ``after``, or at the end; a name already there is left alone."""
    if field.name in target.fieldNames():
        return target
    at = len(target.fields) if after is None else target.fieldNames().index(after) + 1
    return T.StructType(target.fields[:at] + [field] + target.fields[at:])


def stamp(df: DataFrame, **values: Column) -> DataFrame:
    """Batch columns such as client, event id and ingestion time; the time is a parameter."""
    return df.withColumns(values)
