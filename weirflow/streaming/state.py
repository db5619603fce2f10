"""The newest version per key as keyed state of a stream, with a timer that lets old keys go."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

BUCKETS = 256  # of keys; a call handles one, so some thousand keys in each are best
_EVENT, _DUE, _NEW, _MOVED, _BUCKET, _NULL = "_event_time", "_due", "_new", "_moved", "_bucket", "_null_"
_LOWEST = -(2**63)


def _filler(dtype: T.DataType) -> Column | None:
    """What stands in a column where its null is flagged beside it."""
    if isinstance(dtype, (T.NumericType, T.BooleanType, T.StringType)):
        return F.lit(0).cast(dtype)
    return F.lit("1970-01-01").cast(dtype) if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)) else None


def _codes(cells: pd.Series) -> np.ndarray:
    """Whole numbers in the order of the cells; a null is lower than any value."""
    if cells.dtype.kind in "iub":
        return cells.to_numpy().astype("int64")
    if cells.dtype.kind == "M":
        return cells.to_numpy(dtype="datetime64[ns]").view("int64")
    return pd.factorize(cells, sort=True)[0].astype("int64")


def _merged(rows: pd.DataFrame, keys: Sequence[str], places: Sequence[str]) -> pd.DataFrame:
    """Of each key the first row that none exceeds under ``places``, with the key's latest event time."""
    flags = {c for c in rows.columns if c.startswith(_NULL) and rows[c].any()}
    by = [*keys, *[_NULL + k for k in keys if _NULL + k in flags]]
    group = rows.groupby(by, dropna=False, sort=False).ngroup().to_numpy()
    many, at = int(group.max(initial=-1)) + 1, np.arange(len(rows))
    for place in places:
        if len(at) == many:
            break
        for column in ([_NULL + place] if _NULL + place in flags else []) + [place]:
            level = _codes(rows[column].iloc[at])
            level = -level if column != place else level
            most = np.full(many, _LOWEST)
            np.maximum.at(most, group[at], level)
            at = at[level == most[group[at]]]
    at = at[np.unique(group[at], return_index=True)[1]]
    out = rows.iloc[at].reset_index(drop=True)
    for column, lowest in ((_EVENT, _LOWEST), (_MOVED, False)):
        cells = rows[column].to_numpy()
        most = np.full(many, lowest, dtype=cells.dtype)
        np.maximum.at(most, group, cells)
        out[column] = most
    return out


def _packed(rows: pd.DataFrame) -> bytes:
    table, sink = pa.Table.from_pandas(rows, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(stored: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(pa.py_buffer(bytes(stored))).read_pandas()


def newest_by_state(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str], event_time: str, lateness: str, keep: str, buckets: int = BUCKETS,
) -> DataFrame:
    """The versions of a change feed that became the newest of their key, in update mode.

    State holds one row a key.  A row replaces it if it is greater under ``order`` (then by its other
    columns); older versions, however late within ``lateness``, change nothing and come out nowhere.
    A key whose newest event lies ``keep`` behind the watermark is dropped from state; the table it was
    written to keeps it.  Rows later than ``lateness`` are dropped by the stream itself, so
    ``lateness`` has to cover what a source may deliver late.  Columns are numbers, texts, booleans or
    times; batches of one bucket stream through its task.

    Keys are dealt into ``buckets`` by their hash.  The rows and timers of a bucket's keys are one value of
    state, which a call reads, follows as a whole and writes: a call for each key would cost more than all
    else.  The number is kept as long as the checkpoint.
    """
    schema = changes.schema
    names = schema.names
    places = [*order, *[c for c in names if c not in order and c not in keys]]
    wait = int(pd.Timedelta(keep).total_seconds() * 1000)
    # pandas would turn whole numbers beside a null into floats, and take the null and the NaN of a key for one
    fillers = {c: _filler(schema[c].dataType) for c in names if c in keys or isinstance(schema[c].dataType, T.IntegralType)}
    fillers = {c: f for c, f in fillers.items() if f is not None}
    # times of the rows as milliseconds: what timers compare with
    fed = changes.withColumn("_at", F.col(event_time).cast("timestamp")).withWatermark("_at", lateness)
    fed = fed.withColumn(_EVENT, F.coalesce(F.unix_millis("_at"), F.lit(_LOWEST)))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias(_BUCKET)
    told = [F.coalesce(c, fillers[c]).alias(c) if c in fillers else F.col(c) for c in names]
    fed = fed.select(*told, *[F.col(c).isNull().alias(_NULL + c) for c in fillers], _EVENT, "_at", bucket)
    wire = T.StructType([*schema.fields, *[T.StructField(_NULL + c, T.BooleanType()) for c in fillers]])
    columns = wire.names

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs()
        best = _unpacked(state.get[0]).assign(**{_NEW: False, _MOVED: False}) if state.exists else None
        if not state.hasTimedOut:
            for frame in frames:
                fresh = frame[[*columns, _EVENT]].assign(**{_DUE: 0, _NEW: True, _MOVED: True})
                # the kept row comes first: an equal one does not replace it
                best = _merged(fresh if best is None else pd.concat([best, fresh], ignore_index=True), keys, places)
        latest = best[_EVENT].where(best[_EVENT] != _LOWEST, 0)
        best[_DUE] = best[_DUE].where(~best[_MOVED], np.maximum(latest + wait, mark + 1))
        newer = best.loc[best[_NEW], columns]
        # a key without rows in this batch whose time is up goes
        best = best[best[_MOVED] | (best[_DUE] >= mark)]
        if best.empty:
            state.remove()
        else:
            state.update((_packed(best.drop(columns=[_NEW, _MOVED])),))
            state.setTimeoutTimestamp(max(int(best[_DUE].min()), 1))
        if len(newer):
            yield newer

    kept = T.StructType([T.StructField("rows", T.BinaryType())])
    newer = fed.groupBy(_BUCKET).applyInPandasWithState(run, wire, kept, "update", GroupStateTimeout.EventTimeTimeout)
    return newer.select(*[F.when(~F.col(_NULL + c), F.col(c)).alias(c) if c in fillers else F.col(c) for c in names])


def write_updates(updates: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each batch's updates to its own folder, so a repeated batch leaves no duplicates; ``newest`` of
    the folders is the table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        updates.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
