"""Batched calls to a score service from executors.

The client function is passed in: it takes a list of ids and returns (status code, rows).
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from weirflow.functions.fixed import LOOKUP_EMPTY_CODES

# executors get these functions by value: the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Fetch = Callable[[list[str]], tuple[int, list[dict]]]


def batches(ids: list, size: int) -> Iterator[list]:
    for at in range(0, len(ids), size):
        yield ids[at : at + size]


def rows_of(status: int, rows: list[dict], ids: list) -> list[dict]:
    """The answer's rows; none for the codes that say so; any other code fails the task."""
    if status in LOOKUP_EMPTY_CODES:
        return []
    if status == 200:
        return rows
    raise RuntimeError(f"score lookup failed with status {status} for {len(ids)} ids")


def batched_lookup(
    ids: DataFrame, fetch: Fetch, batch_size: int = 500, partitions: int | None = None,
    id_col: str = "entity_id",
) -> DataFrame:
    """(entity_id, answer): one row per answered id, ``answer`` being the row as JSON text.

    Ids are spread over tasks and posted in batches of ``batch_size``; a batch never holds more
    than that, however many ids one task has.  ``partitions`` bounds the parallel calls.
    """
    spread = ids.select(F.col(id_col).cast("string").alias(id_col)).distinct()
    if partitions:
        spread = spread.repartition(partitions, id_col)

    def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[str] = []
        for frame in frames:
            waiting.extend(frame[id_col].tolist())
            full = len(waiting) - len(waiting) % batch_size
            for batch in batches(waiting[:full], batch_size):
                yield _answer(fetch, batch, id_col)
            waiting = waiting[full:]
        if waiting:
            yield _answer(fetch, waiting, id_col)

    return spread.mapInPandas(call, f"{id_col} string, answer string")


def _answer(fetch: Fetch, batch: list[str], id_col: str) -> pd.DataFrame:
    status, rows = fetch(batch)
    found = rows_of(status, rows, batch)
    return pd.DataFrame(
        {id_col: [str(r[id_col]) for r in found], "answer": [json.dumps(r) for r in found]},
        dtype=object,
    )
