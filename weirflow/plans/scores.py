"""The score loop: export people, import scores, link, serve profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.functions import fixed
from weirflow.functions.conform import stamp
from weirflow.functions.dates import ts
from weirflow.operators.increments import in_window, not_yet_scored
from weirflow.operators.nesting import scores_from_json
from weirflow.sources.lookup import Fetch, batched_lookup
from weirflow.sources.writers import export_csv_per_client

EXPORT_COLUMNS = {"leads": fixed.LEAD_EXPORT_COLUMNS, "contacts": fixed.CONTACT_EXPORT_COLUMNS}

# model -> (label field, value field, value type) of its score array
ARRAY_MODELS = {
    "match-score": ("client", "score", "int"),
    "adopt-curve": ("corpus", "score", None),
}


def export_people(df: DataFrame, kind: str, path: str, first=None, last=None, closed: str = "half_open") -> None:
    """Leads or contacts of a window as one CSV folder per client."""
    if kind not in EXPORT_COLUMNS:
        raise ValueError(f"unknown export {kind}")
    rows = df if first is None else in_window(df, first, last, closed=closed)
    export_csv_per_client(rows, path, EXPORT_COLUMNS[kind])


def import_scores(
    entities: DataFrame, scored: DataFrame, fetch: Fetch, model: str, as_of: Column, hours: int, batch_time,
    batch_size: int = 500, partitions: int | None = None, fields: str | None = None,
) -> DataFrame:
    """Scores of recent entities the model has not scored yet.

    Models with a score array get ``scores``; for the others ``fields`` is the DDL of the row.
    """
    wanted = not_yet_scored(entities, scored, as_of, hours)
    answers = batched_lookup(wanted, fetch, batch_size, partitions)
    if model in ARRAY_MODELS:
        label, value, kind = ARRAY_MODELS[model]
        rows = scores_from_json(answers, "answer", "entity_id", label, value, kind)
    else:
        rows = answers.select("entity_id", F.from_json("answer", fields).alias("r")).select("entity_id", "r.*")
    return stamp(rows, ingestion_timestamp=ts(batch_time))


def entity_rows(answers: DataFrame, client: str, file: str, batch_time) -> DataFrame:
    """Entities returned for an uploaded file, tagged with it."""
    return stamp(answers, client=F.lit(client), file=F.lit(file), ingestion_timestamp=ts(batch_time))
