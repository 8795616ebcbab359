"""Removing repeats from streams and tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.operators.groups import first_by


def collapse_repeats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop repeats inside each Arrow batch of a task, before any shuffle.

    A streaming dedup has no map-side step of its own: every repeat of a hot key
    would travel to the one task that holds the key's state. This keeps the first
    row of each key per batch (``spark.sql.execution.arrow.maxRecordsPerBatch``).
    """
    columns = list(keys)

    def first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows < 2:
                yield batch
                continue
            position = pa.array(np.arange(batch.num_rows))
            keyed = pa.table([batch.column(c) for c in columns] + [position], columns + ["__row"])
            first = keyed.group_by(columns).aggregate([("__row", "min")])
            rows = first["__row_min"].combine_chunks()
            yield batch if len(rows) == batch.num_rows else batch.take(rows)

    return df.mapInArrow(first_rows, df.schema)


def dedup(
    df: DataFrame,
    keys: Sequence[str],
    within: str | None = None,
    delay: str = "1 hour",
    collapse: bool = False,
) -> DataFrame:
    """First arrival per ``keys``; NULL equals NULL.

    On a stream the state of ``keys`` is kept for ever, unless ``within`` names a time
    column: then a repeat is known for ``delay`` behind the latest time, and its state goes
    once a later trigger has moved the watermark past it. ``collapse`` drops repeats inside
    each Arrow batch first (see ``collapse_repeats``), which pays where keys are hot.
    """
    if not df.isStreaming:
        return df.dropDuplicates(list(keys))
    if collapse:
        df = collapse_repeats(df, keys)
    if within is not None:
        # Set here, as the Arrow step does not carry a watermark.
        return df.withWatermark(within, delay).dropDuplicatesWithinWatermark(list(keys))
    return df.dropDuplicates(list(keys))


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Batch dedup whose survivor is fixed: lowest ``order`` columns, then all others."""
    return first_by(df, keys, [F.col(c).asc() for c in order] or [F.lit(0)], order)
