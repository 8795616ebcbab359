"""Event times that never run backwards: an event behind an earlier arrival takes over the latest time seen so far."""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator
from functools import partial
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# The processor travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKET_SECONDS = 600
_KEY, _BUCKET, _BEFORE = "__key", "__bucket", "__before"
# Rows of one key as a block: their times as 64-bit numbers, and all their columns as compressed Arrow.
_TIMED = "times binary, rows binary"
_BLOCK = f"{_KEY} string, arrivals binary, {_TIMED}"
_NEVER = np.iinfo(np.int64).min
_EPOCH = dt.datetime(1970, 1, 1)


def _micros(column: pa.Array) -> bytes:
    times = column.cast(pa.timestamp("us", getattr(column.type, "tz", None))).cast(pa.int64())
    return pc.fill_null(times, _NEVER).to_numpy(zero_copy_only=False).tobytes()


def _packed(ts: str, arrival: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block for each key of a batch."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        keys = batch.column(_KEY).dictionary_encode()
        plain = batch.select([n for n in batch.schema.names if n != _KEY])
        blocks = []
        for number, key in enumerate(keys.dictionary.to_pylist()):
            rows = plain.filter(pc.equal(keys.indices, number))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=options) as writer:
                writer.write_batch(rows)
            blocks.append((key, _micros(rows.column(arrival)), _micros(rows.column(ts)), sink.getvalue().to_pybytes()))
        kinds = (pa.string(), pa.binary(), pa.binary(), pa.binary())
        columns = [pa.array([b[i] for b in blocks], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, [_KEY, "arrivals", "times", "rows"])


def _unpacked(ts: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the blocks with their new times."""
    for batch in batches:
        for times, packed in zip(batch.column("times"), batch.column("rows")):
            rows = pa.ipc.open_stream(packed.as_buffer()).read_next_batch()
            new = np.frombuffer(times.as_buffer(), np.int64)
            place = rows.schema.get_field_index(ts)
            column = pa.array(new, pa.int64(), mask=new == _NEVER).cast(rows.schema.field(place).type)
            yield rows.set_column(place, rows.schema.field(place), column)


class _Latest(StatefulProcessor):
    """The latest event time of one partition."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", "at timestamp")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        # A trigger's rows stay compressed; only their times are laid out.
        blocks = [block for part in rows for block in zip(part["arrivals"], part["times"], part["rows"])]
        arrivals, times = (np.frombuffer(b"".join(b[i] for b in blocks), np.int64) for i in (0, 1))
        order = np.lexsort((times, arrivals))
        known = self.latest.get()
        before = _NEVER
        if known is not None:
            before = (pd.Timestamp(known[0]).tz_localize(None) - pd.Timestamp(_EPOCH)) // pd.Timedelta(microseconds=1)
        running = np.maximum(np.maximum.accumulate(times[order]), before)
        latest = int(running[-1])
        if latest != _NEVER:
            self.latest.update((_EPOCH + dt.timedelta(microseconds=latest),))
        changed = np.empty_like(times)
        changed[order] = running
        changed[times == _NEVER] = _NEVER
        start = 0
        for _, old, packed in blocks:
            end = start + len(old) // 8
            yield pd.DataFrame({"times": [changed[start:end].tobytes()], "rows": [packed]})
            start = end

    def close(self) -> None:
        pass


def in_order(
    df: DataFrame, ts: str, partition: str, arrival: str, bucket_seconds: int = BUCKET_SECONDS
) -> DataFrame:
    """``df`` with ``ts`` raised to the greatest one among the arrivals of its ``partition`` so far.

    Arrivals are ordered by ``arrival`` (NULL first), those of one instant by ``ts``. Rows without ``ts`` keep none.

    A batch finds the latest time before each bucket of arrivals from one row per bucket, and only orders rows within
    a bucket, so a partition with any share of the rows spreads over its buckets. A stream keeps one time per partition
    and orders the rows of a trigger, of which a task holds the times (16 bytes a row) and compressed blocks; what comes in
    later triggers counts as arriving later. ``partition`` is a whole number.
    """
    if df.isStreaming:
        keyed = df.withColumn(_KEY, F.coalesce(F.col(partition).cast("string"), F.lit("")))
        blocks = keyed.mapInArrow(partial(_packed, ts, arrival), _BLOCK)
        timed = blocks.groupBy(_KEY).transformWithStateInPandas(_Latest(), _TIMED, "Append", "None")
        return timed.mapInArrow(partial(_unpacked, ts), df.schema)
    # Plain keys, so that one shuffle serves the join and the window.
    keyed = df.withColumns(
        {
            _KEY: F.coalesce(F.col(partition).cast("string"), F.lit("")),
            _BUCKET: F.coalesce(F.floor(F.unix_seconds(F.col(arrival)) / bucket_seconds), F.lit(-(2**62))),
        }
    )
    earlier = Window.partitionBy(_KEY).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    buckets = keyed.groupBy(_KEY, _BUCKET).agg(F.max(ts).alias("__most"))
    buckets = buckets.select(_KEY, _BUCKET, F.max("__most").over(earlier).alias(_BEFORE))
    within = Window.partitionBy(_KEY, _BUCKET).orderBy(F.col(arrival).asc_nulls_first(), F.col(ts).asc_nulls_first())
    running = F.max(ts).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    latest = F.when(F.col(ts).isNotNull(), F.greatest(F.col(_BEFORE), running))
    return keyed.join(buckets, [_KEY, _BUCKET]).withColumn(ts, latest).select(*df.columns)
