"""Landing files written by number of rows or by age, whichever comes first.

Rows wait as JSON lines in the state of their lane. A lane writes as soon as it holds enough rows, and what it
holds when its oldest row has waited long enough. Lanes keep a hot hour from one task: a lane holds fewer rows than
a flush needs. Lines come to their lane, and leave it, as compressed blocks, as a lane's task sorts all that a trigger
brings; the lines of the flushes are then spread over all tasks, where they are sorted into folders.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from vitrine import fixed_values as fixed
from vitrine.sinks.inbound import FOLDER

# The processor travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LANES = 8
BY_ROWS, BY_AGE = "rows", "age"
_FLUSHED = "folder string, line string, lane long, flush long, reason string"
# Lines as compressed text, each behind its folder and a tab: JSON has no line end or tab of its own.
_LINES = "lane long, size long, lines binary"
_BLOCK = "lane long, flush long, reason string, size long, lines binary"


def _compressed(lines: list[str]) -> tuple[int, bytes]:
    text = "\n".join(lines).encode()
    return len(text), pa.compress(text, "zstd", asbytes=True)


def _lines(size: int, compressed: Any) -> list[str]:
    return pa.decompress(compressed, size, "zstd", asbytes=True).decode().split("\n")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each lane in a batch as one row."""
    for batch in batches:
        lanes = batch.column("lane").dictionary_encode(null_encoding="encode")
        lines = pc.binary_join_element_wise(pc.fill_null(batch.column("folder"), ""), batch.column("line"), "\t")
        found = [
            (lane, *_compressed(lines.filter(pc.equal(lanes.indices, number)).to_pylist()))
            for number, lane in enumerate(lanes.dictionary.to_pylist())
        ]
        kinds = (pa.int64(), pa.int64(), pa.binary())
        columns = [pa.array([row[i] for row in found], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["lane", "size", "lines"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            folders, lines = zip(*[line.split("\t", 1) for line in _lines(row["size"], row["lines"])])
            n = len(lines)
            columns = [pa.array([f or None for f in folders], pa.string()), pa.array(lines, pa.string())]
            for name, kind in (("lane", pa.int64()), ("flush", pa.int64()), ("reason", pa.string())):
                columns.append(pa.array([row[name]] * n, kind))
            yield pa.RecordBatch.from_arrays(columns, ["folder", "line", "lane", "flush", "reason"])


class _Buffer(StatefulProcessor):
    """The waiting rows of one lane."""

    def __init__(self, rows: int, age_ms: int) -> None:
        self.least, self.age_ms = rows, age_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # A trigger's rows are one entry: entries are costly, and most triggers only add one.
        self.waiting = handle.getListState("waiting", "rows string")
        self.about = handle.getValueState("about", "n long, flushes long, due long")

    def _held(self) -> list[str]:
        return [row for entry in self.waiting.get() for row in entry[0].split("\n")]

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        n, flushes, due = self.about.get() or (0, 0, 0)
        before, new = n, []
        for size, lines in ((size, lines) for part in rows for size, lines in zip(part["size"], part["lines"])):
            new.extend(_lines(size, lines))
            if n + len(new) >= self.least and n:
                new, n = [*self._held(), *new], 0
                self.waiting.clear()
            while len(new) >= self.least:
                now, new = new[: self.least], new[self.least :]
                yield _written(now, key[0], flushes, BY_ROWS)
                flushes += 1
        if not before or not n:
            # What waits now is new: its age begins.
            if due:
                self.handle.deleteTimer(due)
            due = timerValues.getCurrentProcessingTimeInMs() + self.age_ms if new else 0
            if due:
                self.handle.registerTimer(due)
        if new:
            self.waiting.appendValue(("\n".join(new),))
        self.about.update((n + len(new), flushes, due))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        n, flushes, _ = self.about.get() or (0, 0, 0)
        if n:
            yield _written(self._held(), key[0], flushes, BY_AGE)
            self.waiting.clear()
            self.about.update((0, flushes + 1, 0))

    def close(self) -> None:
        pass


def _written(rows: list[str], lane: int, flush: int, reason: str) -> pd.DataFrame:
    size, lines = _compressed(rows)
    return pd.DataFrame({"lane": [lane], "flush": [flush], "reason": [reason], "size": [size], "lines": [lines]})


def flushed(
    df: DataFrame,
    ts: str,
    rows: int = fixed.FLUSH_ROWS,
    age_seconds: float = fixed.FLUSH_SECONDS,
    lane: Column | None = None,
    keep_ts: bool = False,
) -> DataFrame:
    """The stream ``df`` as JSON lines (NULL fields as keys) in the order of their flushes.

    Columns: folder, line, and lane, flush, reason, which say what was written together. ``ts`` chooses the folder;
    ``lane`` (a whole number) says which rows wait together.
    """
    fields = [F.col(c) for c in df.columns if keep_ts or c != ts]
    line = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    lines = df.select(F.date_format(F.col(ts), fixed.FOLDER_FORMAT).alias(FOLDER), line.alias("line"), *([lane.cast("long").alias("lane")] if lane is not None else []))
    if lane is None:
        lines = lines.withColumn("lane", F.pmod(F.xxhash64("line"), F.lit(LANES)))
    buffer = _Buffer(rows, int(age_seconds * 1000))
    blocks = lines.mapInArrow(_packed, _LINES)
    flushes = blocks.groupBy("lane").transformWithStateInPandas(buffer, _BLOCK, "Append", "ProcessingTime")
    return flushes.repartition("lane", "flush").mapInArrow(_unpacked, _FLUSHED)


def write_flushed(
    flushes: DataFrame, path: str, checkpoint: str, every: str = "1 second", by_flush: bool = False
) -> StreamingQuery:
    """Append the flushes under ``path/folder=<date>_<hour>``; the stream looks for due rows at every ``every``.

    ``by_flush`` adds folders for lane, flush and reason.
    """
    parts = [FOLDER, *(["lane", "flush", "reason"] if by_flush else [])]
    return (
        flushes.select(*parts, F.col("line").alias("value"))
        .writeStream.format("text")
        .outputMode("append")
        .partitionBy(*parts)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start(path)
    )
