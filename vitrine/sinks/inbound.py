"""Landing files: line-separated JSON in one folder per date and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vitrine import fixed_values as fixed
from vitrine.session import ONE_RUN, settings

FOLDER = "folder"


_WRITER = "__writer"


def _landing_rows(df: DataFrame, ts: str, keep_ts: bool, writers: int | None, as_they_lie: bool) -> DataFrame:
    row = [F.col(c) for c in df.columns]
    out = df.withColumn(FOLDER, F.date_format(F.col(ts), fixed.FOLDER_FORMAT))
    if writers is not None:
        salt = F.pmod(F.xxhash64(*row), F.lit(writers))
        out = out.withColumn(_WRITER, salt).repartition(FOLDER, _WRITER).drop(_WRITER)
    elif not df.isStreaming and not as_they_lie:
        out = out.hint("rebalance", FOLDER)
    return out if keep_ts else out.drop(ts)


def write_inbound(
    df: DataFrame,
    path: str,
    ts: str,
    checkpoint: str | None = None,
    keep_ts: bool = False,
    every: str | None = None,
    writers: int | None = None,
    max_rows_per_file: int = 1_000_000,
    continuous: bool = False,
    as_they_lie: bool = False,
    compression: str | None = None,
) -> StreamingQuery | None:
    """Append ``df`` as JSON lines under ``path/folder=<date>_<hour>``.

    ``ts`` chooses the folder. NULL fields are written as keys. A stream needs
    ``checkpoint``; it runs to the end of the input, or flushes at every ``every``.
    ``continuous`` stands for the fixed flush time.

    A batch is rebalanced by folder: adaptive execution merges small hours and splits
    large ones. A trigger of a stream spans an hour or two, so there every task writes
    its own files. ``writers`` gathers each folder in that many tasks instead, where
    a thin stream or a backlog of many hours would leave too many small files. ``as_they_lie`` leaves a batch where
    it is: what lands at one time is one folder, whichever task writes it, and moving the rows first gains nothing.

    ``compression`` names a codec for the files (``gzip`` takes a tenth of the space), which readers tell by their end.
    """
    rows = _landing_rows(df, ts, keep_ts, writers, as_they_lie)
    options = {"ignoreNullFields": "false", "maxRecordsPerFile": str(max_rows_per_file)}
    if compression is not None:
        options["compression"] = compression
    if not df.isStreaming:
        with settings(df.sparkSession, ONE_RUN):
            rows.write.mode("append").partitionBy(FOLDER).options(**options).json(path)
        return None
    if continuous and every is None:
        every = fixed.FLUSH_EVERY
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    writer = (
        rows.writeStream.format("json")
        .outputMode("append")
        .partitionBy(FOLDER)
        .options(**options)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path)
