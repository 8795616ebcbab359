"""Streaming tables and views that are rewritten as a whole."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window


def write_stream_table(
    df: DataFrame,
    target: str,
    checkpoint: str,
    path: str | None = None,
    every: str | None = None,
    compression: str | None = None,
) -> StreamingQuery:
    """Append a stream to the Parquet table ``target``; ``path`` places its files, ``compression`` names their codec."""
    writer = df.writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    if compression is not None:
        writer = writer.option("compression", compression)
    if path is not None:
        writer = writer.option("path", path)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.toTable(target)


def clustered(df: DataFrame, cluster_by: Sequence[str]) -> DataFrame:
    """Rows laid out so that the files of a table cover narrow ranges of ``cluster_by``.

    A hash of the other columns ends the range key: a single value that holds a large
    part of the rows is then cut into several files too.

    Spark samples the ranges by running the plan of ``df`` once more, so costly
    expressions belong after this call, and nothing below it should be observed.
    """
    keys = [F.col(c) for c in cluster_by]
    others = [F.col(c) for c in df.columns if c not in cluster_by]
    spread = [F.xxhash64(*others)] if others else []
    return df.repartitionByRange(*keys, *spread).sortWithinPartitions(*keys)


CURVE_BITS = 6
CURVE_SAMPLE = 8192


def _cuts(df: DataFrame, columns: Sequence[str]) -> list[list]:
    """Values that cut each column into 2 ** CURVE_BITS parts of about the same number of rows.

    They come from the rows with the least hashes, a bounded number. They decide how files are laid out, no row.
    """
    hashed = df.select(*columns, F.xxhash64(*df.columns).alias("__hash"))
    rows = hashed.orderBy("__hash").limit(CURVE_SAMPLE).select(*columns).collect()
    parts = 2**CURVE_BITS
    found = []
    for i in range(len(columns)):
        values = sorted(r[i] for r in rows if r[i] is not None)
        found.append(sorted({values[len(values) * k // parts] for k in range(1, parts)}) if values else [])
    return found


def curve_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """Place of a row on a curve through all of ``columns`` at once: the bits of their parts' numbers in turns.

    NULL counts as the least value.
    """
    def place_among(bounds: Column, name: str) -> Column:
        return F.size(F.filter(bounds, lambda bound: bound <= F.col(name)))

    key = F.lit(0).cast("long")
    for i, (name, cuts) in enumerate(zip(columns, _cuts(df, columns))):
        place = F.lit(0)
        if cuts:
            kind = df.schema[name].dataType
            bounds = F.array(*[F.lit(c).cast(kind) for c in cuts])
            place = F.when(F.col(name).isNull(), F.lit(0)).otherwise(place_among(bounds, name))
        for bit in range(CURVE_BITS + 1):
            on = F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("long")
            key = key.bitwiseOR(F.shiftleft(on, bit * len(columns) + i))
    return key


def clustered_on_each(df: DataFrame, cluster_by: Sequence[str]) -> DataFrame:
    """Rows laid out so that a range of any one of ``cluster_by`` lies in few files.

    ``clustered`` serves the first column; here each serves alike, and the first one less well. A hash of
    the row ends the range key, so rows with equal values can fill several files.
    """
    keyed = df.withColumn("__curve", curve_key(df, cluster_by))
    spread = F.xxhash64(*df.columns)
    return keyed.repartitionByRange(F.col("__curve"), spread).sortWithinPartitions("__curve").drop("__curve")


def files_of_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """How many files of a stored table may hold ``column`` from ``low`` to ``high`` by their least and greatest value.

    One row: ``files``, ``touched_files`` and ``rows`` in the range.
    """
    value = F.col(column)
    inside = value.between(F.lit(low), F.lit(high))
    per_file = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(value).alias("low"), F.max(value).alias("high"), F.count_if(inside).alias("n")
    )
    touched = (F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low))
    return per_file.agg(
        F.count(F.lit(1)).alias("files"), F.count_if(touched).alias("touched_files"), F.sum("n").alias("rows")
    )


def _ends(df: DataFrame, column: str) -> DataFrame:
    """Least and greatest value and number of rows per file, a row for each Arrow batch.

    Spark aggregates text per file by sorting all rows of a task first; after this there is next to nothing to sort.
    """
    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = batch.column("file").dictionary_encode()
            for number, file in enumerate(files.dictionary.to_pylist()):
                values = batch.column("value").filter(pc.equal(files.indices, number))
                least = pc.min_max(values)
                low, high = (pa.array([least[k].as_py()], values.type) for k in ("min", "max"))
                columns = [pa.array([file], pa.string()), low, high, pa.array([len(values)], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["file", "low", "high", "n"])

    kind = df.schema[column].dataType
    schema = T.StructType().add("file", "string").add("low", kind).add("high", kind).add("n", "long")
    return df.select(F.col("_metadata.file_path").alias("file"), F.col(column).alias("value")).mapInArrow(ends, schema)


def overlapping_files(df: DataFrame, column: str) -> DataFrame:
    """How many files of a stored table begin below the end of another, and its rows.

    One row: ``overlapping_files`` and ``rows``. Files that only share a value do not overlap.
    """
    per_file = _ends(df, column).groupBy("file").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    # A row per file. Of disjoint ranges, each ends where or before the next begins.
    before = F.max("high").over(Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))
    ranked = per_file.withColumn("before", before)
    return ranked.agg(
        F.count_if(F.col("before") > F.col("low")).alias("overlapping_files"), F.sum("n").alias("rows")
    )


def write_view(
    df: DataFrame,
    target: str,
    comment: str | None = None,
    cluster_by: Sequence[str] = (),
    path: str | None = None,
) -> None:
    """Replace the Parquet table ``target`` by the rows of ``df``.

    The table is missing or half written until this ends; readers that cannot wait should read
    a copy. ``df`` must not read ``target``.
    """
    if cluster_by:
        df = clustered(df, cluster_by)
    writer = df.write.format("parquet").mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(target)
    if comment is not None:
        text = comment.replace("\\", "\\\\").replace("'", "\\'")
        df.sparkSession.sql(f"COMMENT ON TABLE {target} IS '{text}'")
