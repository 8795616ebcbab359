"""Line-separated JSON listings in nested landing folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vitrine import schemas


def listing_batch(spark: SparkSession, path: str) -> DataFrame:
    """All listing files under ``path`` at any depth."""
    return spark.read.schema(schemas.LISTING).option("recursiveFileLookup", "true").json(path)


def listing_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """New listing files under ``path``; the query's checkpoint remembers the old ones."""
    reader = spark.readStream.schema(schemas.LISTING).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


QUALITY = "quality"
GOOD, RESCUED, BAD = "good", "rescued", "bad"
_CORRUPT = "__corrupt"


def checked_lines(lines: DataFrame) -> DataFrame:
    """Lines of listing files, read with nothing lost: batch or stream.

    Columns: those of a listing, ``file``, ``text`` (of lines that are no listing), ``rescued`` (JSON of the
    fields that a listing has no column for) and ``quality``: ``bad`` is no JSON object, ``rescued`` has such fields.
    Blank lines are left out, as the JSON source does.
    """
    text = F.col("value")
    whole = F.from_json(text, "map<string,string>", {"mode": "PERMISSIVE"})
    strict = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = F.from_json(text, T.StructType([*schemas.LISTING.fields, T.StructField(_CORRUPT, T.StringType())]), strict)
    known = F.array(*[F.lit(n) for n in schemas.LISTING.names])
    rows = lines.where(F.trim(text) != "").select(
        text.alias("line"), F.col("_metadata.file_path").alias("file"), parsed.alias("row"), whole.alias("whole")
    )
    bad = F.col("whole").isNull() | F.col(f"row.{_CORRUPT}").isNotNull()
    more = F.map_filter("whole", lambda k, _: ~F.array_contains(known, k))
    return rows.select(
        *[F.when(~bad, F.col(f"row.{n}")).alias(n) for n in schemas.LISTING.names],
        "file",
        F.when(bad, F.col("line")).alias("text"),
        F.when(~bad & (F.size(more) > 0), F.to_json(more)).alias("rescued"),
        F.when(bad, BAD).when(F.size(more) > 0, RESCUED).otherwise(GOOD).alias(QUALITY),
    )


def checked_stream(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_age: str | None = None,
    archive: str | None = None,
) -> DataFrame:
    """``checked_lines`` of new files under ``path``.

    Files older than ``max_age`` against the newest are not taken in; files that are done move to ``archive``.
    """
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_age:
        reader = reader.option("maxFileAge", max_age)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return checked_lines(reader.text(path))


def write_checked(checked: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Sort a checked stream into folders by quality, in one pass and exactly once."""
    writer = checked.writeStream.format("parquet").option("checkpointLocation", checkpoint).partitionBy(QUALITY)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path)


def good_listings(spark: SparkSession, path: str) -> DataFrame:
    """Listings of a checked folder, those with rescued fields too."""
    return spark.read.parquet(path).where(F.col(QUALITY) != BAD).select(*schemas.LISTING.names)


def quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are no listing, with their file."""
    return spark.read.parquet(path).where(F.col(QUALITY) == BAD).select("file", "text")


def dataset(spark: SparkSession, name: str) -> DataFrame:
    """A stored dataset by name, always read in full."""
    return spark.table(name)
