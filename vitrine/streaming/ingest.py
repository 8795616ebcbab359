"""Incremental ingest: landing files to the raw listing table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vitrine import fixed_values as fixed
from vitrine.functions.listing import scrape_time
from vitrine.operators.dedup import dedup
from vitrine.operators.quality import BRONZE_RULES, observed
from vitrine.session import ONE_RUN, settings
from vitrine.sinks.tables import write_stream_table
from vitrine.sources.listings import listing_stream

METRICS = "bronze_rules"
SCRAPED_AT = "scraped_at"
# Keys and rows are mostly digits, which lz4 and snappy leave as they are.
_CODEC = "zstd"
# To count the rows of a state costs one more lookup for each new key. The state's changelog is read as a whole and
# compressed well, its local files are looked up by key and stay quick; a checkpoint goes on with the codec it began with.
_STATE = {
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.compression.codec": _CODEC,
}


def bronze_rows(
    stream: DataFrame, within: str | None = None, delay: str = "1 hour", collapse: bool = False
) -> DataFrame:
    """First sight of every advert; a later scrape with the same price, discount and
    instalments is dropped, so ``extract`` tells when the offer was first seen.

    ``within`` and ``delay`` bound the state by a time column, see ``dedup``.
    """
    first = dedup(stream, fixed.STREAM_DEDUP_KEYS, within, delay, collapse)
    return observed(first, BRONZE_RULES, METRICS)


def scraped(stream: DataFrame) -> DataFrame:
    """Raw listings with their scrape time as ``scraped_at``, to bound the state by.

    A text that is no time counts as the start of the era: it is late at once.
    """
    at = F.coalesce(scrape_time(F.col("extract")), F.lit("1970-01-01").cast("timestamp"))
    return stream.withColumn(SCRAPED_AT, at)


def bronze_ingest(
    spark: SparkSession,
    inbound: str,
    target: str,
    checkpoint: str,
    path: str | None = None,
    max_files_per_trigger: int | None = None,
    every: str | None = None,
    delay: str | None = None,
    collapse: bool = False,
) -> StreamingQuery:
    """Run the ingest; rule counts are in the query's progress under ``METRICS``.

    With ``delay`` a repeat is only known for that long behind the latest scrape time, and
    the state of older adverts goes; scrapes that come later than that are dropped.
    """
    stream = listing_stream(spark, inbound, max_files_per_trigger)
    if delay is None:
        rows = bronze_rows(stream, collapse=collapse)
    else:
        rows = bronze_rows(scraped(stream), SCRAPED_AT, delay, collapse).drop(SCRAPED_AT)
    with settings(spark, {**_STATE, **ONE_RUN}):
        return write_stream_table(rows, target, checkpoint, path, every, _CODEC)
