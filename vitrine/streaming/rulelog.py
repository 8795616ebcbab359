"""Rule counts of a stored stream table, as a log with one folder per trigger.

A stream of its own reads what the table has committed, counts every rule in one aggregation per trigger, and
writes the counts to the folder of the trigger's number. A trigger that is repeated after a failure writes the same folder
again, and a restarted driver goes on where the last one stopped: no count is lost or taken twice.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vitrine.operators.quality import expectations

LOG = "expectation string, passed_records long, failed_records long, batch long"


def log_rules(
    rows: DataFrame, rules: Mapping[str, str], log: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Count ``rules`` over the stream ``rows`` into ``log``."""

    def count(batch: DataFrame, number: int) -> None:
        expectations(batch, rules).coalesce(1).write.mode("overwrite").parquet(f"{log}/batch={number}")

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(count)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def last_trigger(spark: SparkSession, log: str) -> int:
    """Number of the last trigger in the log, -1 if there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(log)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []
    return max((int(n[6:]) for n in names if n.startswith("batch=")), default=-1)


def logged(spark: SparkSession, log: str, after: int = -1) -> DataFrame:
    """Passed and failed rows per rule over all triggers, or those after one."""
    if last_trigger(spark, log) <= after:
        return spark.createDataFrame([], "expectation string, passed_records long, failed_records long")
    rows = spark.read.schema(LOG).option("basePath", log).parquet(log).where(F.col("batch") > after)
    return rows.groupBy("expectation").agg(
        F.sum("passed_records").alias("passed_records"), F.sum("failed_records").alias("failed_records")
    )
