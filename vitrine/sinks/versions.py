"""Views published as a whole: each rewrite is a folder of its own, and one change of location makes it visible.

Readers see the rows of the last complete version at any time. Old versions stay for queries that have begun on them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from vitrine.sinks.tables import clustered

KEPT = 2


def _folder(spark: SparkSession, path: str):
    """Hadoop's path and file system of a folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[str]:
    """Folders of all versions under ``root``, oldest first."""
    where, files = _folder(spark, root)
    if not files.exists(where):
        return []
    names = [s.getPath().getName() for s in files.listStatus(where) if s.isDirectory()]
    return [f"{root}/{n}" for n in sorted(n for n in names if n.startswith("v-"))]


def remove_versions(spark: SparkSession, root: str, keep: int) -> None:
    """Delete all but the ``keep`` latest versions."""
    for path in versions(spark, root)[: -keep or None]:
        where, files = _folder(spark, path)
        files.delete(where, True)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _default_root(spark: SparkSession, target: str) -> str:
    database, _, table = target.rpartition(".")
    location = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{location.rstrip('/')}/{table}"


def publish_view(
    df: DataFrame,
    target: str,
    comment: str | None = None,
    cluster_by: Sequence[str] = (),
    root: str | None = None,
    keep: int = KEPT,
) -> None:
    """Replace the rows of the Parquet table ``target`` at once; ``df`` may read ``target``.

    The rows are written to a new folder under ``root`` (the database's folder by default) before the table points to
    it. A version that fails half way is never seen. ``keep`` versions stay, the current one included. With other columns
    than before the table is created anew, which readers may notice.
    """
    spark = df.sparkSession
    root = root or _default_root(spark, target)
    # Names sort by time, so the oldest can be told.
    version = f"{root}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    rows = clustered(df, cluster_by) if cluster_by else df
    rows.write.parquet(version)
    if spark.catalog.tableExists(target):
        stored = [(f.name, f.dataType) for f in spark.table(target).schema]
        if stored == [(f.name, f.dataType) for f in df.schema]:
            spark.sql(f"ALTER TABLE {target} SET LOCATION '{_quoted(version)}'")
        else:
            spark.sql(f"DROP TABLE {target}")
    if not spark.catalog.tableExists(target):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        spark.sql(f"CREATE TABLE {target} ({columns}) USING parquet LOCATION '{_quoted(version)}'")
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {target} IS '{_quoted(comment)}'")
    remove_versions(spark, root, keep)
