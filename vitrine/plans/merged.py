"""Marts kept up to date by merging new gold rows, never from the whole history.

One row per code (its latest listing and its lowest price) lies in a table of ``BUCKETS`` partitions by a hash of the
code. A micro-batch is reduced to a row per code, merged with the partitions that its codes fall into, and those are
written to a new folder each; then the partitions point there. Details, products and the suggestion are views of that
table. Work and files per batch follow the touched partitions, not the history.

Merging takes the greatest listing and the least price, so a batch that is repeated after a failure changes nothing.
A partition changes at once; a reader may see some partitions of a batch before others.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vitrine import fixed_values as fixed
from vitrine import schemas
from vitrine.operators.groups import top1_by
from vitrine.plans.marts import OFFER, masked

BUCKETS = 256
BUCKET = "bucket"
_DESCRIBED = [c for c in dict.fromkeys([*schemas.PRODUCTS, *schemas.DETAILS]) if c != "codigo"]


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("codigo"), F.lit(buckets)).cast("int")


def per_code(gold: DataFrame) -> DataFrame:
    """Latest listing, lowest price and whether a price is unknown, per code."""
    price = F.col("preco")
    return gold.groupBy("codigo").agg(
        F.max(F.struct("extract", *_DESCRIBED)).alias("last"),
        F.min(price).alias("preco"),
        F.bool_or(price.isNull()).alias("unknown"),
    )


def _joined(rows: DataFrame) -> DataFrame:
    """Rows of ``per_code`` of several times as one per code."""
    return rows.groupBy("codigo").agg(
        F.max("last").alias("last"), F.min("preco").alias("preco"), F.bool_or("unknown").alias("unknown")
    )


def create_current(spark: SparkSession, target: str, root: str, gold: DataFrame) -> None:
    """The table of current rows, empty, if it is not there."""
    schema = per_code(gold).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {target} ({columns}, {BUCKET} int) USING parquet "
        f"PARTITIONED BY ({BUCKET}) LOCATION '{root}/table'"
    )


def merge(spark: SparkSession, batch: DataFrame, target: str, root: str, buckets: int = BUCKETS) -> list[int]:
    """Merge gold rows into ``target``; the partitions that were touched come back."""
    rows = batch.where(F.col("codigo").isNotNull())
    # A number per partition at most.
    touched = sorted(r[0] for r in rows.select(_bucket(buckets)).distinct().collect())
    if not touched:
        return []
    new = per_code(rows)
    old = spark.table(target).where(F.col(BUCKET).isin(touched)).select(*new.columns)
    path = f"{root}/{uuid.uuid4().hex}"
    merged = _joined(old.unionByName(new)).withColumn(BUCKET, _bucket(buckets))
    merged.write.partitionBy(BUCKET).parquet(path)
    places = {b: (f"PARTITION ({BUCKET}={b})", f"LOCATION '{path}/{BUCKET}={b}'") for b in touched}
    # A name per partition at most.
    there = {int(r[0].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {target}").collect()}
    added = [f"{part} {place}" for b, (part, place) in places.items() if b not in there]
    if added:
        spark.sql(f"ALTER TABLE {target} ADD IF NOT EXISTS {' '.join(added)}")
    for part, place in (places[b] for b in touched if b in there):
        spark.sql(f"ALTER TABLE {target} {part} SET {place}")
    return touched


def merge_stream(
    gold: DataFrame, target: str, root: str, checkpoint: str, buckets: int = BUCKETS, every: str | None = None
) -> StreamingQuery:
    """Merge a stream of gold rows into ``target``."""
    spark = gold.sparkSession
    create_current(spark, target, root, gold)
    writer = gold.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, _: merge(spark, batch, target, root, buckets) and None
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


_FLAT = "SELECT codigo, last.*, CASE WHEN NOT unknown THEN preco END AS preco FROM {current}"
DETAILS_SQL = f"SELECT {', '.join(schemas.DETAILS)} FROM ({_FLAT})"
PRODUCTS_SQL = f"SELECT {', '.join(schemas.PRODUCTS)} FROM ({_FLAT})"


def details(current: DataFrame) -> DataFrame:
    return current.select("codigo", "last.*").select(*schemas.DETAILS)


def products(current: DataFrame) -> DataFrame:
    return current.select("codigo", "last.*").select(*schemas.PRODUCTS)


def suggestion(current: DataFrame, oled: str = fixed.OLED_YES) -> DataFrame:
    """Cheapest offer per marketplace from one row per code."""
    best = current.select("codigo", "last.*", F.when(~F.col("unknown"), F.col("preco")).alias("preco"))
    return masked(top1_by(best.where((F.col("oled") == oled) & F.col("origem").isNotNull()).select(*OFFER), ["origem"], "preco"))


def suggestion_sql(oled: str = fixed.OLED_YES) -> str:
    """``suggestion`` as the text of a stored view."""
    ties = ", ".join(f"{c} NULLS FIRST" for c in ["preco", *[c for c in OFFER if c not in ("origem", "preco")]])
    return f"""
SELECT concat(left(codigo, 2), repeat('*', greatest(length(codigo) - 4, 0)), right(codigo, 2)) AS codigo,
  preco AS menor_preco, recomendacao, origem, regexp_extract(link, r'{fixed.LINK_HOST}', 1) AS link
FROM (SELECT *, row_number() OVER (PARTITION BY origem ORDER BY {ties}) AS place
      FROM ({_FLAT}) WHERE oled = '{oled}' AND origem IS NOT NULL)
WHERE place = 1"""
