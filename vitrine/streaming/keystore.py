"""First arrivals per key beyond what a state store holds: known keys lie in a bucketed table.

Each micro-batch is cut to one row per key, and meets the known keys of the buckets it touches:

1. a blocked Bloom filter of the known keys (64 bytes a block, kept as rows) is joined by block. A key that it does
   not hold is new, and needs no look at the keys themselves;
2. keys that it may hold are anti-joined with the known keys, so false positives do no harm.

New rows, keys and filter blocks of a batch are written to folders named by its number, and a batch reads only
folders of lower numbers. A batch that is repeated after a failure finds the same as before and writes the same
folders again. Nothing is kept in executors; ``compact`` joins the many small folders of keys and filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vitrine.operators.groups import first_by

BUCKETS = 64
BLOCKS = 1 << 16
PROBES = 6
_WORDS = 8  # of 64 bits in a block
_ID, _BUCKET, _BLOCK = "__id", "bucket", "block"


@dataclass(frozen=True)
class KeyStore:
    """Known keys under ``root``; ``blocks`` times 512 bits of filter, about 50 times as many keys at most."""

    root: str
    keys: tuple[str, ...]
    buckets: int = BUCKETS
    blocks: int = BLOCKS

    def rows(self, spark: SparkSession) -> DataFrame:
        """All first arrivals so far."""
        return spark.read.option("basePath", f"{self.root}/rows").parquet(f"{self.root}/rows").drop("batch")


def _identity(keys: Sequence[str]) -> Column:
    """16 bytes of a hash of the keys; NULL differs from any text."""
    # JSON keeps the columns and NULLs apart.
    text = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _bits(id_: Column) -> list[Column]:
    """The words of a block with this key's bits set."""
    words: list[Column] = [F.lit(0).cast("long")] * _WORDS
    for k in range(PROBES):
        place = F.pmod(F.xxhash64(id_, F.lit(k)), F.lit(64 * _WORDS)).cast("int")
        one = F.expr("cast(1 as bigint)")
        for w in range(_WORDS):
            mine = (place >= 64 * w) & (place < 64 * (w + 1))
            words[w] = words[w].bitwiseOR(F.when(mine, F.call_function("shiftleft", one, place - 64 * w)).otherwise(F.lit(0).cast("long")))
    return words


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches with a folder under ``path``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []
    return [int(n[6:]) for n in names if n.startswith("batch=")]


def _earlier(spark: SparkSession, path: str, schema: str, batch: int) -> DataFrame:
    """What batches before this one have written under ``path``."""
    wanted = [n for n in _numbers(spark, path) if n < batch]
    if not wanted:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/batch={n}" for n in wanted])


_KEYS = f"{_ID} binary, {_BUCKET} int, batch long"
_FILTER = f"{_BLOCK} int, {', '.join(f'w{i} long' for i in range(_WORDS))}, batch long"


def first_arrivals(spark: SparkSession, batch: DataFrame, store: KeyStore, number: int) -> None:
    """Store the rows of a batch whose keys no batch with a lower number has brought."""
    schema = batch.schema
    identified = first_by(batch, list(store.keys), [F.lit(0)]).withColumn(_ID, _identity(store.keys))
    words = _bits(F.col(_ID))
    hashed = identified.withColumns(
        {
            _BUCKET: F.pmod(F.xxhash64(_ID), F.lit(store.buckets)).cast("int"),
            _BLOCK: F.pmod(F.xxhash64(_ID, F.lit("block")), F.lit(store.blocks)).cast("int"),
            **{f"k{i}": w for i, w in enumerate(words)},
        }
    )
    blooms = _earlier(spark, f"{store.root}/filter", _FILTER, number)
    merged = blooms.groupBy(_BLOCK).agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(_WORDS)])
    met = hashed.join(merged, _BLOCK, "left")
    held = F.lit(True)
    for i in range(_WORDS):
        held &= F.coalesce(F.col(f"w{i}").bitwiseAND(F.col(f"k{i}")) == F.col(f"k{i}"), F.lit(False))
    staged = f"{store.root}/staged/batch={number}"
    kept = [f.name for f in schema.fields]
    bits = [f"k{i}" for i in range(_WORDS)]
    met.select(*kept, _ID, _BUCKET, _BLOCK, *bits, held.alias("__held")).write.mode("overwrite").parquet(staged)
    rows = spark.read.parquet(staged)

    # A number per bucket at most.
    touched = [r[0] for r in rows.where("__held").select(_BUCKET).distinct().collect()]
    known = _earlier(spark, f"{store.root}/keys", _KEYS, number).where(F.col(_BUCKET).isin(touched))
    again = rows.where("__held").join(known.select(_BUCKET, _ID), [_BUCKET, _ID], "left_anti")
    columns = [*kept, _ID, _BUCKET, _BLOCK, *bits]
    new = rows.where("NOT __held").select(*columns).unionByName(again.select(*columns))
    fresh = f"{store.root}/fresh/batch={number}"
    new.write.mode("overwrite").parquet(fresh)
    new = spark.read.parquet(fresh)
    new.select(_ID, _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{store.root}/keys/batch={number}")
    blocks = new.groupBy(_BLOCK).agg(*[F.bit_or(f"k{i}").alias(f"w{i}") for i in range(_WORDS)])
    blocks.write.mode("overwrite").parquet(f"{store.root}/filter/batch={number}")
    # Readers see rows only now, when the keys are there.
    new.select(*kept).write.mode("overwrite").parquet(f"{store.root}/rows/batch={number}")
    _remove(spark, f"{store.root}/staged/batch={number}", f"{store.root}/fresh/batch={number}")


def _remove(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def compact(spark: SparkSession, store: KeyStore, upto: int) -> None:
    """Join keys and filter of all batches up to ``upto`` into that batch's folders, between two runs of the stream.

    The joined folder holds all the others, so a stop between these steps loses nothing, and what is there twice
    does no harm.
    """
    blooms = _earlier(spark, f"{store.root}/filter", _FILTER, upto + 1)
    merged = blooms.groupBy(_BLOCK).agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(_WORDS)])
    keys = _earlier(spark, f"{store.root}/keys", _KEYS, upto + 1).select(_ID, _BUCKET)
    for name, rows, parts in (("filter", merged, []), ("keys", keys.hint("rebalance", _BUCKET), [_BUCKET])):
        path, staged = f"{store.root}/{name}", f"{store.root}/compacted-{name}"
        rows.write.mode("overwrite").parquet(staged)
        spark.read.parquet(staged).write.mode("overwrite").partitionBy(*parts).parquet(f"{path}/batch={upto}")
        _remove(spark, staged, *[f"{path}/batch={n}" for n in _numbers(spark, path) if n < upto])


def dedup_stream(
    stream: DataFrame, store: KeyStore, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """First arrivals of a stream into ``store``."""
    spark = stream.sparkSession
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, number: first_arrivals(spark, batch, store, number)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
