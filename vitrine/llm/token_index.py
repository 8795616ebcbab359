"""Token-id files with a minimal perfect hash index from document keys to places in the files.

File format, in two Parquet tables below one folder, both committed by Spark's own writer (any file system; a lost
executor or a repeated attempt leaves nothing half written):

``payload``: shards are ranges of document keys, in ascending order; a shard is a sequence of segments. A segment is
a row: shard, segment, first_id (ids in the shard before it), length (its ids), lengths (unsigned 32-bit, ids per
document) and ids
(unsigned 16-bit, or 32-bit if the vocabulary needs it, little endian, nothing else). No document crosses segments.

``index``: parts, dealt by a hash of the key. A part is a row: part, levels (bit arrays of the minimal perfect hash
function) and, by slot, fingerprints (32 bits), shard, segment, place (ids in the segment before it) and length.

The function of a part has levels of bits. A key that falls alone on a bit of the first level owns it; the others
try the next level. The number of bits set before a key's own is its slot: slots run from 0 to the number of keys
less one, and a look-up takes a few probes however many keys there are. A key outside the set is recognised by its
fingerprint (one in 2**32 passes).

Defined results: a NULL text is empty and has the end id alone. Rows with the same key follow each other by text
(NULL first) and are kept apart by a copy number from 0. A NULL key sorts first. An empty table gives two empty
tables. Other columns are not read, so names may clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm.batches import mixed, rechunked
from vitrine.llm.tokens import encoder

SEGMENT_IDS = 1 << 20
KEYS_PER_PART = 20_000
TEXT_PER_BATCH = 8 << 20
_BITS_PER_KEY = 2
_LEVELS = 64

PAYLOAD = "key long, copy long, shard int, segment int, first_id long, place long, length long, lengths binary, ids binary"
_STORED = ["shard", "segment", "first_id", "length", "lengths", "ids"]
INDEX = "part long, n_keys long, levels array<binary>, fingerprints binary, shard binary, segment binary, place binary, length binary"


def key_hash(keys: np.ndarray, missing: np.ndarray, copies: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of (key, copy number); different seeds give independent hashes."""
    with np.errstate(over="ignore"):
        start = np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
        first = mixed(keys.astype(np.int64).view(np.uint64) + start)
        second = mixed(first + copies.astype(np.uint64) + missing.astype(np.uint64) * np.uint64(1 << 62))
    return second


class PerfectHash:
    """Minimal perfect hash function over pairs (key, copy number)."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        sizes = [int(level.sum()) for level in levels]
        self._before = np.concatenate([[0], np.cumsum(sizes)])
        self._ranks = [np.cumsum(level) - level for level in levels]

    @classmethod
    def build(cls, keys: np.ndarray, missing: np.ndarray, copies: np.ndarray) -> PerfectHash:
        levels, left = [], np.arange(len(keys))
        while len(left):
            if len(levels) == _LEVELS:
                raise ValueError("two of the keys are equal")
            size = max(8, _BITS_PER_KEY * len(left))
            at = (key_hash(keys[left], missing[left], copies[left], len(levels)) % np.uint64(size)).astype(np.int64)
            counts = np.bincount(at, minlength=size)
            levels.append((counts == 1).astype(np.int64))
            left = left[counts[at] > 1]
        return cls(levels)

    def slots(self, keys: np.ndarray, missing: np.ndarray, copies: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 if no level knows it (any other key may get any slot)."""
        found, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for number, level in enumerate(self.levels):
            at = (key_hash(keys[left], missing[left], copies[left], number) % np.uint64(len(level))).astype(np.int64)
            own = level[at] == 1
            found[left[own]] = self._before[number] + self._ranks[number][at[own]]
            left = left[~own]
        return found

    def stored(self) -> list[bytes]:
        return [len(x).to_bytes(8, "little") + np.packbits(x.astype(np.uint8)).tobytes() for x in self.levels]

    @classmethod
    def read(cls, stored: Iterable[bytes]) -> PerfectHash:
        return cls(
            [
                np.unpackbits(np.frombuffer(x, np.uint8, offset=8), count=int.from_bytes(x[:8], "little")).astype(np.int64)
                for x in stored
            ]
        )


def _segments(path: str, width: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one shard, sorted: a row per segment (with its ids) and a row per document (with its place)."""
    encode = encoder(path, "space")
    from pyspark import TaskContext

    shard = TaskContext.get().partitionId()
    schema = pa.schema(
        [("key", pa.int64()), ("copy", pa.int64()), ("shard", pa.int32()), ("segment", pa.int32()), ("first_id", pa.int64())]
        + [("place", pa.int64()), ("length", pa.int64()), ("lengths", pa.binary()), ("ids", pa.binary())]
    )
    segment, first_id = 0, 0
    last, copy = (False, None), 0
    documents: list[tuple] = []
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        nonlocal segment, first_id
        lengths = np.array([d[2] for d in documents], "<u4")
        places = np.cumsum(lengths.astype(np.int64)) - lengths
        ids = np.concatenate(held).tobytes()
        n = len(documents)
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array([None] + [d[0] for d in documents], pa.int64()),
                pa.array([None] + [d[1] for d in documents], pa.int64()),
                pa.array([shard] * (n + 1), pa.int32()),
                pa.array([segment] * (n + 1), pa.int32()),
                pa.array([first_id] * (n + 1), pa.int64()),
                pa.array([None] + places.tolist(), pa.int64()),
                pa.array([int(lengths.sum())] + lengths.tolist(), pa.int64()),
                pa.array([lengths.tobytes()] + [None] * n, pa.binary()),
                pa.array([ids] + [None] * n, pa.binary()),
            ],
            schema=schema,
        )
        segment, first_id = segment + 1, first_id + int(lengths.sum())
        documents.clear()
        held.clear()
        return batch

    size = 0
    for batch in rechunked(batches, "text", TEXT_PER_BATCH):
        ids, ends = encode.documents(batch.column("text"))
        start = 0
        for key, end in zip(batch.column("key").to_pylist(), ends.tolist()):
            copy = copy + 1 if last == (True, key) else 0
            last = (True, key)
            if documents and size + end - start > SEGMENT_IDS:
                yield flush()
                size = 0
            documents.append((key, copy, end - start))
            held.append(ids[start:end].astype(width))
            size += end - start
            start = end
    if documents:
        yield flush()


def _parts(table: pa.Table) -> pa.Table:
    """The index row of a part from the places of its documents."""
    missing = table.column("key").is_null().to_numpy()
    keys = table.column("key").fill_null(0).to_numpy()
    copies = table.column("copy").to_numpy()
    function = PerfectHash.build(keys, missing, copies)
    slots = function.slots(keys, missing, copies)
    order = np.argsort(slots)

    def by_slot(values: np.ndarray, kind: str) -> list[bytes]:
        return [values[order].astype(kind).tobytes()]

    return pa.table(
        {
            "part": [table.column("part")[0].as_py()],
            "n_keys": [len(keys)],
            "levels": [function.stored()],
            "fingerprints": by_slot(key_hash(keys, missing, copies, 1 << 20), "<u4"),
            **{name: by_slot(table.column(name).to_numpy(), "<i8") for name in ("shard", "segment", "place", "length")},
        },
        schema=pa.schema(
            [("part", pa.int64()), ("n_keys", pa.int64()), ("levels", pa.list_(pa.binary()))]
            + [(n, pa.binary()) for n in ("fingerprints", "shard", "segment", "place", "length")]
        ),
    )


def _part_of(parts: int):
    return F.pmod(F.xxhash64("key", "copy"), F.lit(parts).cast("long")).alias("part")


def write(spark: SparkSession, documents: DataFrame, key: str, text: str, path: str, tokenizer: str, wide: bool = False) -> None:
    """Encode all documents and write payload and index below ``path``. Keys are integers.

    ``wide`` stores 32-bit ids, for vocabularies beyond 65,536.
    """
    # The bounds of the shards are taken from the rows' keys; rows of a key stay together in one shard.
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        documents.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
        .repartitionByRange(shards, "key")
        .sortWithinPartitions("key", "text")
    )
    rows = ordered.mapInArrow(partial(_segments, tokenizer, "<u4" if wide else "<u2"), PAYLOAD)
    # One pass writes segments and places side by side, as partitions of one table.
    rows.withColumn("kind", F.when(F.col("ids").isNull(), "places").otherwise("payload")).write.partitionBy("kind").option(
        "compression", "zstd"
    ).parquet(f"{path}/data")
    places = _table(spark, path, "places").select("key", "copy", "shard", "segment", "place", "length")
    parts = max(1, -(-places.count() // KEYS_PER_PART))
    (
        places.withColumn("part", _part_of(parts))
        .groupBy("part")
        .applyInArrow(_parts, INDEX)
        .write.option("compression", "zstd")
        .parquet(f"{path}/index")
    )


def _table(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(PAYLOAD + ", kind string").parquet(f"{path}/data").where(F.col("kind") == kind).drop("kind")


def keys(spark: SparkSession, path: str) -> DataFrame:
    """Keys and copy numbers of all documents written."""
    return _table(spark, path, "places").select("key", "copy")


def payload(spark: SparkSession, path: str) -> DataFrame:
    """Segments: shard, segment, first_id, length (of all ids), lengths (of documents), ids."""
    return _table(spark, path, "payload").select(*_STORED)


def _find(table: pa.Table) -> pa.Table:
    """Places of the asked keys of one part. The part's row has levels; the others ask."""
    known = pc.is_valid(table.column("levels"))
    asked = table.filter(pc.invert(known))
    missing = asked.column("key").is_null().to_numpy()
    keys, copies = asked.column("key").fill_null(0).to_numpy(), asked.column("copy").to_numpy()
    out = {n: np.zeros(len(keys), np.int64) for n in ("shard", "segment", "place", "length")}
    found = np.zeros(len(keys), bool)
    for row in table.filter(known).to_pylist():
        slots = PerfectHash.read(row["levels"]).slots(keys, missing, copies)
        prints = np.frombuffer(row["fingerprints"], "<u4")
        wanted = key_hash(keys, missing, copies, 1 << 20).astype("<u4")
        found = (slots >= 0) & (prints[np.maximum(slots, 0)] == wanted)
        for name in out:
            out[name][found] = np.frombuffer(row[name], "<i8")[slots[found]]
    return pa.table(
        {"key": asked.column("key"), "copy": asked.column("copy"), **{n: pa.array(v) for n, v in out.items()}}
    ).filter(pa.array(found))


def locate(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """Places of keys (columns key and copy): key, copy, shard, segment, place, length. Unknown keys give no row."""
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    parts = index.count()
    if not parts:
        return keys.select("key", "copy").where(F.lit(False)).selectExpr(
            "key", "copy", "0L shard", "0L segment", "0L place", "0L length"
        )
    fields = ["levels", "fingerprints", "shard", "segment", "place", "length"]
    asked = keys.select(
        _part_of(parts),
        F.col("key").cast("long").alias("key"),
        F.col("copy").cast("long").alias("copy"),
        *[F.lit(None).cast(dict(index.dtypes)[n]).alias(n) for n in fields],
    )
    rows = asked.union(index.select("part", F.lit(None).cast("long"), F.lit(None).cast("long"), *fields))
    return rows.groupBy("part").applyInArrow(
        _find, "key long, copy long, shard long, segment long, place long, length long"
    )


def _checksums(width: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each document of a segment its place and the CRC of its ids, as unsigned 32-bit integers."""
    for batch in batches:
        for row in batch.to_pylist():
            lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
            ends = np.cumsum(lengths)
            ids = memoryview(np.frombuffer(row["ids"], width).astype("<u4").tobytes())
            starts = ends - lengths
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([row["shard"]] * len(ends), pa.int64()),
                    "segment": pa.array([row["segment"]] * len(ends), pa.int64()),
                    "place": pa.array(starts),
                    "start_in_shard": pa.array(starts + row["first_id"]),
                    "n_tokens": pa.array(lengths),
                    "ids_crc32": pa.array([zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts, ends)], pa.int64()),
                }
            )


def checksums(spark: SparkSession, path: str, wide: bool = False) -> DataFrame:
    """Read all segments back: shard, segment, place, start (ids of all documents before), n_tokens, ids_crc32."""
    stored = payload(spark, path)
    read = stored.mapInArrow(
        partial(_checksums, "<u4" if wide else "<u2"),
        "shard long, segment long, place long, start_in_shard long, n_tokens long, ids_crc32 long",
    )
    # One row per shard; shards are no more than the partitions of one shuffle, so one task can add them up.
    totals = stored.groupBy("shard").agg(F.sum("length").alias("total"))
    before = totals.select(
        "shard",
        F.coalesce(
            F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("before"),
    )
    return read.join(before, "shard").select(
        "shard", "segment", "place", (F.col("before") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids_crc32"
    )
