"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands.

Documents are encoded and cut into pieces of at most ``capacity`` ids; only longer documents are cut. Pieces are
dealt at random into blocks of bounded size. Each block is packed by several islands with populations of their
own. An individual is a set of bins (groups); crossover injects whole well-filled bins of one parent into the other,
removes the bins that hold one of their pieces a second time, and places the displaced pieces by best fit, roughly the
largest first. An island goes on as long as its children bring fewer bins. After each round the best individual of an island moves to the next island of its block. The best individual
of a block counts in the end. An island that reaches the least possible number of bins stops.

Ids never leave the task that encodes a document: pieces carry lengths and a CRC. What is dealt are lengths, and
the state of an island is a row. Pieces and islands are written to the shared folder, so a lost executor
repeats a task, not the encoding.

Defined results: a NULL or empty text is one piece with the end id alone. Repeated rows are packed one by one; NULL
keys are kept. An empty table gives no rows. Other columns are not read, so names may clash.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.batches import rechunked, stored
from vitrine.llm.tokens import encoder

CAPACITY = 2048
BLOCK_PIECES = 8192
ISLANDS = 2
ROUNDS = 2
POPULATION = 3
CHILDREN = 8  # in a row without fewer bins: then an island's round ends
TEXT_PER_BATCH = 8 << 20

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_BLOCK = "block long, doc_id array<long>, piece array<int>, start array<long>, length array<long>, ids_crc32 array<long>"
_ISLAND = "block long, island int, length array<long>, population array<binary>, bins int, fitness double"
PACKED = f"{PIECES}, sequence_id long, offset long"


def _pieces(path: str, capacity: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encode = encoder(path, "blank")
    for batch in rechunked(batches, "text", TEXT_PER_BATCH):
        rows: tuple[list, ...] = ([], [], [], [], [])
        ids, ends = encode.documents(batch.column("text"))
        first = 0
        for key, end in zip(batch.column("key").to_pylist(), ends.tolist()):
            for piece, start in enumerate(range(first, end, capacity)):
                part = ids[start : min(end, start + capacity)]
                for column, value in zip(rows, (key, piece, start - first, len(part), zlib.crc32(part))):
                    column.append(value)
            first = end
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
            names=["doc_id", "piece", "start", "length", "ids_crc32"],
        )


def pieces(documents: DataFrame, key: str, text: str, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids_crc32."""
    columns = documents.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return columns.mapInArrow(partial(_pieces, tokenizer, capacity), PIECES)


def _block(table: pa.Table) -> pa.Table:
    """One row with the pieces of a block as arrays."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.table(
        [pa.array([table.column("block")[0].as_py()], pa.int64())]
        + [pa.array([table.column(n).to_pylist()], pa.list_(k)) for n, k in zip(names, kinds)],
        names=["block", *names],
    )


class Packer:
    """Bins of one block; ``bins`` is a list of lists of piece numbers."""

    def __init__(self, lengths: np.ndarray, capacity: int, seed: int):
        self.lengths = [int(x) for x in lengths]
        self.capacity = capacity
        self.least = -(-sum(self.lengths) // capacity)
        self.random = np.random.default_rng(seed)

    def fill(self, members: list[int]) -> int:
        return sum(self.lengths[i] for i in members)

    def best_fit(self, bins: list[list[int]], order: Iterable[int], closed: int = 0) -> list[list[int]]:
        """Place pieces in the given order where the least room is left; the first ``closed`` bins stay as they are."""
        room = sorted((self.capacity - self.fill(b), n) for n, b in enumerate(bins) if n >= closed)
        for i in order:
            size = self.lengths[i]
            at = bisect_left(room, (size, -1))
            if at < len(room):
                left, n = room.pop(at)
                bins[n].append(i)
            else:
                left, n = self.capacity, len(bins)
                bins.append([i])
            if left > size:
                insort(room, (left - size, n))
        return bins

    def fitness(self, bins: list[list[int]]) -> float:
        """Mean of squared fill: of two packings with as many bins, the one with fuller bins is better."""
        return sum((self.fill(b) / self.capacity) ** 2 for b in bins) / max(1, len(bins))

    def key(self, bins: list[list[int]]) -> tuple[int, float]:
        return len(bins), -self.fitness(bins)

    def by_size(self, members: Iterable[int]) -> list[int]:
        return sorted(members, key=lambda i: (-self.lengths[i], i))

    def first(self) -> list[list[int]]:
        return self.best_fit([], self.by_size(range(len(self.lengths))))

    def shuffled(self) -> list[list[int]]:
        """Largest first with some noise, so that individuals differ without being poor."""
        noise = self.random.normal(1, 0.15, len(self.lengths))
        return self.best_fit([], np.argsort(-np.array(self.lengths) * noise, kind="stable").tolist())

    def roughly_by_size(self, members: list[int]) -> list[int]:
        """Largest first with little noise: the same order would put the pieces back where they were."""
        sizes = np.array([self.lengths[i] for i in members]) * self.random.normal(1, 0.1, len(members))
        return [members[k] for k in np.argsort(-sizes, kind="stable")]

    def child(self, base: list[list[int]], other: list[list[int]]) -> list[list[int]]:
        """Inject well-filled bins of ``other`` into ``base``."""
        well = [b for b in other if self.fill(b) >= 0.995 * self.capacity] or [max(other, key=self.fill)]
        share = max(1, len(well) // 3)
        injected = [list(well[k]) for k in self.random.choice(len(well), share, replace=False)]
        taken = {i for b in injected for i in b}
        kept, displaced = [], []
        for members in base:
            if taken.isdisjoint(members):
                # Poorly filled bins are opened too, so that their pieces find better places.
                if self.fill(members) < 0.97 * self.capacity:
                    displaced.extend(members)
                else:
                    kept.append(list(members))
            else:
                displaced.extend(i for i in members if i not in taken)
        return self.best_fit(injected + kept, self.roughly_by_size(displaced), closed=len(injected))

    def evolve(self, population: list[list[list[int]]], size: int, children: int) -> list[list[list[int]]]:
        if not population:
            population = [self.first()]
        population = sorted(population, key=self.key)
        if len(population[0]) <= self.least:
            return population
        while len(population) < size:
            population.append(self.shuffled())
        population.sort(key=self.key)
        idle = 0
        while idle < children and len(population[0]) > self.least:
            most = len(population[0])
            a, b = self.random.choice(len(population), 2, replace=False)
            population.append(self.child(population[a], population[b]))
            population = sorted(population, key=self.key)[:size]
            idle = 0 if len(population[0]) < most else idle + 1
        return population


def _stored_bins(bins: list[list[int]], n: int) -> bytes:
    number = np.zeros(n, "<i4")
    for k, members in enumerate(bins):
        number[members] = k
    return number.tobytes()


def _read_bins(stored_: bytes) -> list[list[int]]:
    number = np.frombuffer(stored_, "<i4")
    bins: list[list[int]] = [[] for _ in range(int(number.max()) + 1 if len(number) else 0)]
    for i, k in enumerate(number.tolist()):
        bins[k].append(i)
    return bins


def _evolve(capacity: int, round_: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            lengths = np.array(row["length"], np.int64)
            packer = Packer(lengths, capacity, hash((row["block"], row["island"], round_)) & 0xFFFFFFFF)
            population = packer.evolve([_read_bins(x) for x in row["population"] or []], POPULATION, CHILDREN)
            row |= {
                "population": [_stored_bins(b, len(lengths)) for b in population],
                "bins": len(population[0]),
                "fitness": packer.fitness(population[0]),
            }
            yield pa.RecordBatch.from_pylist(
                [row],
                schema=pa.schema(
                    [("block", pa.int64()), ("island", pa.int32()), ("length", pa.list_(pa.int64()))]
                    + [("population", pa.list_(pa.binary())), ("bins", pa.int32()), ("fitness", pa.float64())]
                ),
            )


def _placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block's pieces with their bin and the place in it."""
    for batch in batches:
        for row in batch.to_pylist():
            number = np.frombuffer(row["best"], "<i4").astype(np.int64)
            lengths = np.array(row["length"], np.int64)
            order = np.argsort(number, kind="stable")
            ends = np.cumsum(lengths[order])
            starts = ends - lengths[order]
            new = np.r_[True, number[order][1:] != number[order][:-1]]
            offsets = np.empty(len(lengths), np.int64)
            offsets[order] = starts - np.maximum.accumulate(np.where(new, starts, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_id"], pa.int64()),
                    pa.array(row["piece"], pa.int32()),
                    pa.array(row["start"], pa.int64()),
                    pa.array(lengths),
                    pa.array(row["ids_crc32"], pa.int64()),
                    pa.array((np.int64(row["block"]) << np.int64(32)) + number),
                    pa.array(offsets),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )


def pack(
    spark: SparkSession,
    documents: DataFrame,
    key: str,
    text: str,
    tokenizer: str,
    capacity: int = CAPACITY,
    block_pieces: int = BLOCK_PIECES,
) -> DataFrame:
    """Pieces of all documents with sequence_id and offset (the place in the sequence, gapless from 0)."""
    cut = stored(spark, pieces(documents, key, text, tokenizer, capacity), "pieces")
    blocks_ = max(1, -(-cut.count() // block_pieces))
    # Dealt by the place in the stored files, so repeated keys do not meet in one block.
    dealt = cut.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks_).cast("long")))
    blocks = stored(spark, dealt.groupBy("block").applyInArrow(_block, _BLOCK), "blocks")

    islands = blocks.select(
        "block",
        F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
        "length",
        F.lit(None).cast("array<binary>").alias("population"),
        F.lit(0).alias("bins"),
        F.lit(0.0).alias("fitness"),
    )
    for round_ in range(ROUNDS):
        spread = islands.repartition("block", "island")
        islands = stored(spark, spread.mapInArrow(partial(_evolve, capacity, round_), _ISLAND), f"islands-{round_}")
        if round_ + 1 < ROUNDS:
            elite = islands.select(
                "block",
                F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"),
                F.slice("population", 1, 1).alias("guest"),
            )
            islands = islands.join(elite, ["block", "island"]).select(
                "block", "island", "length", F.concat("population", "guest").alias("population"), "bins", "fitness"
            )
    best = islands.groupBy("block").agg(
        F.max_by(F.element_at("population", 1), F.struct(-F.col("bins"), "fitness", -F.col("island"))).alias("best")
    )
    return blocks.join(best, "block").mapInArrow(_placed, PACKED)
