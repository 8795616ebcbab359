"""Near-duplicate vectors by an exact metric range join on angles.

Two vectors are linked if their cosine is ``similarity`` or more, that is if their angle is at most a radius. Angles are
a metric, so distances to pivots bound them by the triangle inequality:

* Each distinct vector belongs to the cell of its nearest pivot. It also visits each earlier cell that may hold a vector
  within the radius: for every pivot, its angle must lie within the radius of the cell's range of angles. Every pair
  thus meets once, in the earlier of its two cells, and cells join independently.
* Vectors within half the radius of their pivot (the core of a cell) are all linked to each other. That is counted,
  not compared, so a large tight group costs no more than its number of vectors.
* In a cell, rows lie in blocks by their angle to the pivot; pairs of blocks whose ranges are further apart than the
  radius are left out, the others are compared, each pair of blocks in one row.

Comparison is a matrix product in single precision with a proven error bound; what lies within that bound of the
threshold is decided in double precision. A pair of blocks gives a row per linked vector: its number of links and
the least linked vector of its group there. So rows stay linear, and classes are connected components of those.

Pivots come from a bounded sample (``SAMPLE`` vectors in the order of a hash): first the centres of dense parts of
it, then vectors far from the others. Their number grows with the vectors, ``CELL_ROWS`` for each, up to ``MOST_PIVOTS``;
the table of the cells' ranges has the square of that. They only change what is compared, never the result.

Defined results: vectors that are NULL, zero, empty, or hold NULL or non-finite parts link with nothing and are classes of
their own. Vectors of different lengths are not linked. Equal vectors are one node from the start; each of them counts
as a link of the others. A class is named by its least key, NULL if it has none; a row is kept if that is its own key
(NULL with NULL). Repeated rows are rows of their own. An empty table gives no rows. Other columns are not read, so
names may clash.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.batches import stored
from vitrine.llm.components import components
from vitrine.llm.pivot_search import usable

SAMPLE = 2048
CELL_ROWS = 16_384
MOST_PIVOTS = 128
DENSE = 0.01  # share of the sample that makes a dense part
BLOCK_BYTES = 2 << 20
TILE = 2048
SLACK = 1e-6  # more than any error of an angle in double precision

_CORE, _OWN, _VISIT = 0, 1, 2
_SIGNED = "key long, node binary, vector binary"
_ASSIGNED = "dim int, cell int, core boolean, node binary, n long, vector binary"
_RANGES = "dim int, cell int, low array<double>, high array<double>"
_DEALT = "dim int, cell int, kind int, at double, node binary, n long, vector binary"
_BLOCKS = "dim int, cell int, kind int, block long, low double, high double, nodes array<binary>, counts binary, vectors binary"
_LINKED = "node binary, root binary, links long"


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; large parts cannot overflow."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1, 1))


def _signed(kind: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Name of each distinct usable vector, a hash of its parts; missing for other rows."""
    for batch in batches:
        nodes, vectors = [], []
        for ok, vector in zip(batch.column("usable").to_pylist(), batch.column("vector")):
            parts = np.array(vector.values, np.float64) + 0.0 if ok else np.empty(0)  # -0.0 becomes 0.0
            if parts.any():
                vectors.append(parts.astype(kind).tobytes())
                nodes.append(hashlib.blake2b(vectors[-1], digest_size=16).digest())
            else:
                vectors.append(None)
                nodes.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(nodes, pa.binary()), pa.array(vectors, pa.binary())], names=["key", "node", "vector"]
        )


def choose(vectors: np.ndarray, wanted: int, radius: float) -> np.ndarray:
    """Pivots among unit vectors: centres of dense parts, then those far from the others."""
    wanted = min(wanted, len(vectors))
    apart = angles(vectors, vectors)
    near = apart <= (radius - SLACK) / 2
    free = np.ones(len(vectors), bool)
    chosen: list[int] = []
    while len(chosen) < wanted:
        counts = (near & free).sum(axis=1)
        best = int(counts.argmax())
        if counts[best] < max(8, DENSE * len(vectors)):
            break
        chosen.append(best)
        free &= ~near[best]
    nearest = apart[chosen].min(axis=0) if chosen else np.full(len(vectors), np.inf)
    while len(chosen) < wanted:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, apart[chosen[-1]])
    return vectors[chosen]


def _by_length(batch: pa.RecordBatch, kind: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, places in the batch and vectors of equal length."""
    texts = batch.column("vector").to_pylist()
    places = defaultdict(list)
    for i, text in enumerate(texts):
        places[len(text) // np.dtype(kind).itemsize].append(i)
    for dim, own in places.items():
        joined = np.frombuffer(b"".join(texts[i] for i in own), kind).astype(np.float64).reshape(len(own), dim)
        yield dim, np.array(own), joined


def _assigned(kind: str, radius: float, chosen: dict, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for dim, places, vectors in _by_length(batch, kind):
            away = angles(unit(vectors), chosen[dim])
            cell = away.argmin(axis=1)
            core = away.min(axis=1) <= (radius - SLACK) / 2
            part = batch.take(pa.array(places))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(places), dim), pa.int32()), pa.array(cell, pa.int32()), pa.array(core)]
                + [part.column(n) for n in ("node", "n", "vector")],
                names=["dim", "cell", "core", "node", "n", "vector"],
            )


def _ranges(kind: str, chosen: dict, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least and greatest angle to each pivot of the vectors of each cell in a batch."""
    for batch in batches:
        cells = batch.column("cell").to_numpy()
        for dim, places, vectors in _by_length(batch, kind):
            away = angles(unit(vectors), chosen[dim])
            own = cells[places]
            for cell in np.unique(own):
                part = away[own == cell]
                row = {"dim": dim, "cell": int(cell), "low": part.min(axis=0).tolist(), "high": part.max(axis=0).tolist()}
                yield pa.RecordBatch.from_pylist(
                    [row],
                    pa.schema([("dim", pa.int32()), ("cell", pa.int32()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))]),
                )


def _dealt(kind: str, radius: float, chosen: dict, ranges: dict, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector in its own cell and in the earlier cells that it visits."""
    for batch in batches:
        cells = batch.column("cell").to_numpy()
        cores = batch.column("core").to_numpy(zero_copy_only=False)
        for dim, places, vectors in _by_length(batch, kind):
            low, high = ranges[dim]
            away = angles(unit(vectors), chosen[dim])
            own = cells[places]
            for cell in range(len(low)):
                if np.isnan(low[cell]).any():  # an empty cell
                    continue
                meets = ((away >= low[cell] - radius - SLACK) & (away <= high[cell] + radius + SLACK)).all(axis=1)
                here = np.flatnonzero((own == cell) | ((own > cell) & meets))
                if not len(here):
                    continue
                role = np.where(own[here] > cell, _VISIT, np.where(cores[places[here]], _CORE, _OWN))
                part = batch.take(pa.array(places[here]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(here), dim), pa.int32()),
                        pa.array(np.full(len(here), cell), pa.int32()),
                        pa.array(role, pa.int32()),
                        pa.array(away[here, cell]),
                        *[part.column(n) for n in ("node", "n", "vector")],
                    ],
                    names=["dim", "cell", "kind", "at", "node", "n", "vector"],
                )


def _blocked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows sorted by (dim, cell, kind, at)."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    schema = pa.schema(
        [("dim", pa.int32()), ("cell", pa.int32()), ("kind", pa.int32()), ("block", pa.int64())]
        + [("low", pa.float64()), ("high", pa.float64()), ("nodes", pa.list_(pa.binary()))]
        + [("counts", pa.binary()), ("vectors", pa.binary())]
    )
    held: list[tuple] = []
    now, size = None, 0

    def flush() -> pa.RecordBatch:
        nonlocal number, size
        number += 1
        at, nodes, counts, vectors = zip(*held)
        row = dict(zip(("dim", "cell", "kind"), now)) | {
            "block": number, "low": min(at), "high": max(at), "nodes": nodes,
            "counts": np.array(counts, "<i8").tobytes(), "vectors": b"".join(vectors),
        }
        held.clear()
        size = 0
        return pa.RecordBatch.from_pylist([row], schema=schema)

    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in ("dim", "cell", "kind", "at", "node", "n", "vector"))):
            if held and (row[:3] != now or size >= BLOCK_BYTES):
                yield flush()
            now = row[:3]
            held.append(row[3:])
            size += len(row[-1])
    if held:
        yield flush()


def _groups(linked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Connected rows and columns of a matrix of links."""
    rows_left = linked.any(axis=1)
    columns_left = np.ones(linked.shape[1], bool)
    while rows_left.any():
        rows = np.array([rows_left.argmax()])
        rows_left[rows] = False
        all_rows, all_columns = [rows], []
        while len(rows):
            columns = np.flatnonzero(linked[rows].any(axis=0) & columns_left)
            columns_left[columns] = False
            all_columns.append(columns)
            rows = np.flatnonzero(linked[:, columns].any(axis=1) & rows_left)
            rows_left[rows] = False
            all_rows.append(rows)
        yield np.concatenate(all_rows), np.concatenate(all_columns)


def compare(
    a: np.ndarray, b: np.ndarray, a_counts: np.ndarray, b_counts: np.ndarray, similarity: float, same: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of the rows of two blocks of unit vectors (``same``: of one block with itself).

    Returns the links of each row of a, those of each row of b, and the group of each (rows of b after those of a).
    """
    n, m = len(a), len(b)
    a_links, b_links = np.zeros(n, np.int64), np.zeros(m, np.int64)
    group = np.arange(n + (0 if same else m))

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return int(i)

    # Rounding of a product of unit vectors in single precision is below this.
    error = (a.shape[1] + 4) * 6.1e-8
    a32, b32 = a.astype(np.float32), b.astype(np.float32)
    for i in range(0, n, TILE):
        for j in range(i if same else 0, m, TILE):
            products = a32[i : i + TILE] @ b32[j : j + TILE].T
            possible = products >= similarity - error
            rows = np.flatnonzero(possible.any(axis=1))
            columns = np.flatnonzero(possible.any(axis=0))
            if not len(rows):
                continue
            part = np.ix_(rows, columns)
            linked = possible[part]
            unsure = np.argwhere(linked & (products[part] < similarity + error))
            for k in range(0, len(unsure), 1 << 16):
                x, y = unsure[k : k + (1 << 16)].T
                linked[x, y] = np.einsum("ij,ij->i", a[i + rows[x]], b[j + columns[y]]) >= similarity
            if same and i == j:
                linked[rows[:, None] == columns[None, :]] = False
            weights = linked.astype(np.float64)
            a_links[i + rows] += (weights @ b_counts[j + columns]).astype(np.int64)
            if not same:
                b_links[j + columns] += (weights.T @ a_counts[i + rows]).astype(np.int64)
            elif i != j:
                a_links[j + columns] += (weights.T @ a_counts[i + rows]).astype(np.int64)
            shift = j if same else n + j
            for own_rows, own_columns in _groups(linked):
                members = [root(x) for x in np.concatenate([i + rows[own_rows], shift + columns[own_columns]])]
                group[members] = min(members)
    roots = np.array([root(i) for i in range(len(group))]) if (a_links.any() or b_links.any()) else group
    return a_links, b_links, roots


def _linked(kind: str, similarity: float, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            one = {name: batch.column(name)[row] for name in batch.schema.names}
            dim = one["dim"].as_py()

            def vectors(name: str) -> np.ndarray:
                return unit(np.frombuffer(one[name].as_buffer(), kind).astype(np.float64).reshape(-1, dim))

            same = one["a_block"].as_py() == one["b_block"].as_py()
            a = vectors("a_vectors")
            b = a if same else vectors("b_vectors")
            counts = [np.frombuffer(one[n].as_buffer(), "<i8") for n in ("a_counts", "b_counts")]
            a_links, b_links, group = compare(a, b, *counts, similarity, same)
            names = list(one["a_nodes"].as_py())
            links = a_links
            if not same:
                names += one["b_nodes"].as_py()
                links = np.concatenate([a_links, b_links])
            found = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([names[i] for i in found], pa.binary()),
                    pa.array([names[group[i]] for i in found], pa.binary()),
                    pa.array(links[found]),
                ],
                names=["node", "root", "links"],
            )


def _pairs_of_blocks(blocks: DataFrame, radius: float) -> DataFrame:
    """Each pair of blocks of a cell that may hold linked vectors, once, but for cores among themselves."""
    about = blocks.select("dim", "cell", "kind", "block", "low", "high")
    a, b = about.alias("a"), about.alias("b")
    reach = radius + SLACK
    kinds = (
        ((F.col("a.kind") == _CORE) & (F.col("b.kind") != _CORE))
        | ((F.col("a.kind") == _OWN) & (F.col("b.kind") == _OWN) & (F.col("a.block") <= F.col("b.block")))
        | ((F.col("a.kind") == _OWN) & (F.col("b.kind") == _VISIT))
    )
    near = (F.col("a.low") <= F.col("b.high") + reach) & (F.col("b.low") <= F.col("a.high") + reach)
    met = a.join(b, (F.col("a.dim") == F.col("b.dim")) & (F.col("a.cell") == F.col("b.cell")) & kinds & near)
    return met.select(F.col("a.block").alias("a_block"), F.col("b.block").alias("b_block"))


def near_vectors(spark: SparkSession, rows: DataFrame, key: str, vector: str, similarity: float = 0.9) -> DataFrame:
    """One row per row: key, n_links, component_id, kept."""
    if not 0 < similarity <= 1:
        raise ValueError("similarity must be above 0, and 1 at most")
    radius = math.acos(similarity)
    kind = "<f4" if rows.schema[vector].dataType.elementType.typeName() == "float" else "<f8"
    columns = rows.select(
        F.col(key).cast("long").alias("key"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(usable(F.col(vector)), F.lit(False)).alias("usable"),
    )
    signed = stored(spark, columns.mapInArrow(partial(_signed, kind), _SIGNED), "signed")
    known = signed.where(F.col("node").isNotNull())
    nodes = known.groupBy("node").agg(F.count("*").alias("n"), F.first("vector").alias("vector"))
    nodes = stored(spark, nodes, "vectors")

    length = F.octet_length("vector") / np.dtype(kind).itemsize
    sizes = {int(r.dim): r.n for r in nodes.groupBy(length.cast("int").alias("dim")).agg(F.count("*").alias("n")).collect()}
    sample = defaultdict(list)
    for r in nodes.orderBy(F.xxhash64("node")).limit(SAMPLE).select("vector").collect():
        sample[len(r.vector) // np.dtype(kind).itemsize].append(np.frombuffer(bytes(r.vector), kind).astype(np.float64))
    chosen = {}
    for dim, n in sizes.items():
        own = np.array(sample[dim]) if sample[dim] else np.ones((1, dim))  # a rare length may have no sample
        chosen[dim] = choose(unit(own), min(MOST_PIVOTS, -(-n // CELL_ROWS)), radius)
    assigned = stored(spark, nodes.mapInArrow(partial(_assigned, kind, radius, chosen), _ASSIGNED), "cells")

    # A row per cell and batch, so far fewer than vectors; the table of ranges has a number per pair of pivots.
    parts = assigned.select("dim", "cell", "vector").mapInArrow(partial(_ranges, kind, chosen), _RANGES)
    measured = parts.select("dim", "cell", F.posexplode(F.arrays_zip("low", "high")).alias("pivot", "angle"))
    ranges = {dim: np.full((2, len(p), len(p)), np.nan) for dim, p in chosen.items()}
    for r in measured.groupBy("dim", "cell", "pivot").agg(F.min("angle.low").alias("low"), F.max("angle.high").alias("high")).collect():
        ranges[r.dim][:, r.cell, r.pivot] = r.low, r.high
    dealt = assigned.mapInArrow(partial(_dealt, kind, radius, chosen, ranges), _DEALT)
    order = ["dim", "cell", "kind", "at", "node"]
    ranged = dealt.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = stored(spark, ranged.mapInArrow(_blocked, _BLOCKS), "blocks")

    def side(name: str) -> DataFrame:
        fields = ["block", "nodes", "counts", "vectors"]
        return blocks.select(*(["dim"] if name == "a" else []), *[F.col(f).alias(f"{name}_{f}") for f in fields])

    pairs = _pairs_of_blocks(blocks, radius).join(side("b"), "b_block").join(side("a"), "a_block")
    linked = stored(spark, pairs.mapInArrow(partial(_linked, kind, similarity), _LINKED), "linked")

    cores = assigned.where("core")
    totals = cores.groupBy("dim", "cell").agg(F.sum("n").alias("total"), F.min("node").alias("root"))
    certain = cores.select("dim", "cell", "node", "n").join(totals, ["dim", "cell"])
    certain = certain.select("node", "root", (F.col("total") - F.col("n")).alias("links"))
    found = stored(spark, linked.union(certain), "links")
    roots = components(spark, found.select(F.col("node").alias("a"), F.col("root").alias("b")))

    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    least = known.groupBy("node").agg(F.min("key").alias("least"), F.count("*").alias("n"))
    own = least.join(counts, "node", "left").join(roots, "node", "left")
    own = stored(spark, own.withColumn("root", F.coalesce("root", "node")), "nodes")
    classes = own.groupBy("root").agg(F.min("least").alias("component_id"))
    # A table that is read again, so that adaptive execution can split a vector with very many copies.
    judged = stored(spark, own.join(classes, "root").select("node", "component_id", "n", "links"), "classes")
    joined = known.select("key", "node").join(judged, "node")
    linked_rows = joined.select("key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    others = signed.where(F.col("node").isNull())
    lone = others.select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return linked_rows.union(lone).select(
        F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept")
    )
