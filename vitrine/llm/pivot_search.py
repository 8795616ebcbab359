"""Exact top-k search by inner product with pivot-table elimination.

Vectors are whole numbers, so scores are exact. The pivot table holds each vector's distances to a set of pivots.
For a query and a vector, the largest difference of their distances to any pivot is a lower bound of their own
distance, hence with both norms an upper bound of their inner product. Vectors are evaluated in the order of that
bound, and a query stops as soon as the next bound is below its k-th best score: what is left cannot enter.

Vectors lie in blocks of ``BLOCK`` rows (a row of the pivot table holds a block's vectors, norms and distances). The
stated queries come in blocks too; each block of queries meets each block of vectors once, in a task of its own, and
passes on only the k best of each of its queries. Final ranks come from those.

Pivots are chosen from a bounded sample (``SAMPLE`` vectors in the order of a hash) so that they lie far apart. They
only change how much is evaluated, never the result.

Defined results: NULL vectors and vectors with NULL or non-finite parts take no part. Vectors of another length
than the query's do not meet it; empty vectors score 0. A query is never its own answer, but other rows with its
key may be. Ties go to the smaller key (NULL first). Fewer than k answers are all given. Parts so large that a
score could exceed 64 bits are an error, never a wrong score. Without usable queries or vectors there are no rows. Other columns are not read, so names may clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm.batches import stored

PIVOTS = 32
SAMPLE = 2048
BLOCK = 4096
STEP = 64

_TABLE = "dim int, block long, asked boolean, n int, keys array<long>, rows array<long>, vectors binary, distances binary"
_BEST = "query_row long, query_id long, vec_row long, vec_id long, score long"


def whole(vector: Column, scale: int) -> Column:
    """Each component x as floor(scale * x), x taken as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale).cast("double") * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    """The vector is there and all its parts are finite."""
    finite = F.forall(
        vector,
        lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x.cast("double")),
    )
    return vector.isNotNull() & finite


def pivots(vectors: np.ndarray, wanted: int = PIVOTS) -> np.ndarray:
    """Vectors of a sample that lie far from each other, chosen one by one."""
    if not len(vectors):
        return vectors
    chosen = [0]
    nearest = np.full(len(vectors), np.inf)
    while len(chosen) < min(wanted, len(vectors)):
        away = ((vectors - vectors[chosen[-1]]) ** 2).sum(axis=1)
        nearest = np.minimum(nearest, away)
        chosen.append(int(nearest.argmax()))
    return vectors[chosen]


def _distances(vectors: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    if not len(chosen):
        return np.zeros((len(vectors), 0))
    v, p = vectors.astype(float), chosen.astype(float)
    squares = (v**2).sum(axis=1)[:, None] + (p**2).sum(axis=1)[None, :] - 2 * v @ p.T
    return np.sqrt(np.maximum(squares, 0))


def _tabled(chosen, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the pivot table from rows (row, key, vector, dim, asked, block)."""
    held: dict[tuple, list] = {}
    schema = pa.schema(
        [("dim", pa.int32()), ("block", pa.int64()), ("asked", pa.bool_()), ("n", pa.int32())]
        + [("keys", pa.list_(pa.int64())), ("rows", pa.list_(pa.int64()))]
        + [("vectors", pa.binary()), ("distances", pa.binary())]
    )
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32

    def flush(dim: int, asked: bool) -> pa.RecordBatch:
        nonlocal number
        own = held.pop((dim, asked))
        vectors = np.array([x[2] for x in own], np.int64).reshape(len(own), dim)
        row = {
            "dim": dim,
            "block": number,
            "asked": asked,
            "n": len(own),
            "keys": [x[1] for x in own],
            "rows": [x[0] for x in own],
            "vectors": vectors.astype("<i8").tobytes(),
            "distances": _distances(vectors, chosen.get(dim, np.empty((0, dim)))).astype("<f8").tobytes(),
        }
        number += 1
        return pa.RecordBatch.from_pylist([row], schema=schema)

    for batch in batches:
        for row in batch.to_pylist():
            for asked in (False, True) if row["asked"] else (False,):
                own = held.setdefault((len(row["vector"]), asked), [])
                own.append((row["row"], row["key"], row["vector"]))
                if len(own) >= BLOCK:
                    yield flush(len(row["vector"]), asked)
    for dim, asked in list(held):
        yield flush(dim, asked)


def best_of_block(
    queries: np.ndarray, query_rows: np.ndarray, to_pivots: np.ndarray,
    vectors: np.ndarray, rows: np.ndarray, distances: np.ndarray, rank: np.ndarray, k: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its number, the numbers of its k best vectors and their scores.

    ``rank`` orders vectors with equal scores.
    """
    query_norms, norms = (queries**2).sum(axis=1).astype(float), (vectors**2).sum(axis=1).astype(float)
    for q in range(len(queries)):
        apart = np.zeros(len(vectors))
        if distances.shape[1]:
            apart = np.abs(distances - to_pivots[q]).max(axis=1)
        # Rounding must never lower a bound below the true score.
        apart = np.maximum(apart * (1 - 1e-9) - 1e-6, 0)
        bound = (query_norms[q] + norms - apart**2) / 2
        bound += 1e-9 * np.abs(bound) + 1e-3
        bound[rows == query_rows[q]] = -np.inf
        # The order is only made as far as it is needed.
        left = np.flatnonzero(bound > -np.inf)
        found, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        step = STEP
        while len(left):
            if len(left) > step:
                part = np.argpartition(-bound[left], step)
                now, left = left[part[:step]], left[part[step:]]
            else:
                now, left = left, left[:0]
            found = np.concatenate([found, now])
            scores = np.concatenate([scores, vectors[now] @ queries[q]])
            best = np.lexsort((rank[found], -scores))[:k]
            found, scores = found[best], scores[best]
            if len(scores) == k:
                left = left[bound[left] >= scores[-1]]
            step *= 2
        yield q, found, scores


def _matched(k: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            dim = row["dim"]
            n, m = len(row["q_rows"]), len(row["rows"])
            queries = np.frombuffer(row["q_vectors"], "<i8").reshape(n, dim)
            vectors = np.frombuffer(row["vectors"], "<i8").reshape(m, dim)
            if n and m and dim:
                most = [max(int(x.max()), -int(x.min())) for x in (queries, vectors)]
                if dim * most[0] * most[1] >= 2**63:
                    raise OverflowError("scores of these vectors may exceed 64 bits")
            keys = row["keys"]
            order = sorted(range(m), key=lambda i: (keys[i] is not None, keys[i] or 0, row["rows"][i]))
            rank = np.empty(m, np.int64)
            rank[order] = np.arange(m)
            rows = np.array(row["rows"], np.int64)
            out: tuple[list, ...] = ([], [], [], [], [])
            to_pivots = np.frombuffer(row["q_distances"], "<f8").reshape(n, -1)
            distances = np.frombuffer(row["distances"], "<f8").reshape(m, -1)
            for q, found, scores in best_of_block(
                queries, np.array(row["q_rows"], np.int64), to_pivots, vectors, rows, distances, rank, k
            ):
                out[0].extend([row["q_rows"][q]] * len(found))
                out[1].extend([row["q_keys"][q]] * len(found))
                out[2].extend(rows[found].tolist())
                out[3].extend(keys[i] for i in found)
                out[4].extend(scores.tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in out],
                names=["query_row", "query_id", "vec_row", "vec_id", "score"],
            )


def search(
    spark: SparkSession, vectors: DataFrame, key: str, vector: str, asked: Column, k: int = 5, scale: int = 256
) -> DataFrame:
    """The ``k`` best vectors of each row where ``asked``: query_id, rank (from 1), vec_id, score."""
    rows = vectors.where(usable(F.col(vector))).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("long").alias("key"),
        whole(F.col(vector), scale).alias("vector"),
        F.coalesce(asked, F.lit(False)).alias("asked"),
    )
    # The rows keep their numbers from here on.
    rows = stored(spark, rows, "vectors")
    sample = rows.orderBy(F.xxhash64("vector")).limit(SAMPLE).select("vector").collect()
    by_length: dict[int, list] = {}
    for r in sample:
        by_length.setdefault(len(r.vector), []).append(r.vector)
    chosen = {n: pivots(np.array(own, np.int64).reshape(len(own), n)) for n, own in by_length.items()}
    table = stored(spark, rows.mapInArrow(partial(_tabled, chosen), _TABLE), "pivots")

    fields = ["keys", "rows", "vectors", "distances"]
    asking = table.where("asked").select("dim", F.col("block").alias("q_block"), *[F.col(f).alias(f"q_{f}") for f in fields])
    # Each block of vectors goes to each block of queries of its length.
    targets = asking.groupBy("dim").agg(F.collect_list("q_block").alias("q_blocks"))
    pairs = (
        table.where("NOT asked")
        .select("dim", *fields)
        .join(targets, "dim")
        .withColumn("q_block", F.explode("q_blocks"))
        .drop("q_blocks")
        .join(asking, ["dim", "q_block"])
    )
    best = pairs.mapInArrow(partial(_matched, k), _BEST)
    ranks = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_first(), "vec_row")
    return (
        best.withColumn("rank", F.row_number().over(ranks))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
