"""Hard negatives of anchors, with bounds that run along a spanning tree of the anchors.

A score is the inner product of whole numbers. The score of a candidate at an anchor differs from its score at another
anchor by no more than the anchors' distance times the candidate's norm. So in each block of anchors a least spanning
tree is made; the root's candidates are scored, and each further anchor takes over its parent's scores as intervals,
widened by the edge times the candidates' norms. Only candidates whose interval may enter are scored anew:

1. positives: the ``positives`` best other rows of the anchor's label (a tree per label). Candidates are taken in the
   order of their upper bounds until none can enter.
2. negatives: rows of other labels whose interval overlaps the window of one of the anchor's positives,
   low * positive_score <= 100 * negative_score <= high * positive_score; each positive keeps the ``negatives`` best.

Rows lie in blocks sorted by label and by the place of the largest part, so anchors of a block are alike. Each block of
anchors meets each block of candidates in a row of its own (of overlapping labels only, for positives) and passes on
only the best; the final ranks come from those. Blocks of anchors are small and travel to the blocks of candidates,
which are dealt once.

Defined results: rows with a NULL label or vector, or with NULL or non-finite parts take no part, be it as anchor.
Vectors of another length than the anchor's do not meet it. Ties go to the smaller key (NULL first). An anchor without
positives, and a positive without negatives, give no rows; repeated rows are rows of their own, so an anchor that is there
twice is answered twice and is its own copy's positive. Scores are exact for parts of any size; a score
beyond 64 bits, or a part whose scaled value is no finite double, is an error. Other columns are not read, so names may
clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm.batches import stored
from vitrine.llm.pivot_search import usable

BLOCK = 4096
ANCHORS = 256
STEP = 64

_ROWS = "row long, key long, label long, asked boolean, dim int, lead int, kind string, vector binary"
_BLOCKS = (
    "dim int, block long, least long, most long, kind string, rows array<long>, keys array<long>, labels array<long>, "
    "goals array<array<long>>, vectors binary"
)
_POSITIVES = "anchor_row long, row long, key long, score long"
_NEGATIVES = "anchor_row long, anchor_id long, place int, positive_id long, positive_score long, row long, key long, score long"
_KINDS = ["<i2", "<i4", "<f8"]


def _scaled(scale: float, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as whole numbers in the smallest kind that holds them, and the place of the largest part."""
    for batch in batches:
        out: tuple[list, ...] = ([], [], [], [])
        for vector in batch.column("vector"):
            values = np.floor(scale * np.array(vector.values, np.float64))
            most = float(np.abs(values).max(initial=0))
            if not np.isfinite(most):
                raise OverflowError("a part of a vector is too large to be scaled")
            kind = _KINDS[0] if most < 1 << 15 else _KINDS[1] if most < 1 << 31 else _KINDS[2]
            out[0].append(len(values))
            out[1].append(int(np.abs(values).argmax()) if len(values) else 0)
            out[2].append(kind)
            out[3].append(values.astype(kind).tobytes())
        types = (pa.int32(), pa.int32(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in ("row", "key", "label", "asked")] + [pa.array(c, t) for c, t in zip(out, types)],
            names=["row", "key", "label", "asked", "dim", "lead", "kind", "vector"],
        )


def _blocked(limit: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of sorted rows of one length."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    longs = pa.list_(pa.int64())
    schema = pa.schema(
        [("dim", pa.int32()), ("block", pa.int64()), ("least", pa.int64()), ("most", pa.int64()), ("kind", pa.string())]
        + [("rows", longs), ("keys", longs), ("labels", longs), ("goals", pa.list_(longs)), ("vectors", pa.binary())]
    )
    names = ("dim", "kind", "row", "key", "label", "goals", "vector")
    held: list[tuple] = []

    def flush() -> pa.RecordBatch:
        nonlocal number
        number += 1
        dims, kinds, rows, keys, labels, goals, vectors = zip(*held)
        kind = max(kinds, key=_KINDS.index)
        joined = b"".join(v if k == kind else np.frombuffer(v, k).astype(kind).tobytes() for k, v in zip(kinds, vectors))
        row = {
            "dim": dims[0], "block": number, "least": min(labels), "most": max(labels), "kind": kind, "rows": rows,
            "keys": keys, "labels": labels, "goals": goals, "vectors": joined,
        }
        held.clear()
        return pa.RecordBatch.from_pylist([row], schema=schema)

    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in names)):
            if held and (row[0] != held[0][0] or len(held) >= limit):
                yield flush()
            held.append(row)
    if held:
        yield flush()


class Block:
    """Rows of one length with their norms; scores of them against a vector are exact."""

    def __init__(self, vectors: np.ndarray, rows, keys, labels, goals=None) -> None:
        self.vectors = vectors.astype(np.float64)
        self.rows, self.labels = np.asarray(rows, np.int64), np.asarray(labels, np.int64)
        self.keys, self.goals = keys, goals
        order = sorted(range(len(keys)), key=lambda i: (keys[i] is not None, keys[i] or 0, self.rows[i]))
        self.rank = np.empty(len(keys), np.int64)
        self.rank[order] = np.arange(len(keys))
        self.most = float(np.abs(self.vectors).max(initial=0))
        self.norms = np.sqrt((self.vectors**2).sum(axis=1))
        self.scored = 0

    def small(self, vector: np.ndarray) -> bool:
        """Doubles hold every sum of a score exactly."""
        return len(vector) * float(np.abs(vector).max(initial=0)) * self.most < 2**53

    def scores(self, vector: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Exact scores of the rows ``wanted``; in doubles, or else in whole numbers of any size."""
        self.scored += len(wanted)
        if self.small(vector):
            if 2 * len(wanted) > len(self.vectors):
                return (self.vectors @ vector)[wanted].astype(np.int64)
            return (self.vectors[wanted] @ vector).astype(np.int64)
        other = [int(x) for x in vector]
        exact = [sum(int(x) * y for x, y in zip(self.vectors[i], other)) for i in wanted]
        if any(not -(2**63) <= x < 2**63 for x in exact):
            raise OverflowError("a score has more than 64 bits")
        return np.array(exact, np.int64)


def spanning_tree(vectors: np.ndarray) -> list[tuple[int, int, float]]:
    """(vector, its parent, their distance) in an order in which parents come first; the root has parent -1."""
    squares = (vectors**2).sum(axis=1)
    nearest = np.full(len(vectors), np.inf)
    parent = np.full(len(vectors), -1)
    out, at = [], 0
    left = np.ones(len(vectors), bool)
    for _ in range(len(vectors)):
        left[at] = False
        if parent[at] < 0:
            out.append((at, -1, 0.0))
        else:
            out.append((at, int(parent[at]), float(np.sqrt(((vectors[at] - vectors[parent[at]]) ** 2).sum()))))
        away = squares + squares[at] - 2 * vectors @ vectors[at]
        closer = left & (away < nearest)
        nearest[closer], parent[closer] = away[closer], at
        if left.any():
            at = int(np.where(left, nearest, np.inf).argmin()) if np.isfinite(nearest[left]).any() else int(left.argmax())
    return out


def along_tree(anchors: np.ndarray, rows: Block, choose: Callable[[int, np.ndarray, np.ndarray, Callable], None]) -> None:
    """Visit all anchors. ``choose(anchor, low, high, score)`` gets bounds of all rows' scores.

    ``score(wanted)`` gives exact scores, which the anchor's children start from.
    """
    tree = spanning_tree(anchors)
    children: dict[int, list[tuple[int, float]]] = {}
    for node, parent, edge in tree:
        children.setdefault(parent, []).append((node, edge))
    n = len(rows.rows)
    # Depth first; a node's scores are dropped when its last child has taken them over.
    left = [(node, edge, np.zeros(n), np.full(n, np.inf)) for node, edge in children.get(-1, ())]
    while left:
        node, edge, scores, errors = left.pop()
        scores, errors = scores.copy(), errors + edge * rows.norms
        slack = errors * 1e-9 + np.abs(scores) * 1e-12 + 1e-3

        def score(wanted: np.ndarray) -> np.ndarray:
            exact = rows.scores(anchors[node], wanted)
            scores[wanted], errors[wanted] = exact, 0
            return exact

        # Everything is scored at the root; scores that may be too large only where they are asked for.
        if np.isinf(errors).all() and rows.small(anchors[node]):
            score(np.arange(n))
            slack = np.abs(scores) * 1e-12 + 1e-3
        choose(node, scores - errors - slack, scores + errors + slack, score)
        left.extend((kid, length, scores, errors) for kid, length in children.get(node, ()))


def _best(found: np.ndarray, scores: np.ndarray, rank: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    best = np.lexsort((rank[found], -scores))[:k]
    return found[best], scores[best]


def positives_of_block(anchors: Block, rows: Block, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each anchor its number, the numbers of its k best rows of the same label, and their scores."""
    for label in np.intersect1d(anchors.labels, rows.labels):
        own = np.flatnonzero(anchors.labels == label)
        mine = np.flatnonzero(rows.labels == label)
        part = Block(rows.vectors[mine], rows.rows[mine], [rows.keys[i] for i in mine], rows.labels[mine])
        results = []

        def choose(a: int, low: np.ndarray, high: np.ndarray, score: Callable) -> None:
            high = np.where(part.rows == anchors.rows[own[a]], -np.inf, high)
            left = np.flatnonzero(high > -np.inf)
            found, scores = np.empty(0, np.int64), np.empty(0, np.int64)
            step = STEP
            while len(left):
                now, left = (left[(cut := np.argpartition(-high[left], step))[:step]], left[cut[step:]]) if len(left) > step else (left, left[:0])
                found, scores = np.concatenate([found, now]), np.concatenate([scores, score(now)])
                found, scores = _best(found, scores, part.rank, k)
                if len(found) == k:
                    left = left[high[left] >= scores[-1]]
                step *= 2
            results.append((own[a], mine[found], scores))

        along_tree(anchors.vectors[own], part, choose)
        rows.scored += part.scored
        yield from results


def negatives_of_block(
    anchors: Block, rows: Block, k: int, low: int, high: int
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each anchor and each of its goals (positive scores): both numbers, numbers of the k best rows, their scores."""
    results = []

    def choose(a: int, least: np.ndarray, most: np.ndarray, score: Callable) -> None:
        other = rows.labels != anchors.labels[a]
        goals = anchors.goals[a]
        overlaps = np.zeros(len(other), bool)
        for goal in goals:
            # Divided, so that large scores do not overflow; the bounds have more slack than this loses.
            overlaps |= (most >= low * goal / 100 - 1e-3 - 1e-12 * abs(goal)) & (least <= high * goal / 100 + 1e-3 + 1e-12 * abs(goal))
        found = np.flatnonzero(overlaps & other)
        if not len(found):
            return
        scores = score(found)
        small = max(map(abs, goals)) < 2**55 and np.abs(scores).max() < 2**55
        exact = scores if small else scores.astype(object)
        for place, goal in enumerate(goals):
            fits = np.flatnonzero((low * goal <= 100 * exact) & (100 * exact <= high * goal))
            if len(fits):
                results.append((a, place, *_best(found[fits], scores[fits], rows.rank, k)))

    along_tree(anchors.vectors, rows, choose)
    yield from results


def _sides(batch: pa.RecordBatch, i: int) -> tuple[Block, Block, list]:
    row = {name: batch.column(name)[i] for name in batch.schema.names}
    dim = row["dim"].as_py()

    def block(prefix: str) -> Block:
        kind = row[f"{prefix}kind"].as_py()
        rows = row[f"{prefix}rows"].as_py()
        vectors = np.frombuffer(row[f"{prefix}vectors"].as_buffer(), kind).reshape(len(rows), dim)
        return Block(vectors, rows, row[f"{prefix}keys"].as_py(), row[f"{prefix}labels"].as_py())

    goals = row["a_goals"].as_py()
    return block("a_"), block(""), goals


def _positives(k: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["anchor_row", "row", "key", "score"]
    for batch in batches:
        for i in range(batch.num_rows):
            anchors, rows, _ = _sides(batch, i)
            out: tuple[list, ...] = ([], [], [], [])
            for a, found, scores in positives_of_block(anchors, rows, k):
                out[0].extend([int(anchors.rows[a])] * len(found))
                out[1].extend(rows.rows[found].tolist())
                out[2].extend(rows.keys[j] for j in found)
                out[3].extend(scores.tolist())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)


def _negatives(k: int, low: int, high: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 5]
    names = [part.split()[0] for part in _NEGATIVES.split(", ")]
    for batch in batches:
        for i in range(batch.num_rows):
            anchors, rows, goals = _sides(batch, i)
            # A goal is (positive's key or NULL, its score).
            anchors.goals = [own[1::2] for own in goals]
            out: list[list] = [[] for _ in names]
            for a, place, found, scores in negatives_of_block(anchors, rows, k, low, high):
                n = len(found)
                own = (int(anchors.rows[a]), anchors.keys[a], place, goals[a][2 * place], goals[a][2 * place + 1])
                for column, value in zip(out, own):
                    column.extend([value] * n)
                out[5].extend(rows.rows[found].tolist())
                out[6].extend(rows.keys[j] for j in found)
                out[7].extend(scores.tolist())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)


def _blocks(spark: SparkSession, rows: DataFrame, goals: Column, limit: int, label: str) -> DataFrame:
    order = ["dim", "label", "lead", "row"]
    ranged = rows.withColumn("goals", goals).repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(spark, ranged.mapInArrow(partial(_blocked, limit), _BLOCKS), label)


def _met(anchors: DataFrame, rows: DataFrame, same_label: bool) -> DataFrame:
    """Each block of anchors with each block of rows of its length (and of overlapping labels)."""
    a = anchors.select("dim", F.col("block").alias("a_block"), F.col("least").alias("a_least"), F.col("most").alias("a_most"))
    b = rows.select("dim", "block", "least", "most")
    overlap = (F.col("least") <= F.col("a_most")) & (F.col("a_least") <= F.col("most"))
    # Blocks of a single label that agree have no negatives.
    other = ~((F.col("least") == F.col("a_most")) & (F.col("a_least") == F.col("most")) & (F.col("a_least") == F.col("a_most")))
    pairs = a.join(b, "dim").where(overlap if same_label else other).select("a_block", "block")
    fields = ["kind", "rows", "keys", "labels", "goals", "vectors"]
    sent = anchors.select(F.col("block").alias("a_block"), *[F.col(f).alias(f"a_{f}") for f in fields])
    return pairs.join(sent, "a_block").join(rows.select("block", "dim", *[f for f in fields if f != "goals"]), "block").drop("a_block", "block")


def mine(
    spark: SparkSession, rows: DataFrame, key: str, label: Column, vector: str, asked: Column,
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows where ``asked``.

    ``low`` and ``high`` are hundredths of the positive's score.
    """
    good = rows.where(usable(F.col(vector)) & label.isNotNull()).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("long").alias("key"),
        label.cast("long").alias("label"),
        F.coalesce(asked, F.lit(False)).alias("asked"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    # The rows keep their numbers from here on.
    table = stored(spark, good.mapInArrow(partial(_scaled, float(scale)), _ROWS), "vectors")
    none = F.lit(None).cast("array<long>")
    candidates = _blocks(spark, table, none, BLOCK, "candidates")
    anchors = table.where("asked")

    met = _met(_blocks(spark, anchors, none, ANCHORS, "anchors"), candidates, True)
    best = met.mapInArrow(partial(_positives, positives), _POSITIVES)
    ranks = Window.partitionBy("anchor_row").orderBy(F.col("score").desc(), F.col("key").asc_nulls_first(), "row")
    best = best.withColumn("place", F.row_number().over(ranks)).where(F.col("place") <= positives)
    goals = best.groupBy(F.col("anchor_row").alias("row")).agg(F.sort_array(F.collect_list(F.struct("place", "key", "score"))).alias("best"))
    asking = anchors.join(goals, "row")
    told = F.flatten(F.transform("best", lambda g: F.array(g["key"], g["score"])))

    met = _met(_blocks(spark, asking, told, ANCHORS, "goals"), candidates, False)
    found = met.mapInArrow(partial(_negatives, negatives, low, high), _NEGATIVES)
    ranks = Window.partitionBy("anchor_row", "place").orderBy(F.col("score").desc(), F.col("key").asc_nulls_first(), "row")
    return (
        found.withColumn("rank", F.row_number().over(ranks))
        .where(F.col("rank") <= negatives)
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("key").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
