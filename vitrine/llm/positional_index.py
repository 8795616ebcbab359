"""Benchmark decontamination on a distributed positional inverted index of the training documents.

``build`` stores the postings of every token. The index is divided by documents, as search engines do: a segment
is a run of documents with about ``SEGMENT_WORDS`` words, and a row holds its terms with their positions, so no
posting is shuffled. Positions count through the segment with a gap between documents, so no phrase crosses them.

``search`` takes phrases (lists of words with the item they stem from). In each segment a phrase's lists of
positions, each less the term's offset, are intersected from the rarest term on, so most phrases end at a term
that the segment lacks. ``phrases`` are exact matches; ``proximity`` finds the places where all terms of a phrase
lie within ``slop`` words of its rarest. The phrases are sent to the segments in blocks of a fixed size, however many
there are; hits of all blocks are put together by document.

Words are lower-cased (A-Z) runs of digits, letters a-z and characters beyond ASCII.

Defined results: a NULL, empty or wordless text has no words and no hits. Repeated documents are judged one by
one; repeated item ids count once, a missing id counts as the empty text. Items without words are left out; an
item with fewer words than a window is one window. Empty tables give no rows or no hits. Other columns are not
read, so names may clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.batches import plain_words, stored
from vitrine.session import scratch_dir

SEGMENT_WORDS = 1_000_000
WINDOW = 13
BLOCK_BYTES = 4 << 20
BROADCAST_ROWS = 100_000  # of a key and a hash: some megabytes

INDEX = (
    "segment long, doc_id array<long>, fingerprint array<long>, n_words array<long>, "
    "terms binary, counts binary, positions binary"
)
HITS = "segment long, doc int, spans array<struct<from:long,to:long>>, items array<string>"


class Segment:
    """Postings of a run of documents."""

    def __init__(self, terms: list[bytes], counts: np.ndarray, positions: np.ndarray, n_words: np.ndarray):
        self.numbers = dict(zip(terms, range(len(terms))))
        self.counts = counts
        self.positions = positions
        self.ends = np.cumsum(counts)
        # A document starts after the words of those before it and a gap for each.
        self.starts = np.cumsum(n_words) - n_words + np.arange(len(n_words))

    @classmethod
    def read(cls, row: dict) -> Segment:
        return cls(
            row["terms"].split(),
            np.frombuffer(row["counts"], "<u4").astype(np.int64),
            np.frombuffer(row["positions"], "<u4").astype(np.int64),
            np.array(row["n_words"], np.int64),
        )

    def of(self, term: int) -> np.ndarray:
        """Ascending positions of a term."""
        return self.positions[self.ends[term] - self.counts[term] : self.ends[term]]

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """Positions at which these terms follow one another."""
        order = np.argsort(self.counts[terms], kind="stable")
        at = self.of(terms[order[0]]) - order[0]
        for k in order[1:]:
            if not len(at):
                break
            own = self.of(terms[k])
            place = np.searchsorted(own, at + k)
            at = at[(place < len(own)) & (own[np.minimum(place, len(own) - 1)] == at + k)]
        return at

    def near(self, terms: np.ndarray, slop: int) -> np.ndarray:
        """Positions of the rarest term with every other term at most ``slop`` words away, in the same document."""
        order = np.argsort(self.counts[terms], kind="stable")
        at = self.of(terms[order[0]])
        doc = np.searchsorted(self.starts, at, "right")
        for k in order[1:]:
            own = self.of(terms[k])
            low, high = np.maximum(at - slop, self.starts[doc - 1]), at + slop
            bound = np.append(self.starts, np.iinfo(np.int64).max)[doc] - 1
            inside = np.searchsorted(own, low) < np.searchsorted(own, np.minimum(high, bound - 1), "right")
            at, doc = at[inside], doc[inside]
        return at


def _built(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    first = TaskContext.get().partitionId() << 32
    numbers: dict[bytes, int] = {}
    documents: list[tuple] = []
    held: list[np.ndarray] = []
    total, segments = 0, 0

    def flush() -> pa.RecordBatch:
        nonlocal total, segments
        n_words = np.array([d[2] for d in documents], np.int64)
        ids = np.concatenate(held) if held else np.empty(0, np.int32)
        gaps = np.repeat(np.arange(len(n_words)), n_words)
        positions = np.arange(len(ids)) + gaps
        order = np.argsort(ids, kind="stable")
        row = {
            "segment": first + segments,
            "doc_id": [d[0] for d in documents],
            "fingerprint": [d[1] for d in documents],
            "n_words": n_words.tolist(),
            "terms": b" ".join(numbers),
            "counts": np.bincount(ids, minlength=len(numbers)).astype("<u4").tobytes(),
            "positions": positions[order].astype("<u4").tobytes(),
        }
        longs = pa.list_(pa.int64())
        batch = pa.RecordBatch.from_pylist(
            [row],
            schema=pa.schema(
                [("segment", pa.int64()), ("doc_id", longs), ("fingerprint", longs), ("n_words", longs)]
                + [(n, pa.binary()) for n in ("terms", "counts", "positions")]
            ),
        )
        numbers.clear()
        documents.clear()
        held.clear()
        total, segments = 0, segments + 1
        return batch

    for batch in batches:
        texts = batch.column("text")
        for i, (key, mark) in enumerate(zip(batch.column("key").to_pylist(), batch.column("fingerprint").to_pylist())):
            words = plain_words(texts[i].as_py())
            if documents and total + len(words) > SEGMENT_WORDS:
                yield flush()
            for word in set(words).difference(numbers):
                numbers[word] = len(numbers)
            held.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
            documents.append((key, mark, len(words)))
            total += len(words)
    if documents:
        yield flush()


def build(spark: SparkSession, documents: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """Write the index of all documents to ``path``. A fingerprint (hash) of each text is kept beside its key."""
    columns = documents.select(
        F.col(key).cast("long").alias("key"),
        F.xxhash64(F.col(text)).alias("fingerprint"),
        F.col(text).cast("binary").alias("text"),
    )
    columns.mapInArrow(_built, INDEX).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(INDEX).parquet(path)


def windows(words: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    """Distinct runs of ``size`` words; a shorter list is one window, an empty one none."""
    n = max(1, len(words) - size + 1) if words else 0
    return list(dict.fromkeys(tuple(words[i : i + size]) for i in range(n)))


def _searched(phrases, slop: int | None, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``phrases``: broadcast dictionary from phrase to the items that have it."""
    wanted: dict[tuple[bytes, ...], list[str]] = phrases.value
    schema = pa.schema(
        [("segment", pa.int64()), ("doc", pa.int32())]
        + [("spans", pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())])))]
        + [("items", pa.list_(pa.string()))]
    )
    vocabulary = {term: n for n, term in enumerate({t for p in wanted for t in p})}
    by_size: dict[int, list[tuple[bytes, ...]]] = {}
    for phrase in wanted:
        by_size.setdefault(len(phrase), []).append(phrase)
    tables = {n: np.array([[vocabulary[t] for t in p] for p in own]) for n, own in by_size.items()}
    for batch in batches:
        for row in batch.to_pylist():
            segment = Segment.read(row)
            local = np.array([segment.numbers.get(t, -1) for t in vocabulary], np.int64)
            spans: dict[int, list[tuple[int, int]]] = {}
            items: dict[int, set[str]] = {}
            for size, table in tables.items():
                terms = local[table]
                for k in np.flatnonzero((terms >= 0).all(axis=1)):
                    at = segment.phrase(terms[k]) if slop is None else segment.near(terms[k], slop)
                    docs = np.searchsorted(segment.starts, at, "right") - 1
                    for doc, start in zip(docs.tolist(), (at - segment.starts[docs]).tolist()):
                        spans.setdefault(doc, []).append((start, start + (size if slop is None else 1)))
                        items.setdefault(doc, set()).update(wanted[by_size[size][k]])
            if spans:
                rows = [
                    {
                        "segment": row["segment"],
                        "doc": doc,
                        "spans": [{"from": a, "to": b} for a, b in _united(own)],
                        "items": sorted(items[doc]),
                    }
                    for doc, own in spans.items()
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(items: DataFrame, size: int) -> Iterator[dict[tuple[bytes, ...], list[str]]]:
    """Windows of the items in blocks of about ``BLOCK_BYTES`` bytes of windows."""
    block: dict[tuple[bytes, ...], list[str]] = {}
    held = 0
    for row in items.toLocalIterator(prefetchPartitions=False):
        for window in windows(plain_words(row.text and bytes(row.text)), size):
            block.setdefault(window, []).append(row.item)
            held += sum(map(len, window)) + len(row.item)
            if held > BLOCK_BYTES:
                yield block
                block, held = {}, 0
    if block:
        yield block


def search(
    spark: SparkSession,
    index: DataFrame,
    benchmark: DataFrame,
    item: str,
    text: str,
    size: int = WINDOW,
    slop: int | None = None,
) -> DataFrame:
    """Documents with hits: segment, doc (number in it), spans of words (from, to) and items.

    With ``slop`` a hit is the place of the rarest term with all others near it.
    """
    asked = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).cast("binary").alias("text"))
    hits = None
    for block in _blocks(asked, size):
        sent = spark.sparkContext.broadcast(block)
        columns = index.select("segment", "n_words", "terms", "counts", "positions")
        found = columns.mapInArrow(partial(_searched, sent, slop), HITS)
        hits = found if hits is None else hits.unionAll(found)
    if hits is None:
        return spark.createDataFrame([], HITS)
    return hits.groupBy("segment", "doc").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )


def covered(spans):
    """Number of words in the union of the spans of a document."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    total = F.aggregate(
        F.array_sort(spans),
        start,
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0).cast("long"), x["to"] - F.greatest(x["from"], s["end"]))).alias("n"),
            F.greatest(s["end"], x["to"]).alias("end"),
        ),
    )
    return total["n"]


def judge(index: DataFrame, hits: DataFrame, share: int = 20) -> DataFrame:
    """One row per document: doc_id, fingerprint, n_words, n_hit, items, contaminated.

    A document is contaminated if one word in ``share`` or more is hit.
    """
    base = index.select(
        "segment", F.posexplode(F.arrays_zip("doc_id", "fingerprint", "n_words")).alias("doc", "d")
    ).select("segment", "doc", "d.doc_id", "d.fingerprint", "d.n_words")
    joined = base.join(
        hits.select("segment", "doc", covered(F.col("spans")).alias("hit"), "items"), ["segment", "doc"], "left"
    )
    n_hit = F.coalesce("hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id",
        "fingerprint",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(
    spark: SparkSession, documents: DataFrame, key: str, text: str, benchmark: DataFrame, item: str, item_text: str
) -> DataFrame:
    """The documents without the contaminated ones, with all their columns."""
    index = build(spark, documents, key, text, scratch_dir(spark, "positions"))
    bad = judge(index, search(spark, index, benchmark, item, item_text)).where("contaminated")
    bad = bad.select(F.col("doc_id").alias("__key"), F.col("fingerprint").alias("__mark")).distinct()
    # Few documents are contaminated as a rule: then no text is shuffled to leave them out.
    bad = stored(spark, bad, "contaminated")
    if bad.count() <= BROADCAST_ROWS:
        bad = F.broadcast(bad)
    same = (F.xxhash64(documents[text]) == F.col("__mark")) & documents[key].cast("long").eqNullSafe(F.col("__key"))
    return documents.join(bad, same, "left_anti")
