"""Substring dedup by repeated-phrase automata: of every passage of 20 words or more, the first occurrence stays.

1. Documents are cut into segments, runs of documents with about ``SEGMENT_WORDS`` words, stored in a table that is
   bucketed by segment: whatever is found out about a segment later meets its texts without shuffling them.
2. Of every window of 20 words, the least of its 8-word phrases (by hash) is its anchor. Equal windows have equal
   anchors, and about one phrase in seven is one. Segments send the hashes of their distinct anchors; those that
   occur twice anywhere are confirmed as recurring and sent back to the segments that hold them.
3. Each segment compiles Aho-Corasick automata of its recurring phrases, over words as symbols, and streams all its
   documents through them. The windows around the places found whose anchor recurs are the candidates; no other
   window can occur twice. All but the first of equal windows in a segment are removed at once; the first one is
   compared with those of the other segments (two independent hashes of 64 and 32 bits decide). What is sent per
   segment and window is one entry, however many copies the segment holds.
4. The places to remove go back to the segments, whose texts are read a last time.

All windows are judged on the input: order is by document key (NULL first), documents with one key in the order of the
table, then by place.

Defined results: a NULL, empty or blank text has no words; a text shorter than a window loses nothing. Repeated rows
keep the words of one of them. An empty table gives no rows. Words are split at ASCII blanks and never changed.

A segment sends a row per bucket in steps 2 and 3, so the number of rows grows with segments times buckets; there are
an eighth as many buckets as segments. Beyond some 10,000 segments make ``segment_words`` larger.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.batches import blank_words, give_back, mixed
from vitrine.session import scratch_dir

WINDOW = 20
PHRASE = 8
SEGMENT_WORDS = 700_000
AUTOMATON_PHRASES = 100_000
BUCKETS = 8  # at least

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_DIGITS = 128  # three of them tell two million words apart
_NONE = np.iinfo(np.uint64).max
_NO_KEY = np.iinfo(np.int64).min


def _power(base: int, n: int) -> np.uint64:
    return np.uint64(pow(base, n, 1 << 64))


def _runs(words: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of 8 and of 20 words from each place (wrapping past the end: callers mask)."""
    with np.errstate(over="ignore"):

        def joined(a: np.ndarray, b: np.ndarray, offset: int, size: int) -> np.ndarray:
            """Runs of ``a`` followed by runs of ``b`` (of ``size`` words) that start ``offset`` later."""
            return a * _power(base, size) + np.roll(b, -offset)

        two = joined(words, words, 1, 1)
        four = joined(two, two, 2, 2)
        eight = joined(four, four, 4, 4)
        sixteen = joined(eight, eight, 8, 8)
        return mixed(eight), mixed(joined(sixteen, four, 16, 4))


def _lowest(values: np.ndarray) -> np.ndarray:
    """Least of the 13 values from each place (those past the end count as none)."""
    out = np.concatenate([values, np.full(WINDOW, _NONE, np.uint64)])
    for step in (1, 2, 4):
        out = np.minimum(out[:-step], out[step:])
    rest = WINDOW - PHRASE + 1 - 8
    return np.minimum(out[:-rest], out[rest:])[: len(values)]


class Segment:
    """Words of a run of documents, one after the other in the order of precedence."""

    def __init__(self, keys: list[int | None], texts: list[bytes | None]):
        self.order = sorted(range(len(keys)), key=lambda i: (keys[i] is not None, keys[i] or 0, i))
        self.keys = np.array([_NO_KEY if keys[i] is None else keys[i] for i in self.order], np.int64)
        self.words = [blank_words(texts[i]) for i in self.order]
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.total = int(self.lengths.sum())

    def hash(self) -> None:
        """Symbols, anchors and hashes of windows."""
        numbers: dict[bytes, int] = {}
        ids = np.empty(self.total, np.int32)
        for start, words in zip(self.starts.tolist(), self.words):
            for word in set(words).difference(numbers):
                numbers[word] = len(numbers)
            ids[start : start + len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
        self.ids = ids
        self.words = []  # half of a segment's memory, and not needed any more
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))
        left = np.repeat(self.starts + self.lengths, self.lengths) - np.arange(self.total)  # words to the end
        own = hashes[ids] if self.total else np.empty(0, np.uint64)
        phrases, self.windows = _runs(own, _BASES[0])
        self.second = _runs(mixed(own + np.uint64(1)), _BASES[1])[1]
        self.phrases = np.where(left >= PHRASE, phrases, _NONE)
        self.whole = left >= WINDOW
        self.anchors = np.where(self.whole, _lowest(self.phrases), _NONE)

    def anchor_places(self) -> np.ndarray:
        """Places whose phrase is the anchor of a window."""
        # A phrase is one if the greatest of the anchors of the windows that hold it is itself.
        held = np.concatenate([np.zeros(WINDOW - PHRASE, np.uint64), np.where(self.whole, self.anchors, 0)])
        best = _lowest(~held.astype(np.uint64))[: self.total]
        return np.flatnonzero((~best == self.phrases) & (self.phrases != _NONE))

    def located(self, recurring: np.ndarray) -> np.ndarray:
        """Places of all recurring phrases, found by streaming the documents through their automaton."""
        places = self.anchor_places()
        places = places[np.isin(self.phrases[places], recurring)]
        _, first = np.unique(self.phrases[places], return_index=True)
        if not len(first):
            return np.empty(0, np.int64)
        found: list[int] = []
        for at in range(0, len(first), AUTOMATON_PHRASES):
            found.extend(self._streamed(places[first[at : at + AUTOMATON_PHRASES]]))
        return np.array(found, np.int64)

    def _streamed(self, phrases: np.ndarray) -> Iterator[int]:
        """Places in all documents of the phrases that stand at the given places."""
        # A word of a phrase is three characters, each from an alphabet of its own, so that phrases only match from
        # a word's start and no state has many ways to go on. All other words are a character that no phrase has.
        used = np.unique(self.ids[(phrases[:, None] + np.arange(PHRASE)).ravel()])
        numbers = np.arange(len(used))
        symbols = np.full((int(self.ids.max()) + 1, 3), 1, "<u4")
        for digit in range(3):
            symbols[used, digit] = 2 + digit * _DIGITS + numbers // _DIGITS**digit % _DIGITS
        text = symbols[self.ids].tobytes()
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for place in phrases.tolist():
            automaton.add_word(text[12 * place : 12 * (place + PHRASE)].decode("utf-32-le"), 1)
        automaton.make_automaton()
        for start, size in zip(self.starts.tolist(), self.lengths.tolist()):
            if size >= WINDOW:
                own = text[12 * start : 12 * (start + size)].decode("utf-32-le")
                for end, _ in automaton.iter(own):
                    yield start + end // 3 - PHRASE + 1

    def candidates(self, recurring: np.ndarray) -> np.ndarray:
        """Starts of the windows whose anchor is among the phrases located."""
        hit = np.full(self.total, _NONE, np.uint64)
        at = self.located(recurring)
        hit[at] = self.phrases[at]
        return np.flatnonzero(self.whole & (_lowest(hit) == self.anchors) & (self.anchors != _NONE))

    def kept(self, removed: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
        """For each document (in the given order) the number of removed words and the words that stay."""
        change = np.zeros(self.total + 1, np.int64)
        np.add.at(change, removed, 1)
        np.add.at(change, removed + WINDOW, -1)
        gone = np.cumsum(change)[:-1] > 0
        counts = np.zeros(len(self.order), np.int64)
        kept: list[list[bytes]] = [[]] * len(self.order)
        for n, (place, start, words) in enumerate(zip(self.order, self.starts.tolist(), self.words)):
            own = gone[start : start + len(words)]
            counts[place] = int(own.sum())
            kept[place] = [w for w, g in zip(words, own.tolist()) if not g] if counts[place] else words
        return counts, kept


def _packed(batch_rows: list[pa.RecordBatch]) -> bytes:
    """Rows of a segment as one value."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch_rows[0].schema) as writer:
        for batch in batch_rows:
            writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(value: bytes) -> pa.Table:
    return pa.ipc.open_stream(value).read_all()


def _segments(limit: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` words."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    total = 0

    def flush() -> pa.RecordBatch:
        nonlocal number, total
        row = pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([_packed(held)], pa.binary())], names=["segment", "documents"]
        )
        number, total = number + 1, 0
        held.clear()
        return row

    for batch in batches:
        texts, start = batch.column("__text"), 0
        for i in range(batch.num_rows):
            size = len(texts[i].as_py() or b"") // 6 + 1  # words, near enough
            if total and total + size > limit:
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield flush()
                start = i
            total += size
        if batch.num_rows > start:
            held.append(batch.slice(start))
    if held:
        yield flush()


def _of(value: bytes) -> Segment:
    table = _unpacked(value)
    return Segment(table.column("__key").to_pylist(), table.column("__text").to_pylist())


def _sent_anchors(buckets: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct anchors of each segment by bucket, and which of them it holds twice."""
    for batch in batches:
        for number, value in zip(batch.column("segment").to_pylist(), batch.column("documents")):
            segment = None  # the last one goes before the next one comes
            give_back()
            segment = _of(value.as_py())
            segment.hash()
            found, counts = np.unique(segment.phrases[segment.anchor_places()], return_counts=True)
            bucket = (found % np.uint64(buckets)).astype(np.int64)
            rows = [
                (b, number, found[own].tobytes(), (counts[own] > 1).tobytes())
                for b in np.unique(bucket).tolist()
                if (own := bucket == b).any()
            ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                    names=["bucket", "segment", "anchors", "twice"],
                )


def _confirmed(table: pa.Table) -> pa.Table:
    """Of one bucket's anchors those that occur twice, by segment."""
    own = [np.frombuffer(x, np.uint64) for x in table.column("anchors").to_pylist()]
    twice = np.concatenate([np.frombuffer(x, bool) for x in table.column("twice").to_pylist()])
    found, place, counts = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
    recurs = counts > 1
    recurs[place[twice]] = True
    ends = np.cumsum([len(x) for x in own])
    keep = recurs[place]
    rows = [x[keep[end - len(x) : end]].tobytes() for x, end in zip(own, ends)]
    return pa.table([table.column("segment"), pa.array(rows, pa.binary())], names=["segment", "anchors"])


_PLACES = "bucket long, segment long, local boolean, hashes binary, second binary, keys binary, places binary"


def _sent_windows(buckets: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First candidates of each segment by bucket; the places of all others, which are removed in any case."""
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    for batch in batches:
        for row in batch.to_pylist():
            recurring = np.concatenate([np.frombuffer(x, np.uint64) for x in row["anchors"]])
            segment = None
            give_back()
            segment = _of(row["documents"])
            segment.hash()
            at = segment.candidates(recurring)
            # Stable sorting keeps equal windows in the order of their places.
            order = np.lexsort((segment.second[at], segment.windows[at]))
            ordered = at[order]
            later = np.zeros(len(at), bool)
            later[order[1:]] = (segment.windows[ordered[1:]] == segment.windows[ordered[:-1]]) & (
                segment.second[ordered[1:]] == segment.second[ordered[:-1]]
            )
            rows: list[tuple] = []
            if later.any():
                rows.append((row["segment"] % buckets, row["segment"], True, None, None, None, at[later].astype("<u4").tobytes()))
            at = at[~later]
            # Dealt by the window, not by its anchor: a frequent phrase is the anchor of many different windows.
            bucket = (segment.windows[at] % np.uint64(buckets)).astype(np.int64)
            documents = np.searchsorted(segment.starts + segment.lengths, at, "right")
            keys = segment.keys[documents]
            for b in np.unique(bucket).tolist():
                own = bucket == b
                places = at[own]
                rows.append(
                    (b, row["segment"], False, segment.windows[places].tobytes(), segment.second[places].astype("<u4").tobytes())
                    + (keys[own].tobytes(), places.astype("<u4").tobytes())
                )
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                    names=["bucket", "segment", "local", "hashes", "second", "keys", "places"],
                )


def _removed(table: pa.Table) -> pa.Table:
    """Places of the windows of a bucket that start earlier in another segment; local ones are passed on."""
    rows = table.to_pylist()
    out = [(r["segment"], r["places"]) for r in rows if r["local"]]
    rows = [r for r in rows if not r["local"]]
    if rows:
        hashes = np.concatenate([np.frombuffer(r["hashes"], np.uint64) for r in rows])
        second = np.concatenate([np.frombuffer(r["second"], "<u4") for r in rows])
        keys = np.concatenate([np.frombuffer(r["keys"], np.int64) for r in rows])
        places = np.concatenate([np.frombuffer(r["places"], "<u4") for r in rows])
        sizes = [len(r["places"]) // 4 for r in rows]
        segments = np.repeat(np.array([r["segment"] for r in rows], np.int64), sizes)
        order = np.lexsort((places, segments, keys, second, hashes))
        same = (hashes[order][1:] == hashes[order][:-1]) & (second[order][1:] == second[order][:-1])
        again = np.zeros(len(order), bool)
        again[order[1:][same]] = True
        end = 0
        for r, size in zip(rows, sizes):
            own = again[end : end + size]
            if own.any():
                out.append((r["segment"], places[end : end + size][own].tobytes()))
            end += size
    return pa.table(
        [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())], names=["segment", "places"]
    )


def _cleaned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the segments with counts and the words that stay."""
    for batch in batches:
        for row in batch.to_pylist():
            segment = kept = texts = None
            give_back()
            table = _unpacked(row["documents"])
            segment = Segment(table.column("__key").to_pylist(), table.column("__text").to_pylist())
            places = [np.frombuffer(x, "<u4").astype(np.int64) for x in row["places"] or []]
            removed, kept = segment.kept(np.concatenate(places) if places else np.empty(0, np.int64))
            lengths = np.empty(len(segment.order), np.int64)
            lengths[segment.order] = segment.lengths
            texts = [b" ".join(words) for words in kept]
            names = [n for n in table.column_names if n not in ("__key", "__text")]
            extra = table.select(names).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [
                    *[extra.column(n).combine_chunks() if len(extra) else pa.array([], extra.schema.field(n).type) for n in names],
                    pa.array(lengths),
                    pa.array(removed),
                    pa.array([t.decode("utf-8", "surrogatepass") for t in texts], pa.string()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                ],
                names=[*names, "n_words", "n_removed", "kept_text", "kept_sha256"],
            )


def remove_repeats(
    spark: SparkSession, documents: DataFrame, key: str, text: str, *keep: Column, segment_words: int = SEGMENT_WORDS
) -> DataFrame:
    """The ``keep`` columns of each document with n_words, n_removed, kept_text (words joined by one space) and
    kept_sha256 of that text."""
    rows = documents.select(
        *keep, F.col(key).cast("long").alias("__key"), F.col(text).cast("binary").alias("__text")
    )
    name = f"segments_{uuid.uuid4().hex}"
    partitions = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    (
        rows.mapInArrow(partial(_segments, segment_words), "segment long, documents binary")
        .write.option("compression", "zstd")
        .option("path", scratch_dir(spark, name))
        .bucketBy(partitions, "segment")
        .saveAsTable(name)
    )
    segments = spark.table(name)
    buckets = max(BUCKETS, segments.count() // 8)

    sent = segments.mapInArrow(
        partial(_sent_anchors, buckets), "bucket long, segment long, anchors binary, twice binary"
    )
    recurring = sent.groupBy("bucket").applyInArrow(_confirmed, "segment long, anchors binary")
    of_segment = recurring.groupBy("segment").agg(F.collect_list("anchors").alias("anchors"))
    located = segments.join(of_segment.hint("shuffle_hash"), "segment").mapInArrow(
        partial(_sent_windows, buckets), _PLACES
    )
    places = located.groupBy("bucket").applyInArrow(_removed, "segment long, places binary")
    by_segment = places.groupBy("segment").agg(F.collect_list("places").alias("places"))
    kept = rows.drop("__key", "__text").schema
    for field, kind in (("n_words", "long"), ("n_removed", "long"), ("kept_text", "string"), ("kept_sha256", "string")):
        kept = kept.add(field, kind)
    return segments.join(by_segment.hint("shuffle_hash"), "segment", "left").select("documents", "places").mapInArrow(
        _cleaned, kept
    )
