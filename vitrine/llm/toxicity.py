"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its distinct words and their beginnings of four and five bytes (insults are inflected), hashed
into ``2**BITS`` places. The score of a text is the logistic function of

    bias + sum of w[i] over its terms + sum of <v[i], v[j]> over pairs of its terms,

so a pair of terms can count for more or less than its two terms alone. The pair sum takes linear time.

Training uses a bounded sample of labelled rows: at most ``SAMPLE`` of each label, in the order of a hash of the
key, copies once. Where the bound cuts the labels by different parts, the trained bias is put right by these parts,
so scores follow the true share of toxic rows at every size. Terms whose share differs between the labels by ``Z`` standard errors or more have weights; the
others have none, which keeps the noise of long texts out. Places are counted by label in Spark, and the driver gets
these counts (``2**BITS`` at most) and, of each sampled text, only the places that have weights. Weights are trained
by adaptive gradient descent. Whole texts are scored where they lie.

Defined results: a NULL, empty or wordless text has no terms and gets the score of the bias alone. Without labels
of both kinds every score is the share of toxic rows, or 0 without any label. Where a key is labelled more than once
the largest label counts; NULL labels are left out. Repeated rows are scored one by one; an empty table gives no
rows. Other columns are not read, so names may clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.batches import plain_words, stored

BITS = 22
SAMPLE = 8_000
Z = 5.0
LEAST_TEXTS = 5
FACTORS = 8
EPOCHS = 40
BATCH = 256
RATE = 0.1
DECAY = 1e-4
SEED = 7
CACHED_WORDS = 500_000


def places(word: bytes) -> list[int]:
    """Hashed places of a word's terms."""
    terms = [b"w " + word, *[b"p " + word[:n] for n in (4, 5) if len(word) >= n]]
    return [zlib.crc32(t) & ((1 << BITS) - 1) for t in terms]


class Model:
    """Factorization machine over the places that have weights."""

    def __init__(self, known: np.ndarray, bias: float, linear: np.ndarray, factors: np.ndarray):
        self.known = {int(p): n for n, p in enumerate(known)}
        self.bias, self.linear, self.factors = bias, linear, factors
        self._words: dict[bytes, tuple[int, ...]] = {}

    def __getstate__(self):
        return self.__dict__ | {"_words": {}}

    def terms(self, words: Iterable[bytes]) -> list[int]:
        """Numbers of the weighted terms of a text, each once."""
        found: set[int] = set()
        for word in set(words):
            own = self._words.get(word)
            if own is None:
                if len(self._words) >= CACHED_WORDS:
                    self._words.clear()
                own = self._words[word] = tuple(self.known[p] for p in places(word) if p in self.known)
            if own:
                found.update(own)
        return sorted(found)

    def score(self, terms: list[int]) -> float:
        total = self.bias
        if terms:
            v = self.factors[terms]
            total += self.linear[terms].sum() + 0.5 * ((v.sum(axis=0) ** 2).sum() - (v**2).sum())
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def weighted(
    seen: np.ndarray, texts_with: np.ndarray, toxic_with: np.ndarray, positive: float, negative: float
) -> np.ndarray:
    """Of the places seen those that get weights, by the numbers of texts and of toxic texts that hold them."""
    pooled = texts_with / (positive + negative)
    error = np.sqrt(np.maximum(pooled * (1 - pooled), 1e-12) * (1 / positive + 1 / negative))
    apart = np.abs(toxic_with / positive - (texts_with - toxic_with) / negative)
    return np.sort(seen[(texts_with >= LEAST_TEXTS) & (apart / error >= Z)])


def train(rows: list[tuple[np.ndarray, int]], known: np.ndarray | None = None) -> Model:
    """Fit a model to texts given as arrays of distinct places, with labels 0 or 1.

    ``known`` are the places that get weights; without it they are chosen from the texts."""
    labels = np.array([y for _, y in rows], float)
    positive, negative = labels.sum(), len(labels) - labels.sum()
    nothing = np.empty(0, np.int64)
    if not positive or not negative:
        bias = -30.0 if not positive else 30.0
        return Model(nothing, bias, np.empty(0), np.empty((0, FACTORS)))
    size = 1 << BITS
    if known is None:
        with_term, toxic = np.zeros(size, np.int32), np.zeros(size, np.int32)
        for places_, label in rows:  # a text's places are distinct
            with_term[places_] += 1
            toxic[places_] += label
        seen = np.flatnonzero(with_term)
        known = weighted(seen, with_term[seen].astype(float), toxic[seen].astype(float), positive, negative)
        del with_term, toxic

    number = np.full(size, -1, np.int32)
    number[known] = np.arange(len(known))
    texts = [own[own >= 0] for own in (number[p] for p, _ in rows)]
    del number
    random = np.random.default_rng(SEED)
    linear, factors = np.zeros(len(known)), random.normal(0, 0.01, (len(known), FACTORS))
    bias = float(np.log(positive / negative))
    sums = np.full(len(known), 1e-2), np.full(factors.shape, 1e-2)
    bias_sum = 1e-2
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            flat = np.concatenate([texts[i] for i in chosen])
            owner = np.repeat(np.arange(len(chosen)), [len(texts[i]) for i in chosen])
            v = factors[flat]
            total = np.zeros((len(chosen), FACTORS))
            np.add.at(total, owner, v)
            squares = np.bincount(owner, (v**2).sum(axis=1), len(chosen))
            z = bias + np.bincount(owner, linear[flat], len(chosen)) + 0.5 * ((total**2).sum(axis=1) - squares)
            wrong = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[chosen]
            touched, place = np.unique(flat, return_inverse=True)
            step = np.bincount(place, wrong[owner], len(touched)) / len(chosen) + DECAY * linear[touched]
            step_v = np.zeros((len(touched), FACTORS))
            np.add.at(step_v, place, wrong[owner, None] * (total[owner] - v))
            step_v = step_v / len(chosen) + DECAY * factors[touched]
            sums[0][touched] += step**2
            sums[1][touched] += step_v**2
            linear[touched] -= RATE * step / np.sqrt(sums[0][touched])
            factors[touched] -= RATE * step_v / np.sqrt(sums[1][touched])
            own = wrong.mean()
            bias_sum += own**2
            bias -= RATE * own / np.sqrt(bias_sum)
    return Model(known, bias, linear, factors)


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        rows = []
        for i in range(batch.num_rows):
            found = {p for word in set(plain_words(texts[i].as_py())) for p in places(word)}
            rows.append(np.array(sorted(found), np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), pa.array(rows, pa.list_(pa.int32()))], names=["toxic", "places"]
        )


def _kept(known, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text the places that have weights."""
    for batch in batches:
        lists = batch.column("places")
        rows = [lists[i].values.to_numpy() for i in range(batch.num_rows)]
        rows = [own[np.isin(own, known.value)].astype("<u4").tobytes() for own in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), pa.array(rows, pa.binary())], names=["toxic", "places"]
        )


def learn(spark: SparkSession, documents: DataFrame, key: str, text: str, labels: DataFrame, label: str) -> Model:
    """Train on at most ``SAMPLE`` documents of each label. ``labels`` holds the key and the label."""
    one = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias("toxic"))
    totals = {r.toxic: r["count"] for r in one.groupBy("toxic").count().collect()}
    ordered = one.orderBy(F.xxhash64(key), key)
    chosen = [ordered.where(F.col("toxic") == y).limit(SAMPLE) for y in (0, 1)]
    # No more than twice SAMPLE rows of a key and a number: bounded.
    sample = F.broadcast(chosen[0].unionAll(chosen[1]).select(F.col(key).alias("__key"), "toxic"))
    texts = (
        documents.join(sample, documents[key] == F.col("__key"))
        .select("toxic", F.col(text).cast("binary").alias("text"))
        .dropDuplicates(["toxic", "text"])
    )
    hashed = stored(spark, texts.mapInArrow(_hashed, "toxic int, places array<int>"), "toxic-sample")
    sizes = {r.toxic: r["count"] for r in hashed.groupBy("toxic").count().collect()}
    known = np.empty(0, np.int64)
    if sizes.get(0) and sizes.get(1):
        counts = hashed.select("toxic", F.explode("places").alias("place")).groupBy("place")
        counts = counts.agg(F.count("*").alias("texts"), F.sum("toxic").alias("toxic"))
        columns = counts.where(F.col("texts") >= LEAST_TEXTS).toArrow().columns
        seen, texts_with, toxic_with = (c.to_numpy() for c in columns)
        known = weighted(seen, texts_with, toxic_with, sizes[1], sizes[0])
    sent = spark.sparkContext.broadcast(known)
    rows = hashed.mapInArrow(partial(_kept, sent), "toxic int, places binary").collect()
    # The same model whatever the order of tasks.
    rows = sorted(((r.toxic, bytes(r.places)) for r in rows), key=lambda r: (r[0], len(r[1]), r[1]))
    model = train([(np.frombuffer(places_, "<u4"), label) for label, places_ in rows], known)
    if sizes.get(0) and sizes.get(1):
        # Each label was sampled with a share of its own: log(P/N) - log(p/n) of labelled and of chosen rows.
        shares = [min(1.0, SAMPLE / totals[y]) for y in (0, 1)]
        model.bias += float(np.log(shares[0] / shares[1]))
    return model


def _scored(model, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [n for n in batch.schema.names if n != "__text"]
        texts, own = batch.column("__text"), model.value
        scores = [own.score(own.terms(plain_words(texts[i].as_py()))) for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in names], pa.array(scores, pa.float64())], names=[*names, "score"]
        )


def score(spark: SparkSession, documents: DataFrame, text: str, model: Model, *keep: Column) -> DataFrame:
    """The ``keep`` columns of each document with its score from 0 to 1."""
    sent = spark.sparkContext.broadcast(model)
    columns = documents.select(*keep, F.col(text).cast("binary").alias("__text"))
    return columns.mapInArrow(partial(_scored, sent), columns.drop("__text").schema.add("score", "double"))
