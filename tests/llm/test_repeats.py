import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import TRICKY
from vitrine.llm import phrase_automata, queries


def brute(rows, size=20):
    """Rows (doc_id, text) in the order of the table."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    seen, out = set(), []
    for i in order:
        words = (rows[i][1] or "").encode().split()
        gone = [False] * len(words)
        for a in range(len(words) - size + 1):
            window = tuple(words[a : a + size])
            if window in seen:
                gone[a : a + size] = [True] * size
            seen.add(window)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((rows[i][0], len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, out))


def corpus(seed, documents):
    random = np.random.default_rng(seed)
    shared = [[f"s{p}_{i}" for i in range(int(random.integers(15, 60)))] for p in range(6)]
    few = ["a", "b"]
    texts = []
    for _ in range(documents):
        words: list[str] = []
        for _ in range(int(random.integers(0, 5))):
            kind = random.integers(0, 4)
            if kind == 0:
                words += [f"u{x}" for x in random.integers(0, 10**6, int(random.integers(0, 40)))]
            elif kind == 1:
                part = shared[int(random.integers(0, 6))]
                start = int(random.integers(0, 10))
                words += part[start : start + int(random.integers(10, 60))]
            elif kind == 2:
                words += [few[x] for x in random.integers(0, 2, int(random.integers(0, 30)))]
            else:
                words += ["the"] * int(random.integers(0, 70))
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("segment_words", [50, 700, 10**6])
def test_against_brute_force(spark, segment_words):
    texts = corpus(segment_words, 160)
    rows = [(int(k), t) for k, t in zip(np.random.default_rng(1).permutation(160), texts)]
    rows += [(500 + i, t) for i, t in enumerate(TRICKY)] + [(700 + i, texts[3]) for i in range(9)]
    rows += [(None, texts[5]), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1L segment", "'x' documents").repartition(3)
    rows = [(r.doc_id, r.text) for r in df.collect()]  # in the order of the table
    got = phrase_automata.remove_repeats(spark, df, "doc_id", "text", F.col("doc_id"), F.col("documents"), segment_words=segment_words)
    found = sorted(repr((r.doc_id, r.n_words, r.n_removed, r.kept_sha256)) for r in got.collect())
    assert found == brute(rows)


def test_small_table_and_empty_table(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op4_repeats(spark, sf).collect()
    assert sorted(map(repr, map(tuple, got))) == brute(rows)
    spark.read.parquet(f"{sf}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.op4_repeats(spark, str(tmp_path)).count() == 0


def test_windows_around_a_frequent_line_spread_over_the_buckets(spark):
    """A line shorter than a window in every document: few anchors, but all windows differ."""
    line = " ".join(f"line{i}" for i in range(19))
    texts = [" ".join([*(f"a{n}_{i}" for i in range(15)), line, *(f"b{n}_{i}" for i in range(15))]) for n in range(400)]
    documents = pa.RecordBatch.from_arrays(
        [pa.array(range(400), pa.int64()), pa.array([t.encode() for t in texts], pa.binary())], names=["__key", "__text"]
    )
    packed = phrase_automata._packed([documents])
    segment = phrase_automata._of(packed)
    segment.hash()
    found, counts = np.unique(segment.phrases[segment.anchor_places()], return_counts=True)
    row = pa.RecordBatch.from_arrays(
        [pa.array([0], pa.int64()), pa.array([packed], pa.binary()), pa.array([[found[counts > 1].tobytes()]], pa.list_(pa.binary()))],
        names=["segment", "documents", "anchors"],
    )
    sizes = np.zeros(8, int)
    for batch in phrase_automata._sent_windows(8, [row]):
        for sent in batch.to_pylist():
            if not sent["local"]:
                sizes[sent["bucket"]] += len(sent["places"]) // 4
    assert sizes.sum() > 4000 and sizes.max() < 1.2 * sizes.mean()

    df = spark.createDataFrame([*enumerate(texts), (400, texts[7])], "doc_id long, text string")
    rows = [tuple(r) for r in df.collect()]
    got = phrase_automata.remove_repeats(spark, df, "doc_id", "text", F.col("doc_id"), segment_words=2000)
    assert sorted(repr((r.doc_id, r.n_words, r.n_removed, r.kept_sha256)) for r in got.collect()) == brute(rows)
