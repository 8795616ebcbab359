import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.brute import TRICKY, documents
from tests.llm.test_filters import by_duckdb, ordered
from vitrine.llm import pivot_search, positional_index, queries, sql
from vitrine.llm.batches import WORD_PATTERN, plain_words


def test_search_as_sql(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pivot_search, "BLOCK", 40)
    monkeypatch.setattr(pivot_search, "STEP", 4)
    random = np.random.default_rng(2)
    rows = [(i, [float(x) for x in random.normal(0, 0.2, 8)]) for i in range(230)]
    rows += [(i, rows[i % 7][1]) for i in range(230, 300)]  # ties
    rows += [(300, None), (350, [1.0, None]), (400, [float("nan")] * 8), (450, [float("inf")] * 8), (500, []), (501, [])]
    rows += [(550, [1.0, 2.0]), (551, [-1.0, 0.5]), (0, rows[3][1]), (None, rows[50][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("block", F.lit("x"))
    df.repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = queries.op2_pivot_search(spark, str(tmp_path))
    names = ["query_id", "rank", "vec_id", "score"]
    assert ordered(got, names) == by_duckdb(sql.OP2, embeddings=df)


def test_search_without_vectors_or_queries(spark):
    df = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")
    for part in (df, df.limit(0)):
        assert pivot_search.search(spark, part, "vec_id", "embedding", F.col("vec_id") % 50 == 0).count() == 0


def test_scores_never_wrap(spark):
    schema = "vec_id long, embedding array<double>"
    large = spark.createDataFrame([(0, [4e9, 1.0]), (1, [3.9e9, 1.0])], schema)
    with pytest.raises(Exception, match="64 bits"):
        pivot_search.search(spark, large, "vec_id", "embedding", F.col("vec_id") == 0, scale=1).collect()
    fits = spark.createDataFrame([(0, [2e9, 1.0]), (1, [2e9, 1.0])], schema)
    (row,) = pivot_search.search(spark, fits, "vec_id", "embedding", F.col("vec_id") == 0, scale=1).collect()
    assert row.score == 4 * 10**18 + 1


@settings(max_examples=100, deadline=None)
@given(st.data())
def test_elimination_keeps_the_best(data):
    dim, n, k = data.draw(st.integers(1, 4)), data.draw(st.integers(1, 30)), data.draw(st.integers(1, 6))
    part = st.lists(st.integers(-300, 300), min_size=dim, max_size=dim)
    vectors = np.array(data.draw(st.lists(part, min_size=n, max_size=n)), np.int64)
    chosen = pivot_search.pivots(vectors, 3)
    away = pivot_search._distances(vectors, chosen)
    rows = np.arange(n)
    for q, found, scores in pivot_search.best_of_block(vectors, rows, away, vectors, rows, away, rows, k):
        wanted = sorted(((-int(vectors[i] @ vectors[q]), i) for i in range(n) if i != q))[:k]
        assert [(-int(s), int(i)) for i, s in zip(found, scores)] == wanted


ITEMS = ["one two three", "The quick brown fox jumps over the lazy dog and then runs far away home.", None, "", "!!", "Quick"]


def brute_decontamination(texts, items):
    wanted = {}
    for i, t in items:
        words = plain_words(t.encode()) if t else []
        for w in positional_index.windows(words):
            wanted.setdefault(w, set()).add(str(i) if i is not None else "")
    out = []
    for i, t in texts:
        words = plain_words(t.encode()) if t else []
        hit, found = set(), set()
        for w, own in wanted.items():
            for a in range(len(words) - len(w) + 1):
                if tuple(words[a : a + len(w)]) == w:
                    hit.update(range(a, a + len(w)))
                    found |= own
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(words), len(hit), len(found), ids, bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(map(repr, out))


def test_decontamination_against_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(positional_index, "SEGMENT_WORDS", 300)
    monkeypatch.setattr(positional_index, "BLOCK_BYTES", 60)  # several blocks of phrases
    long_item = " ".join(f"w{i % 19}" for i in range(60))
    items = [(i, t) for i, t in enumerate([*ITEMS, long_item, long_item])] + [(0, "one two three"), (None, "lazy dog")]
    texts = [*TRICKY, "ONE, two; three! one two three", "x " * 100 + "one two three", "one two", "three one two three", ITEMS[1]]
    texts += ["a " + ITEMS[1] + " quick", " ".join(f"w{(i + 5) % 19}" for i in range(400)), "one", "two three lazy", "dog"]
    rows = list(enumerate(texts)) + [(3, "one two three"), (None, "the lazy dog")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0L segment", "'a' items")
    df.coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    got = queries.op3_decontamination(spark, str(tmp_path))
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    wanted = brute_decontamination(rows, items)
    assert ordered(got, names) == wanted
    left = positional_index.decontaminate(spark, df, "doc_id", "text", benchmark, "item_id", "text")
    assert left.columns == df.columns
    assert left.count() == sum(w.endswith("False)") for w in wanted)
    # An empty benchmark leaves everything.
    assert positional_index.decontaminate(spark, df, "doc_id", "text", benchmark.limit(0), "item_id", "text").count() == len(rows)


def test_proximity(spark, tmp_path):
    df = documents(spark, ["alpha x x beta", "beta x x x x x x alpha", "alpha", "beta alpha gamma", None])
    index = positional_index.build(spark, df, "doc_id", "text", str(tmp_path / "index"))
    items = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    hits = positional_index.search(spark, index, items, "item_id", "text", slop=3)
    judged = positional_index.judge(index, hits).where("n_hit > 0").collect()
    assert sorted(r.doc_id for r in judged) == [0, 3]


def test_words_follow_the_pattern():
    texts = [t for t in TRICKY if t] + ["\x00a\x7fb@C[d`e{f/0:9 é ü"]
    for t in texts:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), t)
        assert [w.decode() for w in plain_words(t.encode())] == re.findall(WORD_PATTERN, lower)
