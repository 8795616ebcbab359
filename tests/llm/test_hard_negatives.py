import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.test_filters import by_duckdb, ordered
from vitrine.llm import hard_negatives, queries, sql
from vitrine.llm.hard_negatives import Block

SCHEMA = "vec_id long, embedding array<float>, label int, row string, block int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def vectors():
    random = np.random.default_rng(5)
    rows = [(i, [float(x) for x in random.normal(0, 0.3, 8)], int(random.integers(0, 4))) for i in range(700)]
    rows += [(i, rows[i % 40][1], rows[i % 11][2]) for i in range(700, 900)]  # ties and copies
    rows += [(900, None, 1), (1000, [1.0, None], 1), (1100, [float("nan")] * 8, 1), (1200, [float("inf")] * 8, 1)]
    rows += [(1300, rows[3][1], None), (1400, [1.0, 0.5], 2), (1401, [0.9, 0.6], 2), (1402, [0.5, 0.2], 3), (1403, [0.6, 0.2], 3)]
    rows += [(1500, [], 1), (1501, [], 1), (1502, [], 2), (100, rows[100][1], rows[100][2]), (None, rows[2][1], 1), (1600, [0.5], -1)]
    return rows


@pytest.mark.parametrize("block, anchors", [(4096, 256), (50, 3)])
def test_query_against_sql(spark, tmp_path, monkeypatch, block, anchors):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    monkeypatch.setattr(hard_negatives, "STEP", 4)
    df = spark.createDataFrame([(*r, "x", 1) for r in vectors()], SCHEMA)
    df.coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = queries.op13_hard_negatives(spark, str(tmp_path))
    assert sorted(got.columns) == sorted(NAMES)
    wanted = by_duckdb(f"SELECT {', '.join(NAMES)} FROM ({sql.OP13})", embeddings=df)
    assert len(wanted) > 100
    assert ordered(got, NAMES) == wanted


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    assert queries.op13_hard_negatives(spark, str(tmp_path)).count() == 0


def test_large_parts_are_exact(spark):
    big = 2.0**40
    rows = [(0, [big, 1.0], 1), (1, [1.0, 3.0], 1), (2, [0.5, 1.0], 2), (3, [big, 0.0], 2)]
    df = spark.createDataFrame(rows[:3], "id long, v array<double>, label int")
    (row,) = hard_negatives.mine(spark, df, "id", F.col("label"), "v", F.col("id") == 0, scale=1, low=0).collect()
    assert (row.positive_score, row.negative_score) == (2**40 + 3, 1)
    exact = spark.createDataFrame([(0, [3.0**20, 1.0], 1), (1, [3.0**19, 7.0], 1), (2, [3.0**18, 5.0], 2)], "id long, v array<double>, label int")
    with_wide = hard_negatives.mine(spark, exact, "id", F.col("label"), "v", F.col("id") == 0, scale=1).collect()
    assert [(r.positive_score, r.negative_score) for r in with_wide] == [(3**39 + 7, 3**38 + 5)]
    too_large = spark.createDataFrame([(0, [big], 1), (1, [big], 1)], "id long, v array<double>, label int")
    with pytest.raises(Exception, match="64 bits"):
        hard_negatives.mine(spark, too_large, "id", F.col("label"), "v", F.col("id") == 0, scale=1).collect()


def clusters(groups, per_group, dim=16, spread=3.0):
    random = np.random.default_rng(1)
    centres = random.normal(0, 120, (groups, dim))
    vectors = np.repeat(centres, per_group, axis=0) + random.normal(0, spread, (groups * per_group, dim))
    return np.floor(vectors), np.repeat(np.arange(groups), per_group)


def test_most_candidates_are_not_scored():
    """On clustered vectors the intervals leave only what may enter."""
    vectors, labels = clusters(20, 100)
    n = len(vectors)
    rows = Block(vectors, range(n), list(range(n)), labels)
    at = np.arange(0, n, 20)
    anchors = Block(vectors[at], at, at.tolist(), labels[at])
    goals = {}
    for a, found, scores in hard_negatives.positives_of_block(anchors, rows, 5):
        goals[a] = scores.tolist()
        exact = vectors @ vectors[at[a]]
        exact[labels != labels[at[a]]] = -np.inf
        exact[at[a]] = -np.inf
        assert scores.tolist() == sorted(exact.tolist(), reverse=True)[:5]
    anchors.goals = [goals[a] for a in range(len(at))]
    rows.scored = 0
    list(hard_negatives.negatives_of_block(anchors, rows, 10, 30, 90))
    assert rows.scored < 0.4 * len(at) * n


@settings(max_examples=100, deadline=None)
@given(st.data())
def test_bounds_hold(data):
    n, m, dim = data.draw(st.integers(1, 12)), data.draw(st.integers(1, 20)), data.draw(st.integers(0, 4))
    random = np.random.default_rng(data.draw(st.integers(0, 10**6)))
    size = data.draw(st.sampled_from([3, 300, 10**6]))
    vectors = random.integers(-size, size + 1, (m, dim)).astype(float)
    anchors = random.integers(-size, size + 1, (n, dim)).astype(float)
    rows = Block(vectors, range(m), list(range(m)), np.zeros(m))
    seen = []

    def choose(a, low, high, score):
        exact = vectors @ anchors[a]
        assert (low <= exact).all() and (exact <= high).all()
        wanted = np.flatnonzero(random.integers(0, 2, m))
        assert (score(wanted) == exact[wanted]).all()
        seen.append(a)

    hard_negatives.along_tree(anchors, rows, choose)
    assert sorted(seen) == list(range(n))
