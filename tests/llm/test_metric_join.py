import math
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vitrine.llm import metric_join, queries

SCHEMA = "vec_id long, embedding array<float>, label int, node string, cell int"


def brute(rows):
    """Links and classes of (key, vector) as the contract words them."""

    def good(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    vectors = [np.array(v, np.float32).astype(float) if good(v) else None for _, v in rows]
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = vectors[i], vectors[j]
            if a is None or b is None or len(a) != len(b):
                continue
            if a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= 0.9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        members[find(i)].append(key)
    out = []
    for i, (key, _) in enumerate(rows):
        least = min((k for k in members[find(i)] if k is not None), default=None)
        out.append((key, links[i], least, key == least))
    return sorted(map(repr, out))


def vectors():
    random = np.random.default_rng(8)
    centres = random.normal(size=(12, 6))
    rows = []
    for c, centre in enumerate(centres):  # tight and loose groups, chains between them
        for _ in range(4 + 9 * c):
            rows.append([float(x) for x in centre + random.normal(0, 0.05 + 0.04 * c, 6)])
    rows += [[float(x) for x in random.normal(size=6)] for _ in range(150)]
    rows += [rows[5]] * 60 + [[2 * x for x in rows[5]], [-x for x in rows[5]]]  # copies, a multiple, the opposite
    rows = list(enumerate(rows))
    rows += [(1000, None), (1001, [1.0, None]), (1002, [float("nan")] * 6), (1003, [float("inf")] * 6), (1004, []), (1005, [0.0] * 6)]
    rows += [(1006, [1.0, 0.0]), (1007, [1.0, 0.01]), (1008, [-0.0, 1.0]), (1009, [0.0, 1.0]), (None, [1.0, 0.1]), (None, None)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (2000, [1e38] * 6), (2001, [1e-38] * 6)]
    return rows


@pytest.mark.parametrize("cell_rows, block_bytes, tile", [(16_384, 2 << 20, 2048), (40, 600, 8), (25, 300, 64)])
def test_query_against_brute_force(spark, tmp_path, monkeypatch, cell_rows, block_bytes, tile):
    monkeypatch.setattr(metric_join, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(metric_join, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(metric_join, "TILE", tile)
    rows = vectors()
    df = spark.createDataFrame([(k, v, 1, "x", 2) for k, v in rows], SCHEMA)
    df.repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = queries.op12_near_vectors(spark, str(tmp_path))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(rows)


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    assert queries.op12_near_vectors(spark, str(tmp_path)).count() == 0


def test_cells_spare_comparisons(spark, monkeypatch):
    """On clustered vectors few visit other cells, and the core of a tight group is not compared."""
    random = np.random.default_rng(3)
    centres = random.normal(size=(8, 32))
    units = metric_join.unit(np.repeat(centres, 100, axis=0) + random.normal(0, 0.03, (800, 32)))
    radius = math.acos(0.9)
    pivots = metric_join.choose(units, 8, radius)
    away = metric_join.angles(units, pivots)
    assert (np.bincount(away.argmin(axis=1), minlength=8) == 100).all()
    assert (away.min(axis=1) <= radius / 2).all()  # all are cores


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_compare_blocks(data):
    n, m = data.draw(st.integers(1, 14)), data.draw(st.integers(1, 14))
    random = np.random.default_rng(data.draw(st.integers(0, 10**6)))
    near = data.draw(st.sampled_from([0.9, 0.5, 0.99]))
    base = random.normal(size=(3, 3))
    both = metric_join.unit(base[random.integers(0, 3, n + m)] + random.normal(0, 0.3, (n + m, 3)))
    counts = random.integers(1, 5, n + m)
    tile, metric_join.TILE = metric_join.TILE, data.draw(st.integers(1, 6))
    try:
        for same in (False, True):
            a, b = (both, both) if same else (both[:n], both[n:])
            ac, bc = (counts, counts) if same else (counts[:n], counts[n:])
            a_links, b_links, group = metric_join.compare(a, b, ac, bc, near, same)
            linked = a @ b.T >= near
            if same:
                np.fill_diagonal(linked, False)
            assert (a_links == linked @ bc).all()
            if not same:
                assert (b_links == linked.T @ ac).all()
            for i, j in np.argwhere(linked):
                assert group[i] == group[j if same else n + j]
            # Groups are no larger than the links make them.
            size = len(group)
            reach = np.eye(size, dtype=bool)
            for i, j in np.argwhere(linked):
                k = j if same else n + j
                reach[i, k] = reach[k, i] = True
            for _ in range(size):
                reach = reach @ reach
            assert all(reach[i, group[i]] for i in range(size))
    finally:
        metric_join.TILE = tile
