import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.brute import TRICKY, documents
from vitrine.llm import near_copies, queries
from vitrine.llm.batches import plain_words
from vitrine.llm.components import components


def bags(words):
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def share(a, b):
    common = sum((a & b).values())
    total = sum(a.values()) + sum(b.values())
    return common / (total - common) if total else 0.0


def edited(random, words, edits):
    """Words with single substitutions, insertions and deletions."""
    words = list(words)
    for _ in range(edits):
        at = int(random.integers(0, len(words)))
        kind = random.integers(0, 3)
        if kind == 0:
            words[at] = f"new{random.integers(0, 10**9)}"
        elif kind == 1:
            words.insert(at, f"new{random.integers(0, 10**9)}")
        else:
            del words[at]
    return words


def test_alignment_counts_common_kmers():
    random = np.random.default_rng(4)
    for _ in range(300):
        base = [f"w{x}" for x in random.integers(0, 10**9, int(random.integers(5, 200)))]
        other = edited(random, base, int(random.integers(0, 5)))
        if len(other) < 5:
            continue
        numbers = {w: n for n, w in enumerate({*base, *other})}
        a, b = (np.array([numbers[w] for w in words], "<u4") for words in (base, other))
        exact = share(bags(base), bags(other))
        got = near_copies.similarity(a, b)
        assert got == pytest.approx(exact if exact >= 0.8 else 0.0, abs=1e-9)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=30), st.lists(st.integers(0, 3), max_size=30))
def test_alignment_never_exceeds_the_bags(a, b):
    got = near_copies.similarity(np.array(a, "<u4"), np.array(b, "<u4")) if a and b else 0.0
    if a and b and min(len(a), len(b)) >= 5:
        assert got <= share(bags(a), bags(b)) + 1e-9
    assert near_copies.similarity(np.array(a, "<u4"), np.array(a, "<u4")) == 1.0 or not a


def test_edits_cost_what_levenshtein_says():
    random = np.random.default_rng(5)
    for _ in range(200):
        a, b = random.integers(0, 3, int(random.integers(1, 12))), random.integers(0, 3, int(random.integers(1, 12)))
        row = list(range(len(b) + 1))
        for i in range(len(a)):
            row, last = [i + 1], row
            for j in range(len(b)):
                row.append(min(last[j + 1] + 1, row[j] + 1, last[j] + (a[i] != b[j])))
        assert near_copies._matched(a, b, row[-1]) is not None
        assert near_copies._matched(a, b, row[-1] - 1) is None


def classes_of(rows):
    """Classes by brute force; all pairs must be clear of the threshold."""
    words = [plain_words(t.encode()) if t else [] for _, t in rows]
    own = [bags(w) for w in words]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if words[i] and words[j] and (words[i] == words[j] or share(own[i], own[j]) >= 0.8):
            root[find(j)] = find(i)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(i)
    return members


def corpus():
    random = np.random.default_rng(6)
    texts = []
    for group in range(12):
        base = [f"g{group}w{i}" for i in range(int(random.integers(60, 400)))]
        texts.append(" ".join(base))
        for _ in range(int(random.integers(0, 9))):
            texts.append(" ".join(edited(random, base, max(1, len(base) // 200))))
        texts += [texts[-1].upper() + "!"] * int(random.integers(0, 3))
    boiler = " ".join(f"b{i}" for i in range(60))
    texts += [boiler + " " + " ".join(f"u{k}_{i}" for i in range(60)) for k in range(25)]
    texts += ["a b c", "A, b. C", "a b", "one two three four five", "one two three four five six"] + ["the " * 40] * 2
    return texts


def test_classes_against_brute_force(spark):
    rows = list(enumerate(corpus() + TRICKY + TRICKY[4:6])) + [(3, corpus()[3]), (None, corpus()[0]), (None, "???")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS node").repartition(3)
    got = near_copies.classes(spark, df, "doc_id", "text").collect()
    wanted = Counter()
    for members in classes_of(rows).values():
        keys = [rows[i][0] for i in members]
        name = min((k for k in keys if k is not None), default=None)
        wanted.update((k, name, len(members)) for k in keys)
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in got) == wanted
    kept = near_copies.one_of_each(spark, df, "doc_id", "text")
    assert kept.columns == df.columns
    found = Counter(r.doc_id for r in kept.collect())
    names = Counter(
        min((rows[i][0] for i in members if rows[i][0] is not None), default=None) for members in classes_of(rows).values()
    )
    assert found == names


def test_chains_are_one_class(spark):
    """Each text is similar to the next alone."""
    base = [f"w{i}" for i in range(300)]
    rows, words = [], list(base)
    for k in range(14):
        rows.append((k, " ".join(words)))
        words[20 * k + 5] = f"x{k}"
        words[20 * k + 12] = f"y{k}"
    rows = rows[::-1]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.class_id, r.class_size) for r in near_copies.classes(spark, df, "doc_id", "text").collect()} == {(0, 14)}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(300, 200), (200, 250), (7, 7), (1, 0)]
    got = {r.node: r.root for r in components(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}, 300: 200, 250: 200}
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table(spark):
    none = documents(spark, ["a"]).limit(0)
    assert near_copies.classes(spark, none, "doc_id", "text").count() == 0
    assert near_copies.one_of_each(spark, none, "doc_id", "text").count() == 0


def test_recall_on_given_documents(spark):
    """Every pair of near copies by brute force is in one class, and classes hold no strangers."""
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r.class_id for r in queries.op6_near_copies(spark, sf).collect()}
    own = {i: bags(plain_words(t.encode())) for i, t in rows if t}
    holders = {}
    for i, bag in own.items():
        for run in bag:
            holders.setdefault(run, []).append(i)
    pairs = {p for ids in holders.values() if len(ids) < 60 for p in combinations(sorted(ids), 2)}
    near = {p for p in pairs if share(own[p[0]], own[p[1]]) >= 0.8}
    assert near
    missed = [p for p in near if got[p[0]] != got[p[1]]]
    assert len(missed) <= 0.01 * len(near)
    linked = {i for p in near for i in p}
    assert all(i == c or i in linked for i, c in got.items())


@pytest.mark.parametrize("block_rows", [1024, 7])
def test_large_group_just_below_the_threshold(spark, monkeypatch, block_rows):
    """Texts of one template of which few are similar: classes as from all pairs, whatever the blocks."""
    monkeypatch.setattr(near_copies, "BLOCK_ROWS", block_rows)
    chance = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(90):
        words = list(base)
        for at in chance.sample(range(120), chance.choice([1, 2, 3, 4])):
            words[at] = f"x{k}-{at}"
        rows.append((k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_copies.classes(spark, df, "doc_id", "text").collect()}
    # Only substitutions, so the alignment's common k-mers are those of the bags.
    wanted = {rows[i][0]: name for name, members in classes_of(rows).items() for i in members}
    pairs = [(a, b) for a in got for b in got if a < b and wanted[a] == wanted[b]]
    found = sum(got[a] == got[b] for a, b in pairs)
    assert len(pairs) > 100 and found >= 0.9 * len(pairs)  # recall in a large group
    assert all(wanted[a] == wanted[b] for a in got for b in got if a < b and got[a] == got[b])


def test_bounds_keep_all_similar_pairs():
    random_ = np.random.default_rng(4)
    texts = []
    for _ in range(60):
        words = np.arange(80, dtype=np.uint64)
        at = random_.choice(80, random_.integers(0, 6), replace=False)
        words[at] = random_.integers(1000, 10**6, len(at))
        texts.append(words)
    n, bits = [], []
    for words in texts:
        runs = near_copies.labelled(near_copies.kmers(words))
        marks = np.zeros(near_copies.BITS, np.uint8)
        marks[(runs % np.uint64(near_copies.BITS)).astype(np.int64)] = 1
        n.append(len(runs))
        bits.append(np.packbits(marks).view(np.int64))
    everyone = np.arange(60)
    a, b = near_copies.possible_pairs(np.array(n), np.array(bits).view(np.uint64), everyone, everyone, everyone)
    found = set(zip(a.tolist(), b.tolist()))
    similar = {(i, j) for i in range(60) for j in range(60) if i != j and near_copies.similarity(texts[i], texts[j]) >= 0.8}
    assert similar and similar <= found
