import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.brute import TRICKY, documents
from vitrine.llm import language, queries, toxicity
from vitrine.llm.language import Automaton, Model


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.lists(st.integers(0, 3), max_size=12))
def test_automaton_knows_exactly_the_substrings(text, part):
    states, at = Automaton(text).next, 0
    for symbol in part:
        at = states[at].get(symbol, -1)
        if at < 0:
            break
    inside = any(text[i : i + len(part)] == part for i in range(len(text) + 1))
    assert (at >= 0) == inside


@settings(max_examples=200, deadline=None)
@given(st.text("ab c", min_size=1, max_size=40), st.text("abcd ", min_size=1, max_size=60))
def test_phrases_are_longest_matches(known, text):
    model = Model({"x": known})
    symbols = model.read(text)
    own = [int(s) for s in model.read(language.plain(known))]
    wanted, at = 0, 0
    while at < len(symbols):
        size = 0
        while at + size < len(symbols) and any(
            own[i : i + size + 1] == list(symbols[at : at + size + 1]) for i in range(len(own))
        ):
            size += 1
        wanted, at = wanted + 1, at + max(1, size)
    assert model.phrases([symbols]).tolist() == [[wanted]]


def test_long_texts_are_parsed_whole():
    model = Model({"x": "abcabc"})
    symbols = model.read("abc" * 2000)
    assert model.phrases([symbols])[0, 0] == pytest.approx(6000 / 6, rel=0.05)


def test_languages_of_tricky_texts(spark):
    texts = ["the cat and the dog " * 9, "der hund und die katze " * 9] * 4 + TRICKY + ["123 !!", "THE CAT", "die katze"]
    rows = [(i, t, "en" if i % 2 == 0 else "de") for i, t in enumerate(texts)] + [(None, "the cat", None)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    got = language.identify(spark, df, "text", F.col("doc_id") < 8, "lang", F.col("doc_id")).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: (r.lang_pred, r.score) for r in got}
    for i in (8, 9, 10, 11, len(texts) - 3):
        assert by[i] == ("und", 0.0)
    assert by[len(texts) - 2][0] == "en" and by[len(texts) - 1][0] == "de" and by[None][0] == "en"
    assert all(0 <= r.score <= 1 for r in got)
    untaught = language.identify(spark, df, "text", F.lit(False), "lang", F.col("doc_id")).collect()
    assert {r.lang_pred for r in untaught} == {"und"}
    assert language.identify(spark, df.limit(0), "text", F.lit(True), "lang", F.col("doc_id")).count() == 0


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    got = queries.op5_language(spark, sf).join(truth, "doc_id").where("held_out")
    rows = got.collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)


def test_pairs_of_terms_count():
    """Neither term alone tells the label; the pair does."""
    random = np.random.default_rng(3)
    rows = []
    for _ in range(1500):
        a, b = random.integers(0, 2, 2)
        rows.append((np.array(sorted({100 + a, 200 + b, *random.integers(300, 320, 4)})), int(a == b)))
    rows += [(np.array([100, 101, 200, 201]), 1)] * 300  # so that the single terms pass the first test
    model = toxicity.train(rows)
    number = model.known

    def score(*places):
        return model.score([number[p] for p in places if p in number])

    if {100, 101, 200, 201} <= set(number):
        assert min(score(100, 200), score(101, 201)) > 0.5 > max(score(100, 201), score(101, 200))


def test_factorization_equals_the_sum_over_pairs():
    random = np.random.default_rng(1)
    model = toxicity.Model(np.arange(6), 0.3, random.normal(size=6), random.normal(size=(6, 4)))
    terms = [0, 2, 5]
    pairs = sum(model.factors[i] @ model.factors[j] for i in terms for j in terms if i < j)
    total = 0.3 + model.linear[terms].sum() + pairs
    assert model.score(terms) == pytest.approx(1 / (1 + np.exp(-total)))


def test_toxicity_of_tricky_texts(spark):
    texts = [("good day to you all " if i % 4 else "you utter fool ") + f"filler{i}" for i in range(400)]
    df = documents(spark, texts + TRICKY)
    labels = spark.createDataFrame(
        [(i, int(i % 4 == 0)) for i in range(400)] + [(3, None), (None, 1), (9999, 1), (0, 0)], "doc_id long, toxic int"
    )
    model = toxicity.learn(spark, df, "doc_id", "text", labels, "toxic")
    got = {r.doc_id: r.score for r in toxicity.score(spark, df, "text", model, F.col("doc_id")).collect()}
    assert len(got) == len(texts) + len(TRICKY)
    assert all(0 <= s <= 1 for s in got.values())
    assert all((got[i] >= 0.3) == (i % 4 == 0) for i in range(400))
    nothing = toxicity.learn(spark, df, "doc_id", "text", labels.limit(0), "toxic")
    assert toxicity.score(spark, df.limit(0), "text", nothing, F.col("doc_id")).count() == 0
    assert {round(r.score, 3) for r in toxicity.score(spark, df, "text", nothing, F.col("doc_id")).collect()} == {0.0}


def test_driver_gets_only_places_with_weights(spark, monkeypatch):
    assert toxicity.SAMPLE == 8_000
    texts = [("good day " if i % 2 else "you fool ") + " ".join(f"u{i}x{n}" for n in range(300)) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(200)], "doc_id long, toxic int")
    taught, train = [], toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda rows, *known: taught.extend(rows) or train(rows, *known))
    model = toxicity.learn(spark, documents(spark, texts), "doc_id", "text", labels, "toxic")
    assert sorted(y for _, y in taught) == [0] * 100 + [1] * 100
    assert {p for own, _ in taught for p in own.tolist()} == set(model.known)
    assert set(toxicity.places(b"fool")) | set(toxicity.places(b"good")) <= set(model.known)
    assert max(len(own) for own, _ in taught) < 20


def test_scores_follow_the_true_share_where_the_sample_is_cut(spark, monkeypatch):
    """1,000 clean and 200 toxic texts that no word tells apart, of which 100 each are trained on."""
    df = documents(spark, [f"filler{i} text" for i in range(1200)])
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(1200)], "doc_id long, toxic int")
    for bound in (100, 8_000):
        monkeypatch.setattr(toxicity, "SAMPLE", bound)
        model = toxicity.learn(spark, df, "doc_id", "text", labels, "toxic")
        assert model.score([]) == pytest.approx(1 / 6, abs=0.05)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = queries.op1_toxicity(spark, sf).join(labels, "doc_id").where("held_out").collect()
    hit = sum(r.toxic == 1 and r.predicted == 1 for r in rows)
    assert hit >= 0.8 * sum(r.toxic for r in rows)
    assert hit >= 0.9 * sum(r.predicted for r in rows)
