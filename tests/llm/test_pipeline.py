from collections import Counter

import corpus_pipeline
import public_tokenizers
from tests.llm.brute import TRICKY, ids
from tests.llm.test_near_copies import classes_of
from vitrine.llm import positional_index
from vitrine.llm.batches import plain_words

PASSAGE = " ".join(f"shared{i}" for i in range(60))
ITEM = " ".join(f"test{i}" for i in range(20))


def own(n, size=40):
    return " ".join(f"d{n}w{i}" for i in range(size))


def fixture():
    texts = [own(n) for n in range(12)]
    texts += [own(2), own(3).upper(), own(0, 40) + " tail"]  # copies of documents 2, 3 and 0
    texts += [own(20) + "\n" + PASSAGE, own(21) + " " + PASSAGE + " " + own(22), PASSAGE + " " + own(23)]
    texts += [own(24) + " " + ITEM, ITEM, own(25, 600) + " " + ITEM]  # contaminated, contaminated, hardly
    texts += [own(26, 3000), "12345 !!", *TRICKY]
    rows = [(i, t, "en", "s", len(t or ""), "x") for i, t in enumerate(texts)]
    return rows + [(5, texts[5], "en", "s", 1, "x"), (None, own(40), None, None, None, None)]


def brute(rows):
    """Documents (doc_id, text) that the last stage packs."""
    docs = [(r[0], r[1]) for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    classes = classes_of(docs).values()
    docs = [min((docs[i] for i in c), key=lambda d: (d[0] is None, d[0] or 0)) for c in classes]
    seen, left = set(), []
    for key, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        words = text.encode().split()
        gone = [False] * len(words)
        for a in range(len(words) - 19):
            window = tuple(words[a : a + 20])
            if window in seen:
                gone[a : a + 20] = [True] * 20
            seen.add(window)
        if any(gone):
            if all(gone):
                continue
            text = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        left.append((key, text))
    windows = positional_index.windows(plain_words(ITEM.encode()))
    out = []
    for key, text in left:
        words, hit = plain_words(text.encode()), set()
        for w in windows:
            for a in range(len(words) - len(w) + 1):
                if tuple(words[a : a + len(w)]) == w:
                    hit.update(range(a, a + len(w)))
        if not hit or 20 * len(hit) < len(words):
            out.append((key, text))
    return out


def test_pipeline_against_brute_force(spark, tmp_path):
    rows = fixture()
    schema = "doc_id long, text string, lang string, source string, n_chars long, `__text` string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    wanted = Counter((key, len(ids("word_bpe_49k.json", text))) for key, text in brute(rows))
    lengths = Counter()
    for r in got:
        lengths[r.doc_id] += r.length
    assert Counter(lengths.items()) == wanted
    assert public_tokenizers.path("word_bpe_49k.json")


def test_stages_keep_the_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, node string"
    df = spark.createDataFrame([(1, own(1), "en", "s", 5, 0.5, "n"), (2, None, None, None, None, None, None)], schema)
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, df, str(tmp_path))
        assert found.columns == df.columns
        assert [tuple(r) for r in found.where("doc_id = 1").collect()] == [(1, own(1), "en", "s", 5, 0.5, "n")]
        assert stage(spark, df.limit(0), str(tmp_path)).count() == 0


def test_stage_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "repeats", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
