import textwrap

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import documents
from vitrine.llm import licence_rules, queries, sql, url_filter

URLS = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://A.NET/x?y#z", "x://a.example.net/en/",
    "x://a.example.net/en", "x://example.com/de/?q", "x://example.com/fr/a", "x://notexample.com/de/", "x://org/fr/1",
    "x://b.org/fr/", "x://b.org/en/", "x://spam-farm.x.org/a", "x://spam-farm.x.org/a?b", "x://SPAM-farm.x.org/A",
    "x://ÄB.org/fr/ü", "a://b://c.net/", "x://casino-win.com", "x://example.net/en/x", "x://" + "a." * 5000 + "net/p",
    "http://net/", "x://a.net?/b", "x://a.net#/b", "x://m.cheap-pills.example.com/q",
]


def by_duckdb(statement, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    return sorted(map(repr, con.sql(statement).fetchall()))


def ordered(df, names):
    return sorted(repr(tuple(r)) for r in df.select(*names).collect())


def test_urls_as_sql(spark, tmp_path):
    pages = spark.createDataFrame(
        [(i, u, "h") for i, u in enumerate(URLS)] + [(0, URLS[9], "h"), (None, URLS[9], "h")],
        "page_id long, url string, rule string",
    )
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    got = queries.op8_url_filter(spark, str(tmp_path))
    names = ["page_id", "host", "path", "rule", "verdict"]
    assert ordered(got, names) == by_duckdb(sql.OP8, pages=pages)
    assert queries.op8_url_filter(spark, str(tmp_path)).count() == len(URLS) + 2


def test_no_rules_and_no_list(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (2, None)], "page_id long, url string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    listed = spark.createDataFrame([], "host string, path string")
    got = url_filter.judge(spark, pages, rules, listed, "page_id", "url")
    assert {r.verdict for r in got.collect()} == {"allow"}
    assert url_filter.judge(spark, pages.limit(0), rules, listed, "page_id", "url").count() == 0


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"))
    blocks = 4000 * url_filter.BITS_PER_KEY // 256
    filter_ = url_filter.bloom(keys, blocks)
    assert url_filter.may_be_listed(keys, filter_, blocks).count() == 4000
    others = spark.range(4000).select(F.concat(F.lit("other"), "id").alias("key"))
    assert url_filter.may_be_listed(others, filter_, blocks).count() < 40


def test_longer_list_than_blocks_stays_exact(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_BLOCKS", 1)
    pages = spark.range(500).select("id", F.concat(F.lit("x://h/"), "id").alias("url"))
    listed = spark.range(0, 500, 3).select(F.lit("h").alias("host"), F.concat(F.lit("/"), "id").alias("path"))
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    got = url_filter.judge(spark, pages, rules, listed, "id", "url")
    assert {r.id for r in got.where("verdict = 'block'").collect()} == set(range(0, 500, 3))


LICENCE_TEXTS = [
    None, "", "\n", "x. Released under the MIT License.", "Released under the MIT License\nLicensed under CC BY 4.0.",
    "LICENSED under the apache-license, version 2.0! Licensed under CC BY-NC 4.0. all rights reserved.",
    "\n".join([licence_rules.SENTENCES[3], "", licence_rules.SENTENCES[4]]),
    " ".join(licence_rules.SENTENCES[n] for n in (10, 11)), licence_rules.SENTENCES[10],
    "Not released under the MIT License.", "Released under the MIT License." * 3, "a. " * 20000 + "Released under the MIT License.",
    licence_rules.SENTENCES[4] + "\n" + licence_rules.SENTENCES[3],
]


def test_licences_as_sql(spark):
    df = documents(spark, LICENCE_TEXTS + LICENCE_TEXTS)
    got = licence_rules.scan(df, "doc_id", "text")
    names = ["doc_id", "n_sentences", "sentence_ids", "licences", "n_matches"]
    assert ordered(got, names) == by_duckdb(sql.oracle_sql()["op9_licences"], documents=df)
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[6].licences == "MIT" and rows[6].n_matches == 1
    assert rows[7].licences == "GPL-3.0-or-later" and rows[7].n_matches == 1
    assert rows[5].licences == "Apache-2.0,CC-BY-NC-4.0"
    assert rows[9].licences == "" and rows[12].licences == ""


def test_wrapped_licences(spark):
    known = licence_rules.SENTENCES

    def wrapped(start, *numbers):
        """Lines of some 50 letters, each with a comment sign."""
        return textwrap.fill(" ".join(known[n] for n in numbers), 50, initial_indent=start, subsequent_indent=start)

    apache = " ".join(known[n] for n in (6, 7, 8)) + " http://www.apache.org/licenses/LICENSE-2.0"
    gpl = known[10] + " " + known[11] + " without even the implied warranty."
    cases = [
        ("MIT", wrapped("", 3) + "\n\n" + wrapped("", 4)),
        ("MIT", wrapped(" * ", 3) + "\n *\n" + wrapped(" * ", 4)),
        ("GPL-3.0-or-later", wrapped("# ", 10, 11)),
        ("GPL-3.0-or-later", gpl),
        ("GPL-3.0-or-later", textwrap.fill(gpl, 60)),
        ("BSD", "All rights reserved.\n\n" + wrapped("    ", 16).replace("\n", "\r\n") + "\r\n\r\n1. x"),
        ("Apache-2.0", apache),
        ("Apache-2.0", textwrap.fill(apache, 40)),
        ("Apache-2.0", known[6] + "\n" + known[7] + "\n" + known[8] + "\n\n    http://www.apache.org/"),
        ("", wrapped("", 16).replace("\n", "\n\n")),
        ("", "never " + " ".join(known[16].split()) + " x"),
    ]
    got = {r.doc_id: r for r in licence_rules.scan(documents(spark, [t for _, t in cases]), "doc_id", "text").collect()}
    assert [got[i].licences for i in range(len(cases))] == [name for name, _ in cases]
    assert [got[i].sentence_ids for i in (0, 3, 6)] == ["<3><4>", "<10><11>", "<6><7><8>"]


@pytest.mark.parametrize("query", ["op8_url_filter", "op9_licences"])
def test_native(spark, query):
    df = queries.queries()[query](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_hot_url_can_be_split(spark):
    """The pages' last join meets a table that is read, not an aggregation whose partitions it would have to keep."""
    pages = spark.range(50).select(F.col("id").alias("page_id"), F.when(F.col("id") % 2 == 0, "http://a.net/x").alias("url"))
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    listed = spark.createDataFrame([], "host string, path string")
    got = url_filter.judge(spark, pages, rules, listed, "page_id", "url")
    assert "Aggregate" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.where("verdict = 'block'").count() == 25
