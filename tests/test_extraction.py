import json

import pytest
from pyspark.sql import functions as F

from helpers import rows
from vitrine.operators.html import html_blocks
from vitrine.operators.replies import (
    product_events,
    products_from_reply,
    repair_braces,
    reply_json_span,
    reply_products,
)

GOOD = '{"produtos":[{"nome":"A","preco":"R$ 1,00","codigo":"1","desconto":null}]}'
REPLIES = {
    GOOD: 1,
    f"Segue:\n```json\n{GOOD}\n```\nfim": 1,
    json.dumps(json.loads(GOOD), indent=2): 1,
    '{"produtos":[{"codigo":"1"},{"codigo":2.50}]}': 2,
    '{"produtos":[]}': 0,
    '{"produtos":"x"}': 0,
    '{"produtos":{"codigo":"1"}}': 0,
    '{"itens":[{"codigo":"1"}]}': 0,
    "nothing here": 0,
    "": 0,
    "} before {": 0,
    '{"produtos":[{"codigo":"1"}': 0,
    GOOD + ' {"x": 1}': 0,
    GOOD + "," + GOOD: 0,
    "{'produtos':[{'codigo':'1'}]}": 0,
    '{"produtos":[{"codigo":"1"}],"a":{"b":{"c":1}}}': 0,
    '{"produtos":[{"codigo":"a}}b{{c"}]}': 1,
}


def test_replies(spark):
    df = spark.createDataFrame([(r,) for r in [*REPLIES, None]], "reply string")
    counted = df.select("reply", F.size(reply_products(F.col("reply"))))
    got = {reply: max(n or 0, 0) for reply, n in rows(counted)}
    assert got == REPLIES | {None: 0}


def test_span_and_repair(spark):
    cases = {
        "a{b}c": "{b}", "a{b\n}c}d": "{b\n}c}", "}{": "", "{": "", "}": "", "": "",
        "{}": "{}", "x{{y}}z": "{{y}}", "ã{é}ç": "{é}", None: None,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    spans = df.select("t", reply_json_span(F.col("t")).alias("s"))
    assert dict(rows(spans)) == cases
    repaired = dict(rows(spans.select("s", repair_braces(F.col("s"))).where("s IS NOT NULL")))
    assert repaired["{b}"] == "{b}"
    assert repaired["{{y}}"] == "{{y}}"


def test_products(spark):
    reply = (
        'x {"produtos":[{"nome":"A ção","preco":1359.87,"codigo":"7","desconto":null,'
        '"parcelamento":"10x","link":"/p"},{"codigo":"8"}]} y'
    )
    df = spark.createDataFrame([(reply,)], "reply string")
    asof = F.lit("2025-10-05 19:00:59").cast("timestamp")
    got = {r.codigo: r for r in products_from_reply(df, "reply", "loja", asof).collect()}
    assert got["7"].preco == "1359.87" and got["7"].nome == "A ção" and got["7"].desconto is None
    assert got["8"].nome is None and got["8"].link is None
    assert {(r.origem, r.extract) for r in got.values()} == {("loja", "2025-10-05 19:00")}


def test_product_events(spark):
    names = ["codigo", "nome", "preco", "desconto", "parcelamento", "link", "origem", "extract"]
    df = spark.createDataFrame([("1", "ção", None, None, "x", "/p", "o", "e")], names_ddl(names))
    row = product_events(df).first()
    assert row.key == "1"
    assert "ção" in row.value
    assert json.loads(row.value) == dict(
        zip(names, ["1", "ção", None, None, "x", "/p", "o", "e"], strict=True)
    )


def names_ddl(names):
    return ", ".join(f"{n} string" for n in names)


PAGES = [
    ('<div class="a">x</div>', "a", ['<div class="a">x</div>']),
    ('<div class="a b">x</div>', "a b", ['<div class="a b">x</div>']),
    ('<div class="b a">x</div>', "a b", []),
    ('<div class="a  b">x</div>', "a b", ['<div class="a  b">x</div>']),
    ("<div class='a'><div>y</div>x</div>z", "a", ["<div class='a'><div>y</div>x</div>"]),
    (
        '<div class="a">1<div class="a">2</div></div>',
        "a",
        ['<div class="a">1<div class="a">2</div></div>', '<div class="a">2</div>'],
    ),
    ('<p><div class="a">x</p>y', "a", ['<div class="a">x']),
    ('<div class="a">x', "a", ['<div class="a">x']),
    ('x</div><DIV CLASS="a">\n<br>é</DIV >y', "a", ['<DIV CLASS="a">\n<br>é</DIV >']),
    ('<script>"<div class=\'a\'>"</script><!-- <div class="a"> -->', "a", []),
    ('<div class="a"/>x', "a", ['<div class="a"/>']),
    ("<span class=a>x</span>", "a", []),
    ("<div>x</div><div>y</div>", None, ["<div>x</div>", "<div>y</div>"]),
    (None, "a", []),
]


@pytest.mark.parametrize("page, css, expected", PAGES)
def test_html_blocks(spark, page, css, expected):
    df = spark.createDataFrame([(1, page)], "id int, html string")
    got = html_blocks(df, "div", css).orderBy("block_index").collect()
    assert [r.block for r in got] == expected
    assert [r.block_index for r in got] == list(range(len(expected)))
    assert all(r.id == 1 for r in got)


def test_broken_pages_take_linear_time(spark):
    deep = "<p>" * 50_000 + "</b>" * 50_000 + '<div class="ad">x</div>'
    df = spark.createDataFrame([(1, deep), (2, None), (3, "")], "page_id long, html string")
    assert [tuple(r) for r in html_blocks(df, "div", "ad").collect()] == [(1, 0, '<div class="ad">x</div>')]


def test_nested_blocks_come_in_several_batches(spark, monkeypatch):
    from vitrine.operators import html

    monkeypatch.setattr(html, "_CHARS_PER_BATCH", 1000)
    depth = 400
    page = "<div>" * depth + "x" + "</div>" * depth
    df = spark.createDataFrame([(1, page), (2, page)], "page_id long, html string")
    got = html_blocks(df, "div").collect()
    assert sorted((r.page_id, r.block_index, len(r.block)) for r in got) == [
        (n, i, len(page) - 11 * i) for n in (1, 2) for i in range(depth)
    ]
