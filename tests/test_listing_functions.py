import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from helpers import listings, rows
from vitrine.functions import listing as lst
from vitrine.plans.layers import clean

NBSP = " "

CASES = [
    (
        lst.scrape_time,
        {
            "2025-10-05 19:00": dt.datetime(2025, 10, 5, 19, 0),
            "2025-10-05 19:00:00": None,
            "2025/10/05 19:00": None,
            "x": None,
            None: None,
        },
    ),
    (
        lst.instalment_count,
        {None: 0, "10x de R$ 149,90": 10, "ate 10X": None, "em breve": None, "": None,
         "3 x de": None, "99999999999999999999x": None},
    ),
    (
        lst.instalment_value,
        {None: 0.0, "10x de R$ 149,90": 149.9, "1x de R$ 1.149,90": None, "em breve": None,
         f"2x de R${NBSP}10,00": None, "R$ 1,00 ou R$ 2,00": 1.0},
    ),
    (
        lst.discount_fraction,
        {None: 0.0, "15%": 0.15, "0.15": 0.15, "15,5%": 0.0, "10% OFF": 0.0, "NaN": 0.0,
         " 0.2 ": 0.2, "": 0.0, "1e-1": 0.1},
    ),
    (
        lst.price_brl,
        {"R$ 1.359,87": 1359.87, "1359.87": 1359.87, "R$ 1359,87": 0.0, "1.359,87": 0.0,
         "R 1,00": 0.0, f"R${NBSP}1,00": 0.0, None: 0.0, "R$1": 1.0, "R$ 12.345.678": 12345678.0,
         "NaN": 0.0, "Infinity": float("inf"), "indisponivel": 0.0},
    ),
    (
        lst.memory_label,
        {"Switch 32 gb": "32 GB", "64GB": "64GB", "Lite": "-", None: "-", "": "-",
         "a 8Gb b 16GB": "8GB", "1٢ gb": "1٢ GB"},
    ),
    (lst.oled_flag, {"Switch OLED": "Sim", "oLeD": "Sim", "Lite": "Nao", None: "Nao"}),
    (
        lst.mask_code,
        {"236139900": "23*****00", "abcd": "abcd", "abc": "abbc", "a": "aa", "": "", None: None},
    ),
    (
        lst.link_host,
        {"https://www.loja.com.br/p/1": "https://www.loja.com", "/p/1": "", None: None,
         "https://a.com/b.com": "https://a.com"},
    ),
]


@pytest.mark.parametrize("function, cases", CASES, ids=lambda c: getattr(c, "__name__", ""))
def test_cases(spark, function, cases):
    df = spark.createDataFrame([(text,) for text in cases], "t string")
    assert dict(rows(df.select("t", function(F.col("t"))))) == cases


def _price(text):
    """Plain Python reading of a price."""
    if text is None:
        return 0.0
    if re.search(r"^R\$?[ \t\n\x0b\f\r]?[0-9]{1,3}(\.[0-9]{3})*(,[0-9]{2})?$", text):
        text = text.replace("R$", "").replace(".", "").replace(",", ".")
    try:
        return float(text)
    except ValueError:
        return 0.0


def _count(text):
    if text is None:
        return 0
    match = re.search(r"([0-9]+)x", text)
    return int(match[1]) if match else None


def test_random_texts(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choices("R$ .,0123456789x%", k=rng.randint(0, 9))) for _ in range(4000)]
    texts += [f"R$ {n:,}".replace(",", ".") + ",50" for n in range(0, 2_000_000, 9973)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for text, price, count in rows(
        df.select("t", lst.price_brl(F.col("t")), lst.instalment_count(F.col("t")))
    ):
        assert price == _price(text), text
        assert count == _count(text), text


def test_sample_listing(spark):
    raw = listings(
        spark,
        dict(
            codigo="236139900", nome="Console Lite 32GB Coral", preco="R$ 1.359,87",
            parcelamento="10x de R$ 149,90 sem juros", origem="loja", link="https://x.com.br/p",
            extract="2025-10-05 19:00",
        ),
        dict(nome="no code", preco="R$ 1,00"),
        dict(codigo=""),
    )
    got = {r["codigo"]: r for r in clean(raw).collect()}
    assert set(got) == {"236139900", ""}
    row = got["236139900"]
    assert (row.preco, row.desconto, row.numero_parcelas, row.valor_prestacao) == (
        1359.87, 0.0, 10, 149.9,
    )
    assert (row.memoria, row.oled) == ("32GB", "Nao")
    assert row.extract == dt.datetime(2025, 10, 5, 19, 0)
