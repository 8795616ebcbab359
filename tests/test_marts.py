import datetime as dt
import random

from helpers import bag, plan, rows
from pyspark.sql import functions as F
from vitrine import schemas
from vitrine.plans import marts

DAY = dt.datetime(2025, 1, 1)


def gold(spark, n=400, seed=3):
    """Gold rows with ties on the scrape time, one code holding a third of them."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        code = "hot1" if i % 3 == 0 else f"c{rng.randint(0, 30):03d}"
        data.append(
            (
                code, rng.choice(["n1", "n2", None]), float(rng.randint(0, 50)), 0.0, 1, 1.0,
                rng.choice(["s1", "s2", None]), rng.choice(["https://a.com.br/1", "/x", None]),
                "-", rng.choice(["Sim", "Nao"]),
                rng.choice([None, DAY + dt.timedelta(days=rng.randint(0, 3))]),
                rng.choice(["Comprar Parcelado", "Comprar a Vista Pix"]),
            )
        )
    return spark.createDataFrame(data, schemas.GOLD)


def key(value):
    """Order with NULL as the smallest value."""
    return (value is not None, value) if value is not None else (False, "")


def current(data):
    out = {}
    for r in data:
        order = (
            r.extract is not None, r.extract or DAY,
            *[key(r[c]) for c in ("nome", "origem", "memoria", "oled", "recomendacao", "link")],
        )
        if r.codigo not in out or order > out[r.codigo][0]:
            out[r.codigo] = (order, r)
    return {code: row for code, (_, row) in out.items()}


def test_details_and_products_agree_on_the_row(spark):
    df = gold(spark)
    expected = current(df.collect())
    details = {r.codigo: tuple(r) for r in marts.details(df).collect()}
    products = {r.codigo: tuple(r) for r in marts.products(df.repartition(5)).collect()}
    assert details == {c: tuple(r[n] for n in schemas.DETAILS) for c, r in expected.items()}
    assert products == {c: tuple(r[n] for n in schemas.PRODUCTS) for c, r in expected.items()}


def test_prices(spark):
    df = gold(spark)
    assert marts.prices(df).columns == schemas.PRICES
    assert marts.prices(df).count() == df.count()


def brute_force(data):
    now = current(data)
    best = {}
    for r in data:
        c = now[r.codigo]
        if c.oled != "Sim" or c.origem is None:
            continue
        order = (r.preco, r.codigo, *[key(c[n]) for n in ("nome", "oled", "link", "recomendacao")])
        if c.origem not in best or order < best[c.origem]:
            best[c.origem] = order
    return {shop: order[0] for shop, order in best.items()}


def test_suggestion(spark):
    for seed in (3, 4, 5):
        df = gold(spark, seed=seed)
        parts = marts.products(df), marts.prices(df), marts.details(df)
        stored = marts.suggestion(*parts)
        assert stored.columns == schemas.SUGGESTION
        assert {r.origem: r.menor_preco for r in stored.collect()} == brute_force(df.collect())
        assert bag(stored) == bag(marts.suggestion_from_gold(df))


def test_unknown_price_comes_first(spark):
    products = spark.createDataFrame([("aaaaa", "n", "s"), ("bbbbb", "n", "s")], "codigo string, nome string, origem string")
    details = spark.createDataFrame(
        [(c, "-", "Sim", "r", "l") for c in ("aaaaa", "bbbbb")],
        "codigo string, memoria string, oled string, recomendacao string, link string",
    )
    prices = spark.createDataFrame([("aaaaa", 1.0), ("bbbbb", None), ("bbbbb", 2.0)], "codigo string, preco double")
    assert rows(marts.suggestion(products, prices, details))[0][:2] == ("bb*bb", None)


def test_plans(spark):
    df = gold(spark)
    text = plan(marts.details(df))
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange") == 1
    one_pass = plan(marts.suggestion_from_gold(df))
    assert "Join" not in one_pass
    assert one_pass.count("Exchange hashpartitioning") == 2
    assert "numero_parcelas" not in plan(marts.details(df)).split("Project")[1]


def test_hot_code_is_dealt_over_tasks(spark):
    """Half of all prices on one code: no task of the join gets more than about twice the mean."""
    prices = spark.range(200_000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 'hot' ELSE concat('c', cast(id % 997 as string)) END AS codigo",
        "cast(id % 1013 as double) AS preco",
    )
    current = spark.range(997).selectExpr(
        "CASE WHEN id = 0 THEN 'hot' ELSE concat('c', cast(id as string)) END AS codigo", "'n' AS nome"
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = marts.priced(current, prices, salts=64)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == prices.join(current, "codigo").count()
        assert max(sizes) <= 2.2 * sum(sizes) / 8
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_offers_find_the_current_row_once(spark):
    df = gold(spark)
    for oled in ("Sim", "Nao"):
        parts = marts.products(df), marts.prices(df), marts.details(df), oled
        assert bag(marts.offers_from_gold(df, oled)) == bag(marts.offers(*parts))
    assert marts.offers_from_gold(df).count() == df.count()
    assert plan(marts.offers_from_gold(df, "Sim")).count("WindowGroupLimit") == 2
