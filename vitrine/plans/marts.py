"""Product, detail and price tables, and the cheapest offer per marketplace."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine import fixed_values as fixed
from vitrine import schemas
from vitrine.functions.listing import link_host, mask_code
from vitrine.operators.groups import latest_by, top1_by

PRICE_SALTS = 16
_SALT = "__salt"
OFFER = ["codigo", "nome", "origem", "preco", "oled", "link", "recomendacao"]
_MART_COLUMNS = list(dict.fromkeys([*schemas.PRODUCTS, *schemas.DETAILS]))


def current_listing(gold: DataFrame) -> DataFrame:
    """Latest row per code with the columns of both marts.

    Ties on the scrape time are settled by these columns only: every other column is
    pruned from the scan, and both marts always describe the same row.
    """
    rows = gold.select(*_MART_COLUMNS, "extract")
    return latest_by(rows, ["codigo"], "extract").drop("extract")


def details(gold: DataFrame) -> DataFrame:
    return current_listing(gold).select(*schemas.DETAILS)


def products(gold: DataFrame) -> DataFrame:
    return current_listing(gold).select(*schemas.PRODUCTS)


def prices(gold: DataFrame) -> DataFrame:
    """Full price history."""
    return gold.select(*schemas.PRICES[:-1], F.col("extract").alias("data"))


def priced(current: DataFrame, prices: DataFrame, salts: int = PRICE_SALTS) -> DataFrame:
    """Every stored price with the current row of its code.

    A code may hold any share of the history. Its prices are dealt by code and a salt, and
    its one current row goes to each salt, so they never meet in one task.
    """
    salted = prices.select(
        "codigo", "preco", F.pmod(F.xxhash64(*prices.columns), F.lit(salts)).cast("int").alias(_SALT)
    )
    copies = current.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, ["codigo", _SALT]).drop(_SALT)


def offers(
    products: DataFrame,
    prices: DataFrame,
    details: DataFrame,
    oled: str,
    salts: int = PRICE_SALTS,
) -> DataFrame:
    """One row per code and stored price, for products with the asked screen."""
    known = products.where(F.col("origem").isNotNull())
    screen = details.where(F.col("oled") == oled).drop("memoria")
    return priced(known.join(screen, "codigo"), prices, salts).select(*OFFER)


def offers_from_gold(gold: DataFrame, oled: str | None = None, salts: int = PRICE_SALTS) -> DataFrame:
    """Offers with the current row of a code found once; without ``oled``, those of all rows."""
    current = current_listing(gold).drop("memoria")
    if oled is not None:
        current = current.where((F.col("oled") == oled) & F.col("origem").isNotNull())
    return priced(current, prices(gold), salts).select(*OFFER)


def lowest_price(prices: DataFrame) -> DataFrame:
    """Lowest price per code; an unknown price sorts before all others."""
    price = F.col("preco")
    return (
        prices.groupBy("codigo")
        .agg(F.min(price).alias("preco"), F.bool_or(price.isNull()).alias("__unknown"))
        .select("codigo", F.when(~F.col("__unknown"), price).alias("preco"))
    )


def masked(offers: DataFrame) -> DataFrame:
    """Offers as published: code and link without what identifies the product."""
    return offers.select(
        mask_code(F.col("codigo")).alias("codigo"),
        F.col("preco").alias("menor_preco"),
        "recomendacao",
        "origem",
        link_host(F.col("link")).alias("link"),
    )


def suggestion(
    products: DataFrame, prices: DataFrame, details: DataFrame, oled: str = fixed.OLED_YES
) -> DataFrame:
    """Cheapest offer per marketplace.

    Only the lowest price of a code can win, so the price history is reduced to one
    row per code before the join: a code with a third of all prices costs one row per
    map task, and the joins are one to one.
    """
    best = offers(products, lowest_price(prices), details, oled, salts=1)
    return masked(top1_by(best, ["origem"], "preco"))


def suggestion_from_gold(gold: DataFrame, oled: str = fixed.OLED_YES) -> DataFrame:
    """``suggestion`` straight from gold, without the stored marts in between.

    One scan and one shuffle: the current row of a code (as in ``current_listing``) and
    its lowest price come from the same aggregation, which starts in the map tasks.
    """
    described = [c for c in _MART_COLUMNS if c != "codigo"]
    price = F.col("preco")
    per_code = (
        gold.where(F.col("codigo").isNotNull())
        .groupBy("codigo")
        .agg(
            F.max(F.struct("extract", *described)).alias("__last"),
            F.min(price).alias("preco"),
            F.bool_or(price.isNull()).alias("__unknown"),
        )
    )
    best = per_code.select(
        "codigo", "__last.*", F.when(~F.col("__unknown"), price).alias("preco")
    ).where((F.col("oled") == oled) & F.col("origem").isNotNull())
    return masked(top1_by(best.select(*OFFER), ["origem"], "preco"))
