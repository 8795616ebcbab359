"""Cleaned listings and payment advice. Narrow plans: one stage, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions import advice as adv
from vitrine.functions import listing as lst


def clean(raw: DataFrame) -> DataFrame:
    """Typed listings; rows without a code are left out."""
    col = F.col
    return raw.where(col("codigo").isNotNull()).select(
        "codigo",
        "nome",
        lst.price_brl(col("preco")).alias("preco"),
        lst.discount_fraction(col("desconto")).alias("desconto"),
        lst.instalment_count(col("parcelamento")).alias("numero_parcelas"),
        lst.instalment_value(col("parcelamento")).alias("valor_prestacao"),
        "origem",
        "link",
        lst.memory_label(col("nome")).alias("memoria"),
        lst.oled_flag(col("nome")).alias("oled"),
        lst.scrape_time(col("extract")).alias("extract"),
    )


def breakdown(silver: DataFrame, cdi_pct: float | None = None) -> DataFrame:
    """Silver with the five amounts behind the advice."""
    col = F.col
    totals = silver.select(
        "*",
        adv.cash_price(col("preco"), col("desconto")).alias("preco_desconto"),
        adv.instalment_total(col("valor_prestacao"), col("numero_parcelas")).alias(
            "preco_parcelado"
        ),
    )
    return totals.select(
        "*",
        adv.cash_saving(col("preco"), col("preco_desconto")).alias("save_desconto"),
        adv.instalment_saving(
            col("preco"), col("preco_parcelado"), adv.interest_factor(cdi_pct)
        ).alias("save_parcelado"),
        adv.instalment_discount_pct(col("preco"), col("preco_parcelado")).alias(
            "pct_preco_parcelado"
        ),
    )


def recommend(
    silver: DataFrame,
    cdi_pct: float | None = None,
    with_breakdown: bool = False,
    normalized_units: bool = False,
) -> DataFrame:
    """Silver with ``recomendacao``.

    The discount is a fraction and the instalment discount a percentage; they are
    compared as they are unless ``normalized_units``. Without an instalment text the
    instalment discount is 100, so the advice is to pay by instalments. The rate only
    changes the breakdown, never the advice.
    """
    discount = F.col("desconto") * 100 if normalized_units else F.col("desconto")
    amounts = breakdown(silver, cdi_pct)
    kept = amounts.columns if with_breakdown else silver.columns
    return amounts.select(
        *kept, adv.advice(discount, F.col("pct_preco_parcelado")).alias("recomendacao")
    )
