import pytest

from helpers import plan
from vitrine import schemas
from vitrine.plans.layers import recommend

A_VISTA, PARCELADO, NONE = (
    "Comprar a Vista Pix",
    "Comprar Parcelado",
    "Sem Vantagem Identificada",
)


def silver(spark, *amounts):
    """Silver rows from (price, discount, instalments, instalment value)."""
    data = [
        (str(i), "n", p, d, n, v, "o", "l", "-", "Nao", None)
        for i, (p, d, n, v) in enumerate(amounts)
    ]
    return spark.createDataFrame(data, schemas.SILVER)


@pytest.mark.parametrize(
    "amounts, expected",
    [
        ((1359.87, 0.0, 10, 149.9), A_VISTA),
        ((100.0, 0.0, 0, 0.0), PARCELADO),
        ((0.0, 0.0, 1, 10.0), NONE),
        ((100.0, 0.0, 10, 10.0), NONE),
        ((100.0, 0.15, 10, 9.0), PARCELADO),
        ((100.0, 0.15, None, 9.0), NONE),
        ((100.0, 0.15, 10, None), NONE),
        ((100.0, 0.15, 10, 10.0), A_VISTA),
    ],
)
def test_advice(spark, amounts, expected):
    assert recommend(silver(spark, amounts)).first().recomendacao == expected


def test_breakdown(spark):
    row = recommend(silver(spark, (1359.87, 0.1, 10, 149.9)), 10.0, with_breakdown=True).first()
    assert row.preco_desconto == 1223.88
    assert row.preco_parcelado == 1499.0
    assert row.save_desconto == 135.99
    assert row.save_parcelado == 0.0
    assert row.pct_preco_parcelado == -10.23
    gain = recommend(silver(spark, (100.0, 0.0, 9, 10.0)), 10.0, with_breakdown=True).first()
    assert gain.save_parcelado == 11.0


def test_rounding_is_half_up(spark):
    row = recommend(silver(spark, (1.005, 0.0, 0, 0.0)), with_breakdown=True).first()
    assert row.preco_desconto == 1.01


def test_unknown_rate(spark):
    row = recommend(silver(spark, (100.0, 0.0, 9, 10.0)), with_breakdown=True).first()
    assert row.save_parcelado is None
    assert row.recomendacao == PARCELADO


def test_units(spark):
    rows = silver(spark, (100.0, 0.15, 10, 9.0))
    assert recommend(rows).first().recomendacao == PARCELADO
    assert recommend(rows, normalized_units=True).first().recomendacao == A_VISTA


def test_output_and_plan(spark):
    df = recommend(silver(spark, (100.0, 0.0, 9, 10.0)), 10.0)
    assert df.columns == schemas.GOLD.names
    assert "save_" not in plan(df)
