"""One row per group, without ever gathering a group in one task.

``row_number() = 1`` lets Spark keep one row per key in every map task before the
shuffle (``WindowGroupLimit``), so a key holding a third of all rows sends at most
one row per map task to its reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_RANK = "__rank"


def first_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    ordered: Sequence[str] = (),
    ties_descending: bool = False,
) -> DataFrame:
    """First row per ``keys`` in the given order.

    The other columns follow as tie-breakers, so the row does not depend on chance;
    ``ordered`` names those that ``order`` has settled already.
    """
    others = [F.col(c) for c in df.columns if c not in keys and c not in ordered]
    ties = [c.desc_nulls_last() if ties_descending else c.asc_nulls_first() for c in others]
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn(_RANK, F.row_number().over(window)).where(f"{_RANK} = 1").drop(_RANK)


def latest_by(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Row with the greatest ``order`` per key, ties to the greatest other columns.

    NULL is the smallest value, so this is also the maximum of
    ``struct(order, other columns)`` per key.
    """
    return first_by(df, keys, [F.col(order).desc_nulls_last()], [order], ties_descending=True)


def top1_by(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Row with the smallest ``order`` per key; a NULL ``order`` comes first."""
    return first_by(df, keys, [F.col(order).asc_nulls_first()], [order])
