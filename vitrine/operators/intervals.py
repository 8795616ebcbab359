"""Equi-join with a bounded distance in seconds.

The distance is turned into a time bucket that joins the equality keys, so one hot
key spreads over as many join groups as there are buckets, and no task compares all
pairs of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BUCKET = "__bucket"
_SALT = "__salt"


def _bucket_of(second: Column, width: int) -> Column:
    # Floor division, also for instants before 1970.
    return F.floor(second / F.lit(width)).cast("bigint")


def with_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    lower_s: int = -5,
    upper_s: int = 5,
    right_event_time: str | None = None,
    salts: int = 1,
) -> DataFrame:
    """Inner join on ``keys`` where right minus left, in whole seconds, lies in the bounds.

    Columns come out as ``left_*`` and ``right_*``. The right side should be the
    narrow one: each of its rows is copied to two buckets (times ``salts``).
    ``right_event_time`` names the watermarked column of a streaming right side; it
    bounds the join state and is not part of the output.
    ``salts`` splits a hot bucket of a stream, where adaptive execution cannot.
    """
    width = upper_s - lower_s + 1
    left_second = F.unix_seconds(F.col(f"left_{left_ts}"))
    right_second = F.unix_seconds(F.col(f"right_{right_ts}"))

    lhs = with_prefix(left, "left_").withColumn(f"left_{_BUCKET}", _bucket_of(left_second, width))
    rhs = with_prefix(right, "right_").withColumn(
        f"right_{_BUCKET}",
        F.explode(
            F.sequence(
                _bucket_of(right_second - upper_s, width),
                _bucket_of(right_second - lower_s, width),
            )
        ),
    )
    on = [F.col(f"left_{k}") == F.col(f"right_{k}") for k in [*keys, _BUCKET]]
    if salts > 1:
        spread = F.pmod(F.xxhash64(*[F.col(f"left_{c}") for c in left.columns]), F.lit(salts))
        lhs = lhs.withColumn(f"left_{_SALT}", spread.cast("int"))
        rhs = rhs.withColumn(
            f"right_{_SALT}", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
        )
        on.append(F.col(f"left_{_SALT}") == F.col(f"right_{_SALT}"))
    on.append((right_second - left_second).between(lower_s, upper_s))
    if right_event_time is not None:
        at, event = F.col(f"left_{left_ts}"), F.col(f"right_{right_event_time}")
        on.append(at >= event - F.expr(f"INTERVAL {upper_s + 1} SECONDS"))
        on.append(at <= event + F.expr(f"INTERVAL {1 - lower_s} SECONDS"))

    helpers = [f"{side}_{name}" for side in ("left", "right") for name in (_BUCKET, _SALT)]
    if right_event_time is not None:
        helpers.append(f"right_{right_event_time}")
    return lhs.join(rhs, on, "inner").drop(*helpers)
