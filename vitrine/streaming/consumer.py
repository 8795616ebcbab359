"""Consumer that lets through adverts seen once in their window.

Events are counted per ``(codigo, parcelamento, preco)`` in tumbling windows, joined
back on ``codigo`` to the windows that end near them, and kept for windows with a
count of one. The join does not look at price or instalments and reaches over
neighbouring windows, so an event may match several windows and then comes out
several times; a group seen twice in a window loses its rows unless another window
lets them through.

All functions take batch or streaming input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine import fixed_values as fixed
from vitrine import schemas
from vitrine.operators.intervals import interval_join

EVENT_TIME = "EventEnqueuedUtcTime"
GROUP = ["codigo", "parcelamento", "preco"]
COUNT = "COUNT_codigo"
WINDOW_END = "Window_End_Time"
# Join groups of one code and bucket of time.
SALTS = 4
_WINDOW = "__window"
_EMITTED = "__emitted"
_COPIES = "__copies"


def passthrough(events: DataFrame) -> DataFrame:
    """The event columns as they are."""
    return events.select(*schemas.EVENT.names)


def _windowed_counts(df: DataFrame, keys: Sequence[str], counted: str, ts: str, window: str):
    return df.groupBy(*keys, F.window(ts, window).alias(_WINDOW)).agg(
        F.count(counted).alias(f"COUNT_{counted}")
    )


def tumbling_count(
    df: DataFrame,
    keys: Sequence[str] = tuple(GROUP),
    counted: str = "codigo",
    ts: str = EVENT_TIME,
    window: str = f"{fixed.WINDOW_SECONDS} seconds",
) -> DataFrame:
    """Non-NULL ``counted`` per ``keys`` and window ``[start, end)``, with the window's end."""
    counts = _windowed_counts(df, keys, counted, ts, window)
    return counts.select(
        *keys, f"COUNT_{counted}", F.col(f"{_WINDOW}.end").alias(WINDOW_END)
    )


def matched_windows(
    events: DataFrame,
    window_s: int = fixed.WINDOW_SECONDS,
    tolerance_s: int = fixed.TOLERANCE_SECONDS,
    salts: int = SALTS,
) -> DataFrame:
    """Every event with every window of its code that ends within the tolerance.

    ``salts`` spreads a hot code over as many join groups in each bucket of time.
    """
    counts = _windowed_counts(events, GROUP, "codigo", EVENT_TIME, f"{window_s} seconds")
    right = counts.select(
        *GROUP,
        COUNT,
        F.col(f"{_WINDOW}.end").alias(WINDOW_END),
        F.window_time(_WINDOW).alias(_EMITTED),
    )
    streaming = events.isStreaming
    return interval_join(
        passthrough(events),
        right if streaming else right.drop(_EMITTED),
        ["codigo"],
        EVENT_TIME,
        WINDOW_END,
        -tolerance_s,
        tolerance_s,
        right_event_time=_EMITTED if streaming else None,
        salts=salts,
    )


def singletons(matches: DataFrame) -> DataFrame:
    """Matches whose window counted one."""
    return matches.where(F.col(f"right_{COUNT}") == 1)


def listing_columns(matches: DataFrame) -> DataFrame:
    """Left side of the matches as raw listings."""
    return matches.select(*[F.col(f"left_{c}").alias(c) for c in schemas.LISTING.names])


def singleton_consumer(
    events: DataFrame,
    window_s: int = fixed.WINDOW_SECONDS,
    tolerance_s: int = fixed.TOLERANCE_SECONDS,
    salts: int = SALTS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``listing_columns(singletons(matched_windows(events)))``, cheaper.

    Only the number of matching windows matters for the output, so the windows with a
    count of one are first counted per code and end. The join then meets one small row
    per code and window in place of one per price and instalment text, and each event
    is repeated as often as it matched.

    ``keep`` adds event columns to the output; ``salts`` spreads a hot code.
    """
    window = f"{window_s} seconds"
    counts = _windowed_counts(events, GROUP, "codigo", EVENT_TIME, window)
    single = counts.where(F.col(COUNT) == 1)
    per_end = single.groupBy("codigo", _WINDOW).agg(F.count(F.lit(1)).alias(_COPIES))
    right = per_end.select(
        "codigo",
        _COPIES,
        F.col(f"{_WINDOW}.end").alias(WINDOW_END),
        F.window_time(_WINDOW).alias(_EMITTED),
    )
    streaming = events.isStreaming
    wanted = [*schemas.LISTING.names, *keep]
    left = events.select(*dict.fromkeys([*wanted, EVENT_TIME]))
    matches = interval_join(
        left,
        right if streaming else right.drop(_EMITTED),
        ["codigo"],
        EVENT_TIME,
        WINDOW_END,
        -tolerance_s,
        tolerance_s,
        right_event_time=_EMITTED if streaming else None,
        salts=salts,
    )
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(f"right_{_COPIES}")))
    return matches.select(*[F.col(f"left_{c}").alias(c) for c in wanted], copies.alias("__copy")).drop(
        "__copy"
    )
