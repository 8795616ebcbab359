"""Text of a listing to typed columns.

Bad input becomes NULL (or the documented default), never an error, so every
conversion is a ``try_`` form and ANSI mode can stay on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine import fixed_values as fixed

_MAY_BE_NUMBER = "[0-9]|(?i:nan|inf)"


def _zero_if_missing(number: Column) -> Column:
    """NULL and NaN both become 0.0."""
    return F.coalesce(F.nanvl(number, F.lit(None).cast("double")), F.lit(0.0))


def _number(text: Column) -> Column:
    """Plain number to double, NULL if it is none.

    Text without any digit (and not NaN or infinity) is sorted out by a look at its
    characters: a failing cast throws and catches an exception for each row.
    """
    return F.when(text.rlike(_MAY_BE_NUMBER), text.try_cast("double"))


def _decimal_comma(text: Column) -> Column:
    return F.nullif(F.replace(text, F.lit(","), F.lit(".")), F.lit("")).try_cast("double")


def scrape_time(text: Column) -> Column:
    """``2025-10-05 19:00`` to a timestamp; any other shape is NULL."""
    return F.try_to_timestamp(text, F.lit(fixed.SCRAPE_FORMAT))


def instalment_count(text: Column) -> Column:
    """Digits in front of a lower-case ``x``. No text is 0, text without them NULL."""
    digits = F.regexp_extract(text, fixed.INSTALMENT_COUNT, 1).try_cast("bigint")
    return F.when(text.isNull(), F.lit(0).cast("bigint")).otherwise(digits)


def instalment_value(text: Column) -> Column:
    """``R$ 149,90`` inside the text. No text is 0.0, text without it NULL."""
    value = _decimal_comma(F.regexp_extract(text, fixed.INSTALMENT_VALUE, 1))
    return F.when(text.isNull(), F.lit(0.0)).otherwise(value)


def discount_fraction(text: Column) -> Column:
    """``15%`` is 0.15 and ``0.15`` is 0.15; everything else counts as no discount."""
    percent = F.replace(text, F.lit("%"), F.lit("")).try_cast("double") / F.lit(100.0)
    return _zero_if_missing(
        F.when(text.rlike(fixed.PERCENT_TEXT), percent).otherwise(_number(text))
    )


def price_brl(text: Column) -> Column:
    """Brazilian money (``R$ 1.359,87``) or a plain number; anything else is 0.0."""
    amount = F.replace(text, F.lit(fixed.CURRENCY_MARK), F.lit(""))
    amount = _decimal_comma(F.replace(amount, F.lit("."), F.lit("")))
    return _zero_if_missing(
        F.when(text.rlike(fixed.PRICE_TEXT), amount).otherwise(_number(text))
    )


def memory_label(name: Column) -> Column:
    """First ``<digits> GB`` of a name in upper case, blanks kept; ``-`` if none."""
    size = F.upper(F.regexp_extract(name, fixed.MEMORY_SIZE, 0))
    return F.coalesce(F.nullif(size, F.lit("")), F.lit(fixed.NO_MEMORY))


def oled_flag(name: Column) -> Column:
    return F.when(name.rlike(fixed.OLED_NAME), fixed.OLED_YES).otherwise(fixed.OLED_NO)


def mask_code(code: Column) -> Column:
    """First two and last two characters, stars in between.

    Codes shorter than four characters are not hidden: the two ends overlap.
    """
    stars = F.repeat(F.lit("*"), F.length(code) - 4)
    return F.concat(F.substring(code, 1, 2), stars, F.substring(code, -2, 2))


def link_host(link: Column) -> Column:
    """Everything up to the first ``.com``; empty if there is none."""
    return F.regexp_extract(link, fixed.LINK_HOST, 1)
