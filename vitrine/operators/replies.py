"""Products out of an extractor's free-text reply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine import fixed_values as fixed
from vitrine import schemas

# One strict reading of JSON: double quotes only, as the format demands.
_STRICT = {"allowSingleQuotes": "false", "mode": "PERMISSIVE"}


def reply_json_span(text: Column) -> Column:
    """First ``{`` to last ``}``, across lines; empty if there is no such pair.

    Two position look-ups, so the cost stays linear in the text.
    """
    first = F.instr(text, "{")
    last = F.length(text) - F.instr(F.reverse(text), "}") + 1
    found = (first > 0) & F.contains(text, F.lit("}")) & (last > first)
    span = F.substring(text, first, last - first + 1)
    return F.when(text.isNotNull(), F.when(found, span).otherwise(F.lit("")))


def repair_braces(span: Column) -> Column:
    """Wrap in braces, then halve every doubled brace (also inside strings)."""
    wrapped = F.concat(F.lit("{"), span, F.lit("}"))
    opened = F.replace(wrapped, F.lit("{{"), F.lit("{"))
    return F.replace(opened, F.lit("}}"), F.lit("}"))


def reply_products(text: Column) -> Column:
    """Array of product structs, or NULL for no JSON, bad JSON or no ``produtos`` list.

    The text is read as the only element of a JSON array: anything after the first
    value then makes the array invalid instead of being skipped. No JSON at all leaves
    an empty object, which has no products either.
    """
    whole = F.concat(F.lit("["), repair_braces(reply_json_span(text)), F.lit("]"))
    parsed = F.from_json(
        whole, f"array<struct<produtos:array<{schemas.REPLY_PRODUCT}>>>", _STRICT
    )
    # Bound to a lambda variable, so that a reply is parsed once and not per mention.
    products = F.transform(F.array(parsed), lambda a: F.when(F.size(a) == 1, a[0]["produtos"]))
    return F.element_at(products, 1)


def products_from_reply(
    df: DataFrame, reply_col: str, origem: Column | str, asof: Column
) -> DataFrame:
    """One raw listing per product of each reply.

    ``origem`` is the marketplace, ``asof`` the scrape time. Missing fields are NULL.
    """
    shop = F.lit(origem) if isinstance(origem, str) else origem
    exploded = df.select(
        F.explode(reply_products(F.col(reply_col))).alias("p"),
        shop.alias("origem"),
        F.date_format(asof, fixed.SCRAPE_FORMAT).alias("extract"),
    )
    fields = [f.name for f in schemas.LISTING.fields if f.name not in ("origem", "extract")]
    return exploded.where(F.col("p").isNotNull()).select(
        *[F.col(f"p.{name}").alias(name) for name in fields], "origem", "extract"
    )


def product_events(df: DataFrame, key: str = "codigo") -> DataFrame:
    """``key`` and JSON ``value`` per row, NULL fields kept, for a keyed event stream."""
    body = F.to_json(F.struct(*fixed.MESSAGE_FIELDS), {"ignoreNullFields": "false"})
    return df.select(F.col(key).alias("key"), body.alias("value"))
