"""From pages to keyed messages in one stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.operators.html import html_blocks
from vitrine.operators.replies import product_events, products_from_reply

HASH = "content"


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def page_messages(
    pages: DataFrame, replies: DataFrame, origem: Column | str, asof: Column, tag: str = "div", css_class: str = "ad"
) -> DataFrame:
    """Blocks of pages, the extractor's reply to each, its products, and a keyed message per product.

    ``pages`` is (page_id, html), batch or stream; ``replies`` is stored: the hash of a block (``content``) and its
    ``reply``, one row per block. A block with the same content has the same reply, so a page that comes again costs
    no new reply. Blocks without a reply give nothing. ``asof`` may use the columns of ``pages``' blocks.
    """
    blocks = html_blocks(pages.select("page_id", "html"), tag, css_class).withColumn(HASH, content_hash(F.col("block")))
    answered = blocks.drop("block").join(replies.select(HASH, "reply"), HASH)
    return product_events(products_from_reply(answered, "reply", origem, asof))


def decoded(messages: DataFrame, arrived: Column) -> DataFrame:
    """Messages as broker records: ``value``, ``partition`` and ``timestamp``, for ``decode_broker``."""
    return messages.select(
        F.col("value").cast("binary").alias("value"),
        F.pmod(F.xxhash64("key"), F.lit(10)).cast("int").alias("partition"),
        arrived.alias("timestamp"),
    )
