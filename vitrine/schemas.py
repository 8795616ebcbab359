"""Declared schemas. Nothing is ever inferred from the files."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampType(),
}


def _struct(spec: str) -> T.StructType:
    """``name type, ...`` without needing a session."""
    fields = [column.split() for column in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


LISTING = _struct(
    "desconto string, codigo string, nome string, preco string, "
    "parcelamento string, link string, origem string, extract string"
)

EVENT = _struct(
    "desconto string, codigo string, nome string, preco string, "
    "parcelamento string, link string, origem string, extract string, "
    "EventProcessedUtcTime timestamp, PartitionId bigint, EventEnqueuedUtcTime timestamp"
)

SILVER = _struct(
    "codigo string, nome string, preco double, desconto double, numero_parcelas bigint, "
    "valor_prestacao double, origem string, link string, memoria string, oled string, "
    "extract timestamp"
)

GOLD = T.StructType([*SILVER.fields, T.StructField("recomendacao", T.StringType())])

DETAILS = ["codigo", "memoria", "oled", "recomendacao", "link"]
PRODUCTS = ["codigo", "nome", "origem"]
PRICES = ["codigo", "preco", "numero_parcelas", "valor_prestacao", "desconto", "data"]
SUGGESTION = ["codigo", "menor_preco", "recomendacao", "origem", "link"]

# One product inside an extractor reply.
REPLY_PRODUCT = (
    "struct<codigo:string,nome:string,preco:string,desconto:string,"
    "parcelamento:string,link:string>"
)
