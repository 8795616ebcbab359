"""URL filter: a blocked Bloom filter lets possible hits through to an exact hash join with the list.

Only DataFrame functions. A page is judged by its host and path. Rules name a host, which stands for its subdomains
too, and the start of a path; the longest that fits decides. Where none fits, a page is blocked if its canonical
URL (host and path) is listed.

The keys under which a page may be listed (its URL, and one for each shape of rule: so many host labels, so many
characters of path) are tested against the filter first. The filter is a table of blocks of 256 bits. The number of
blocks has a fixed limit, so broadcasting it is bounded however long the list is; beyond the limit more keys pass
by mistake, and the exact join removes them. Only keys that pass are shuffled, once per distinct URL.

Defined results: a URL that is NULL or has no ``://`` has an empty host and path, fits no rule, and is allowed
unless an empty URL is listed. Repeated pages are judged one by one; an empty list or an empty set of rules lists
nothing; an empty table of pages gives no rows. Columns of the pages other than the key and the URL are not read,
so names may clash. Of two rules that are equally long, the one with the longer host wins, then the smaller text.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.batches import stored

MAX_BLOCKS = 1 << 16  # of 32 bytes and a number: under 3 MB
BITS_PER_KEY = 16
_WORDS = 4
_BITS_PER_WORD = 2


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    host = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty if there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _masks(key: Column) -> list[Column]:
    """The bits of a key in each word of its block."""
    bits = F.xxhash64(F.lit("bits"), key)
    one = F.lit(1).cast("long")
    masks = []
    for word in range(_WORDS):
        at = [
            F.shiftrightunsigned(bits, 6 * (word * _BITS_PER_WORD + i)).bitwiseAND(F.lit(63)).cast("int")
            for i in range(_BITS_PER_WORD)
        ]
        mask = F.call_function("shiftleft", one, at[0])
        for other in at[1:]:
            mask = mask.bitwiseOR(F.call_function("shiftleft", one, other))
        masks.append(mask)
    return masks


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks).cast("long"))


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """Blocked Bloom filter of the column ``key``: a row for each block that has bits."""
    masked = keys.select(
        _block(F.col("key"), blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col("key")))]
    )
    return masked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(_WORDS)])


def may_be_listed(keys: DataFrame, filter_: DataFrame, blocks: int) -> DataFrame:
    """Rows whose ``key`` has all its bits in the filter."""
    tested = keys.withColumn("block", _block(F.col("key"), blocks)).join(F.broadcast(filter_), "block")
    for i, mask in enumerate(_masks(F.col("key"))):
        tested = tested.where(F.col(f"w{i}").bitwiseAND(mask) == mask)
    return tested.drop("block", *[f"w{i}" for i in range(_WORDS)])


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def judge(spark: SparkSession, pages: DataFrame, rules: DataFrame, listed: DataFrame, key: str, url: str) -> DataFrame:
    """One row per page: its key, host, path, rule, listed (boolean) and verdict (allow or block).

    ``rules`` has host, path and verdict; ``listed`` has canonical URLs as host and path. Both may be of any length;
    ``rules`` should have few shapes (number of host labels, length of path), as each makes a key of every page.
    """
    known_rules = rules.dropna(subset=["host", "path", "verdict"]).select(
        F.concat("host", "path").alias("rule"), "host", "path", "verdict"
    )
    shapes = [
        tuple(r)
        for r in known_rules.select(_labels(F.col("host")).alias("n"), F.length("path").alias("m")).distinct().collect()
    ]
    entries = known_rules.select(
        F.concat(F.lit("rule "), _labels(F.col("host")), F.lit(" "), F.length("path"), F.lit(" "), "rule").alias("key"),
        "rule",
        "verdict",
        F.length("host").alias("host_length"),
        F.lit(False).alias("listed"),
    ).union(
        listed.dropna(subset=["host", "path"])
        .select(F.concat(F.lit("url "), "host", "path").alias("key"))
        .distinct()
        .select("key", F.lit(None).cast("string"), F.lit("block"), F.lit(0), F.lit(True))
    )
    blocks = min(MAX_BLOCKS, max(1, entries.count() * BITS_PER_KEY // (64 * _WORDS)))

    judged = pages.select(F.col(key).alias("page"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    keys = [F.concat(F.lit("url "), "host", "path")]
    for labels, length in sorted(shapes):
        fits = (_labels(F.col("host")) >= labels) & (F.length("path") >= length)
        tail = F.concat(F.substring_index("host", ".", -labels), F.substring("path", 1, length))
        keys.append(F.when(fits, F.concat(F.lit(f"rule {labels} {length} "), tail)))
    asked = judged.select("host", "path", F.explode(F.array_compact(F.array(*keys))).alias("key"))
    passed = may_be_listed(asked, bloom(entries.select("key"), blocks), blocks).distinct()
    found = (
        passed.join(entries, "key")
        .groupBy("host", "path")
        .agg(
            F.min(
                F.when(~F.col("listed"), F.struct(-F.length("rule"), -F.col("host_length"), "rule", "verdict"))
            ).alias("best"),
            F.max("listed").alias("listed"),
        )
    )
    # Read again from a table, hits are not bound to the aggregation's partitions, and adaptive execution can split the
    # pages of a hot URL (all those without "://" are one).
    verdicts = judged.join(stored(spark, found, "hits"), ["host", "path"], "left")
    is_listed = F.coalesce("listed", F.lit(False))
    return verdicts.select(
        F.col("page").alias(key),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        is_listed.alias("listed"),
        F.coalesce("best.verdict", F.when(is_listed, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
    )
