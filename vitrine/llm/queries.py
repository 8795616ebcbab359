"""Registered queries of the operators, and the pipeline, on the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import (
    hard_negatives,
    language,
    licence_rules,
    metric_join,
    near_copies,
    packing,
    phrase_automata,
    pivot_search,
    positional_index,
    prefix_trie,
    token_index,
    toxicity,
    url_filter,
)
from vitrine.llm.batches import stored
from vitrine.session import scratch_dir


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


# Rules as host, path and verdict.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
# The list of this query: canonical URLs of pages below hosts with one of these labels.
LISTED_LABELS = ["spam-farm", "casino-win", "cheap-pills"]


def _remainder(divisor: int) -> Column:
    """crc32 of doc_id as text, modulo ``divisor``; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % divisor


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = _remainder(4) == 2
    labels = _table(spark, sf_dir, "labels", "doc_id", "toxic").where(~held_out)
    model = toxicity.learn(spark, documents, "doc_id", "text", labels, "toxic")
    scored = toxicity.score(spark, documents, "text", model, F.col("doc_id"), held_out.alias("held_out"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op2_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return pivot_search.search(spark, vectors, "vec_id", "embedding", F.col("vec_id") % 50 == 0)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    benchmark = _table(spark, sf_dir, "benchmark", "item_id", "text")
    index = positional_index.build(spark, documents, "doc_id", "text", scratch_dir(spark, "positions"))
    judged = positional_index.judge(index, positional_index.search(spark, index, benchmark, "item_id", "text"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    cleaned = phrase_automata.remove_repeats(spark, documents, "doc_id", "text", F.col("doc_id"))
    return cleaned.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = _remainder(5) == 0
    return language.identify(
        spark, documents, "text", ~held_out, "lang", F.col("doc_id"), held_out.alias("held_out")
    )


def op6_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.classes(spark, _table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(spark, documents, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages", "page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
    below = rf"(^|[.])({'|'.join(LISTED_LABELS)})[.]"
    listed = pages.select(host.alias("host"), path.alias("path")).where(F.col("host").rlike(below))
    judged = url_filter.judge(spark, pages, rules, listed, "page_id", "url")
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_rules.scan(_table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")


def op10_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    path = scratch_dir(spark, "token-index")
    token_index.write(spark, documents, "doc_id", "text", path, public_tokenizers.path("byte_bpe_50k.json"))
    placed = token_index.locate(spark, path, token_index.keys(spark, path))
    read = token_index.checksums(spark, path)
    return placed.join(read, ["shard", "segment", "place"]).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32"
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    convs = stored(spark, prefix_trie.sequences(turns, "conv_id", "turn", "role", "text"), "conversations")
    conv = F.col("conv")
    heads = (F.crc32(conv.cast("string")) % 4).cast("int")
    return prefix_trie.nodes(spark, prefix_trie.spliced(convs, conv - conv % 20, heads))


def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.near_vectors(spark, _table(spark, sf_dir, "embeddings", "vec_id", "embedding"), "vec_id", "embedding")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    vec_id, label = F.col("vec_id"), F.col("label")
    changed = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(spark, vectors, "vec_id", changed, "embedding", vec_id % 100 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_pivot_search": op2_pivot_search,
        "op3_decontamination": op3_decontamination,
        "op4_repeats": op4_repeats,
        "op5_language": op5_language,
        "op6_near_copies": op6_near_copies,
        "op7_packing": op7_packing,
        "op8_url_filter": op8_url_filter,
        "op9_licences": op9_licences,
        "op10_token_index": op10_token_index,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_near_vectors": op12_near_vectors,
        "op13_hard_negatives": op13_hard_negatives,
    }
