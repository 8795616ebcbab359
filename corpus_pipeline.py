"""From raw documents to packed training sequences, stage by stage.

Each stage is a function of (spark, docs, sf_dir), works on all that the one before it kept, and is written as
Parquet and read again. All but the last return the columns of ``documents``:

1. language: documents without any letter (language ``und``) go; the language models are learned from the labelled
   documents of the stage's own input.
2. near_copies: one document of each class of near copies stays, the one with the smallest doc_id.
3. repeats: passages of 20 words or more that occur earlier are cut out. A document that loses words is its other words
   joined by one space, with its n_chars counted anew; one that loses all its words goes.
4. decontamination: documents of which a twentieth or more are passages of ``benchmark`` go.
5. packing: the pieces of all documents in sequences of 2048 tokens.

Documents with NULL in any column, without text, repeated, or with further columns pass through every stage as the
stages' operators define; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import language, near_copies, packing, phrase_automata, positional_index
from vitrine.session import scratch_dir


def _row(docs: DataFrame):
    """All columns as one, so that their names cannot clash with those an operator adds."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = language.identify(spark, docs, "text", F.col("lang").isNotNull(), "lang", _row(docs))
    return judged.where(F.col("lang_pred") != language.UNDETERMINED).select("__row.*")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.one_of_each(spark, docs, "doc_id", "text")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = phrase_automata.remove_repeats(spark, docs, "doc_id", "text", _row(docs))
    left = cleaned.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    cut = F.col("n_removed") > 0
    changed = {
        "text": F.when(cut, F.col("kept_text")).otherwise(F.col("__row.text")),
        "n_chars": F.when(cut, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("__row.n_chars")),
    }
    return left.select(*[changed.get(c, F.col(f"__row.`{c}`")).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return positional_index.decontaminate(spark, docs, "doc_id", "text", benchmark, "item_id", "text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(spark, docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_languages),
    ("near_copies", keep_one_of_near_copies),
    ("repeats", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# SQL has no suffix automata, alignment or tokenizer: tests/llm holds the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
