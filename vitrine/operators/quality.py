"""Row rules that only report, and checks of whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine import fixed_values as fixed
from vitrine import schemas

REPORT = "dataset string, check string, passed boolean, detail string"

BRONZE_RULES = {
    "required_columns": "codigo IS NOT NULL AND preco IS NOT NULL",
    "extract_format": f"extract RLIKE '{fixed.SCRAPE_SHAPE}'",
}


def typed_not_null(schema: T.StructType) -> dict[str, str]:
    """One rule per column: declared type and a value present."""
    rules = {}
    for field in schema.fields:
        kind = field.dataType.simpleString()
        rules[f"{field.name}_{kind}_not_null"] = (
            f"typeof({field.name}) = '{kind}' AND {field.name} IS NOT NULL"
        )
    return rules


SILVER_RULES = typed_not_null(schemas.SILVER)
GOLD_RULES = typed_not_null(T.StructType([schemas.GOLD["recomendacao"]]))


def _holds(rule: str) -> Column:
    # A rule that is neither true nor false counts as failed.
    return F.coalesce(F.expr(rule), F.lit(False))


def _metrics(rules: Mapping[str, str]) -> list[Column]:
    return [F.count(F.lit(1)).alias("__rows")] + [
        F.count_if(_holds(rule)).alias(name) for name, rule in rules.items()
    ]


def expectations(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Passed and failed rows per rule, all rules in one pass."""
    counted = df.agg(*_metrics(rules))
    entries = [
        F.struct(
            F.lit(name).alias("expectation"),
            F.col(name).alias("passed_records"),
            (F.col("__rows") - F.col(name)).alias("failed_records"),
        )
        for name in rules
    ]
    return counted.select(F.inline(F.array(*entries)))


def observed(df: DataFrame, rules: Mapping[str, str], watch: Observation | str) -> DataFrame:
    """The same counts taken while ``df`` is being written, at no extra pass.

    ``watch`` is an ``Observation`` for a batch write or a metric name for a stream.
    """
    return df.observe(watch, *_metrics(rules))


def observed_counts(metrics: Mapping[str, int], rules: Mapping[str, str]) -> dict[str, tuple]:
    """``rule -> (passed, failed)`` from the metrics of ``observed``."""
    rows = metrics["__rows"]
    return {name: (metrics[name], rows - metrics[name]) for name in rules}


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column, one pass for all columns."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns]
    return counted.select(F.inline(F.array(*entries)))


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def check_columns(df: DataFrame, expected: Sequence[str]) -> bool:
    """Same column names, in any order."""
    return set(df.columns) == set(expected)


def check_types(df: DataFrame, expected: T.StructType) -> bool:
    """Every expected column is there with its type; others may exist too."""
    actual = dict(df.dtypes)
    return all(actual.get(f.name) == f.dataType.simpleString() for f in expected.fields)


def not_empty(df: DataFrame) -> bool:
    return not df.isEmpty()


def run_suite(
    spark: SparkSession, dataset: str, expected: T.StructType, forbid_nulls: bool = False
) -> DataFrame:
    """Checks of one stored table as rows ``(dataset, check, passed, detail)``.

    Existence, names and types come from the catalog. Emptiness and, if asked for,
    NULLs come from one aggregation over the table.
    """

    def fixed_row(check: str, passed: bool, detail: str) -> Column:
        return F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(check).alias("check"),
            F.lit(passed).alias("passed"),
            F.lit(detail).alias("detail"),
        )

    if not table_exists(spark, dataset):
        return spark.createDataFrame([(dataset, "table_exists", False, "missing")], REPORT)

    df = spark.table(dataset)
    columns = sorted(df.columns)
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    wrong = [n for n, kind in sorted(wanted.items()) if dict(df.dtypes).get(n) != kind]
    entries = [
        fixed_row("table_exists", True, "found"),
        fixed_row("columns", check_columns(df, list(wanted)), ",".join(columns)),
        fixed_row("types", check_types(df, expected), ",".join(wrong)),
    ]

    counts = [F.count(F.lit(1)).alias("__rows")]
    if forbid_nulls:
        counts += [F.count_if(F.col(c).isNull()).alias(c) for c in columns]

    def counted_row(check: str, passed: Column, detail: Column) -> Column:
        return F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(check).alias("check"),
            passed.alias("passed"),
            detail.cast("string").alias("detail"),
        )

    entries.append(counted_row("not_empty", F.col("__rows") > 0, F.col("__rows")))
    if forbid_nulls:
        entries += [counted_row(f"no_nulls:{c}", F.col(c) == 0, F.col(c)) for c in columns]
    return df.agg(*counts).select(F.inline(F.array(*entries)))
