from helpers import listings, rows
from pyspark.sql import Observation
from vitrine import schemas
from vitrine.operators import quality
from vitrine.plans.layers import clean, recommend


def raw(spark):
    return listings(
        spark,
        dict(codigo="1", preco="R$ 1,00", extract="2025-10-05 19:00", nome="n", origem="o", link="l"),
        dict(codigo="2", extract="2025-10-05"),
        dict(preco="1"),
    )


def test_expectations_keep_rows_and_count(spark):
    got = {r.expectation: (r.passed_records, r.failed_records)
           for r in quality.expectations(raw(spark), quality.BRONZE_RULES).collect()}
    assert got == {"required_columns": (1, 2), "extract_format": (1, 2)}


def test_observed_counts_match(spark):
    watch = Observation("bronze")
    df = quality.observed(raw(spark), quality.BRONZE_RULES, watch)
    assert df.count() == 3
    assert quality.observed_counts(watch.get, quality.BRONZE_RULES) == {
        "required_columns": (1, 2),
        "extract_format": (1, 2),
    }


def test_typed_rules(spark):
    silver = clean(raw(spark))
    got = {r.expectation: (r.passed_records, r.failed_records)
           for r in quality.expectations(silver, quality.SILVER_RULES).collect()}
    assert len(got) == 11
    assert got["preco_double_not_null"] == (2, 0)
    assert got["extract_timestamp_not_null"] == (1, 1)
    wrong = silver.withColumn("preco", silver.preco.cast("string"))
    assert quality.expectations(wrong, {"p": quality.SILVER_RULES["preco_double_not_null"]}).first()[1:] == (0, 2)
    gold = quality.expectations(recommend(silver), quality.GOLD_RULES)
    assert rows(gold) == [("recomendacao_string_not_null", 2, 0)]


def test_null_counts(spark):
    got = dict(rows(quality.null_counts(raw(spark))))
    assert got["codigo"] == 1 and got["preco"] == 1 and got["desconto"] == 3


def test_checks(spark):
    df = raw(spark)
    assert quality.check_columns(df, list(reversed(schemas.LISTING.names)))
    assert not quality.check_columns(df, schemas.LISTING.names[1:])
    assert quality.check_types(df.selectExpr("*", "1 AS extra"), schemas.LISTING)
    assert not quality.check_types(df.drop("link"), schemas.LISTING)
    assert quality.not_empty(df) and not quality.not_empty(df.where("false"))


def test_suites(spark):
    raw(spark).write.mode("overwrite").format("parquet").saveAsTable("suite_raw")
    got = {r.check: (r.passed, r.detail)
           for r in quality.run_suite(spark, "suite_raw", schemas.LISTING, forbid_nulls=True).collect()}
    assert got["table_exists"][0] and got["columns"][0] and got["types"][0]
    assert got["not_empty"] == (True, "3")
    assert got["no_nulls:codigo"] == (False, "1")
    failing = {r.check: r.passed for r in quality.run_suite(spark, "suite_raw", schemas.SILVER).collect()}
    assert not failing["columns"] and not failing["types"]
    missing = rows(quality.run_suite(spark, "no_such_table", schemas.SILVER))
    assert missing == [("no_such_table", "table_exists", False, "missing")]
    spark.sql("DROP TABLE suite_raw")
