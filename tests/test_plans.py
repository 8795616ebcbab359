"""What must hold for the plans at any scale."""

from helpers import plan
from vitrine import schemas
from vitrine.operators.dedup import dedup, dedup_latest
from vitrine.plans import reports
from vitrine.plans.layers import clean, recommend
from vitrine.streaming.consumer import singleton_consumer


def stored(spark, tmp_path, schema, name="t"):
    path = str(tmp_path / name)
    spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def test_cleaning_stays_in_one_jvm_stage(spark, tmp_path):
    text = plan(recommend(clean(stored(spark, tmp_path, schemas.LISTING)), 10.0))
    assert "Python" not in text and "Exchange" not in text and "Arrow" not in text
    assert "IsNotNull(codigo)" in text


def test_pruned_columns(spark, tmp_path):
    text = plan(recommend(clean(stored(spark, tmp_path, schemas.LISTING))).select("codigo", "preco"))
    assert "ReadSchema: struct<codigo:string,preco:string>" in text


def test_dedup_combines_before_the_shuffle(spark, tmp_path):
    raw = stored(spark, tmp_path, schemas.LISTING)
    assert plan(dedup(raw, ["codigo", "preco"])).count("Aggregate") == 2
    assert plan(dedup_latest(raw, ["codigo", "preco"])).count("WindowGroupLimit") == 2


def test_interval_join_has_an_equality_on_time(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(singleton_consumer(stored(spark, tmp_path, schemas.EVENT)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [left_codigo" in text and "__bucket" in text
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_no_nested_loops_in_reports(spark, tmp_path):
    spec = (
        "workspace_id string, cluster_id string, cluster_name string, create_time timestamp, "
        "change_time timestamp, driver_node_type string, worker_node_type string, "
        "dbr_version string, data_security_mode string"
    )
    text = plan(reports.cluster_inventory(stored(spark, tmp_path, spec), "w"))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_lineage_filters_reach_the_scan(spark, tmp_path):
    spec = (
        "source_table_schema string, source_table_name string, source_table_full_name string, "
        "target_table_name string, target_table_full_name string, entity_type string"
    )
    text = plan(reports.lineage_totals(stored(spark, tmp_path, spec), "p"))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "IsNotNull(entity_type)" in pushed and "IsNotNull(source_table_schema)" in pushed
