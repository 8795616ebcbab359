import datetime as dt
import random
from decimal import Decimal

from helpers import bag, plan, rows
from pyspark.sql import functions as F
from vitrine.plans import reports

T0 = dt.datetime(2025, 1, 1)


def day(n):
    return T0 + dt.timedelta(days=n)


def clusters(spark, *items):
    data = [("w", cid, name, day(n), day(n), "d", "k", "v", None) for cid, name, n in items]
    return spark.createDataFrame(
        data,
        "workspace_id string, cluster_id string, cluster_name string, create_time timestamp, "
        "change_time timestamp, driver_node_type string, worker_node_type string, "
        "dbr_version string, data_security_mode string",
    )


def test_current_clusters(spark):
    df = clusters(spark, ("1", "dev", 0), ("2", "job-a", 1), ("2", "job-b", 3), ("3", None, 2), ("4", "jobs", 3))
    assert {r.cluster_name for r in reports.current_clusters(df, "w").collect()} == {"dev", "job-b", "jobs"}
    older = clusters(spark, ("1", "dev", 5), ("2", "job-a", 1))
    assert {r.cluster_name for r in reports.current_clusters(older, "w").collect()} == {"dev"}
    assert reports.current_clusters(df, "other").count() == 0


def test_inventory_keeps_one_row_per_record(spark):
    df = clusters(spark, ("1", "dev", 0), ("1", "dev", 1), ("2", "job", 0), ("3", None, 0))
    assert sorted(rows(reports.cluster_inventory(df, "w"))) == [("1", 3), ("1", 3)]


def test_cpu_peak(spark):
    cl = clusters(spark, ("1", "dev", 0), ("2", "job", -1))
    timeline = spark.createDataFrame(
        [("w", "1", day(0), 5.0), ("w", "1", day(0.5), 7.0), ("w", "1", day(1), 1.0), ("w", "2", day(0), 9.0),
         ("v", "1", day(0), 99.0)],
        "workspace_id string, cluster_id string, start_time timestamp, cpu_user_percent double",
    )
    got = rows(reports.daily_cpu_peak(timeline, cl, "w"))
    assert got == [("1", T0.date(), 7.0), ("1", day(1).date(), 1.0)]


def usage_and_prices(spark, seed=1):
    rng = random.Random(seed)
    skus = ["a", "b", "c", "d", None]
    usage = [
        (rng.choice(["w", "w", "v"]), "a" if i % 3 == 0 else rng.choice(skus),
         rng.choice([None, Decimal(rng.randint(0, 500000)) / 10000]), day(rng.randint(0, 20)))
        for i in range(300)
    ]
    prices = [
        (rng.choice(["a", "b", "c", None]),
         (rng.choice([None, Decimal(rng.randint(1, 90000)) / 10000]),), rng.choice([None, day(rng.randint(0, 2))]))
        for _ in range(40)
    ]
    return (
        spark.createDataFrame(
            usage,
            "workspace_id string, sku_name string, usage_quantity decimal(18,4), usage_end_time timestamp",
        ),
        spark.createDataFrame(
            prices, "sku_name string, pricing struct<default:decimal(18,4)>, price_start_time timestamp"
        ),
    )


def test_costs_equal_the_row_by_row_join(spark):
    for seed in range(3):
        usage, prices = usage_and_prices(spark, seed)
        joined = usage.where("workspace_id = 'w'").join(
            reports.latest_prices(prices), "sku_name", "left"
        )
        cost = F.sum(F.col("usage_quantity") * F.col("default")).cast("float")
        assert rows(reports.total_cost(usage, prices, "w")) == rows(joined.agg(cost))
        assert bag(reports.cost_by_sku(usage, prices, "w")) == bag(
            joined.groupBy("sku_name").agg(cost)
        )


def test_latest_prices_keep_ties(spark):
    _, prices = usage_and_prices(spark)
    newest = {}
    for r in prices.collect():
        if r.sku_name is not None and r.price_start_time is not None:
            newest[r.sku_name] = max(newest.get(r.sku_name, r.price_start_time), r.price_start_time)
    expected = [r for r in prices.collect() if r.sku_name and newest.get(r.sku_name) == r.price_start_time
                and r.price_start_time is not None]
    assert reports.latest_prices(prices).count() == len(expected) > 3


def test_usage(spark):
    usage, _ = usage_and_prices(spark)
    mine = [r for r in usage.collect() if r.workspace_id == "w"]
    total = sum(r.usage_quantity for r in mine if r.usage_quantity is not None)
    assert abs(reports.total_usage(usage, "w").first()[0] - float(total)) < 0.01
    daily = rows(reports.daily_usage(usage, "w", day(17).date()))
    wanted = sorted({r.usage_end_time.date() for r in mine if r.usage_end_time >= day(10)})
    assert [d for d, _ in daily] == wanted


def jobs_and_runs(spark, deleted=True):
    jobs = spark.createDataFrame(
        [("a", day(0), None), ("b", day(5), None), ("c", day(1), day(3) if deleted else None),
         ("b", day(6), None)],
        "job_id string, change_time timestamp, delete_time timestamp",
    )
    states = ["SUCCEEDED", "ERROR", "FAILED", "SKIPPED", "TIMED_OUT", "RUNNING", None]
    runs = spark.createDataFrame(
        [(job, f"t{i % 2}", state, day(n)) for job in "abc" for n in (-1, 0, 7) for i, state in enumerate(states)],
        "job_id string, task_key string, result_state string, period_start_time timestamp",
    )
    return runs, jobs


def test_run_reports(spark):
    runs, jobs = jobs_and_runs(spark)
    assert reports.active_runs(runs, jobs).count() == 7
    outcomes = dict(rows(reports.run_outcomes(runs, jobs)))
    assert outcomes == {"SUCCESS": 1, "ERROR": 3, "TIMED_OUT": 1, "OTHER": 2}
    assert rows(reports.errors_by_task(runs, jobs)) == [("t1", 2), ("t0", 1)]


def test_no_deleted_job_means_no_rows(spark):
    runs, jobs = jobs_and_runs(spark, deleted=False)
    assert reports.active_runs(runs, jobs).count() == 0
    assert rows(reports.run_outcomes(runs, jobs)) == []


def test_lineage(spark):
    df = spark.createDataFrame(
        [("p", "s", "full", "t", "full", "JOB"), ("p", "s", None, "t", "full", "JOB"),
         ("p", None, "full", "t", None, "JOB"), (None, "s", "full", "t", "full", "JOB"),
         ("q", "s", "full", "t", "full", "JOB"), ("p", "s", "full", None, "full", None)],
        "source_table_schema string, source_table_name string, source_table_full_name string, "
        "target_table_name string, target_table_full_name string, entity_type string",
    )
    assert set(rows(reports.lineage_by_table(df, "p"))) == {("p.s", "leitura", 1), ("p.t", "escrita", 2)}
    assert set(rows(reports.lineage_totals(df, "p"))) == {("leitura", 1), ("escrita", 2)}
    assert rows(reports.lineage_totals(df, "none")) == []


def test_one_scan_for_both_directions(spark, tmp_path):
    path = str(tmp_path / "lineage")
    columns = ["source_table_schema", "source_table_name", "source_table_full_name",
               "target_table_name", "target_table_full_name", "entity_type"]
    spark.createDataFrame([("p",) * 6], ", ".join(f"{c} string" for c in columns)).write.parquet(path)
    assert plan(reports.lineage_by_table(spark.read.parquet(path), "p")).count("FileScan") == 1
