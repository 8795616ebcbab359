"""Operational reports: clusters, usage and cost, job runs, lineage.

Every report takes its tables and parameters as arguments. Where a report joins, the
large side is aggregated first, so hot keys shrink in the map tasks.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine import fixed_values as fixed
from vitrine.operators.groups import latest_by


def _of(df: DataFrame, workspace_id: str) -> DataFrame:
    return df.where(F.col("workspace_id") == workspace_id)


# --- clusters ---------------------------------------------------------------


def current_clusters(clusters: DataFrame, workspace_id: str) -> DataFrame:
    """Clusters that are not job clusters, and the newest cluster if it is one.

    The newest is taken over all clusters of the workspace. A cluster without a name
    is left out.
    """
    own = _of(clusters, workspace_id)
    newest = own.agg(F.max("create_time")).scalar()
    is_job = F.col("cluster_name").startswith(fixed.JOB_CLUSTER_PREFIX)
    return own.where(~is_job | (is_job & (F.col("create_time") == newest)))


def cluster_inventory(clusters: DataFrame, workspace_id: str) -> DataFrame:
    """Current cluster records, each with the number of distinct clusters ever seen."""
    known = _of(clusters, workspace_id).agg(F.count_distinct("cluster_id")).scalar()
    return current_clusters(clusters, workspace_id).select(
        "cluster_id", known.alias("distinct_cluster_id_count")
    )


def cluster_listing(clusters: DataFrame, workspace_id: str) -> DataFrame:
    return current_clusters(clusters, workspace_id).select(
        "cluster_name",
        "create_time",
        "change_time",
        "driver_node_type",
        "worker_node_type",
        "dbr_version",
        "data_security_mode",
    )


def daily_cpu_peak(timeline: DataFrame, clusters: DataFrame, workspace_id: str) -> DataFrame:
    """Highest CPU share per current cluster and day."""
    peaks = (
        _of(timeline, workspace_id)
        .groupBy("cluster_id", F.to_date("start_time").alias("start_time"))
        .agg(F.max("cpu_user_percent").alias("max_cpu_user_percent"))
    )
    current = current_clusters(clusters, workspace_id).select("cluster_id")
    return peaks.join(current, "cluster_id", "left_semi").orderBy("cluster_id", "start_time")


# --- usage and cost ---------------------------------------------------------


def _usage_total() -> Column:
    return F.round(F.sum("usage_quantity").cast("float"), 2)


def total_usage(usage: DataFrame, workspace_id: str) -> DataFrame:
    return _of(usage, workspace_id).agg(_usage_total().alias("total_usage_quantity"))


def daily_usage(usage: DataFrame, workspace_id: str, as_of: dt.date) -> DataFrame:
    """Usage per day from seven days before ``as_of`` on."""
    since = dt.datetime.combine(as_of - dt.timedelta(days=7), dt.time())
    return (
        _of(usage, workspace_id)
        .where(F.col("usage_end_time") >= F.lit(since.isoformat(" ")).cast("timestamp"))
        .groupBy(F.to_date("usage_end_time").alias("usage_end_date"))
        .agg(_usage_total().alias("total_dbu_usage"))
        .orderBy("usage_end_date")
    )


def latest_prices(list_prices: DataFrame) -> DataFrame:
    """Prices with the latest start per SKU; equal starts all stay."""
    keys = ["sku_name", "price_start_time"]
    newest = list_prices.groupBy("sku_name").agg(F.max("price_start_time").alias(keys[1]))
    return list_prices.join(newest, keys, "left_semi").select(
        "sku_name",
        F.col("pricing.default").alias("default"),
        F.to_date("price_start_time").alias("price_start_date"),
    )


def _price_per_sku(list_prices: DataFrame) -> DataFrame:
    """Sum of the latest prices of each SKU, as ``sku_name, price``.

    Prices with the same SKU and start are added up in the map tasks, so neither many
    starts nor many equal starts of one SKU meet in one task.
    """
    per_start = (
        list_prices.where(F.col("sku_name").isNotNull() & F.col("price_start_time").isNotNull())
        .groupBy("sku_name", "price_start_time")
        .agg(F.sum("pricing.default").alias("price"))
    )
    return latest_by(per_start, ["sku_name"], "price_start_time").select("sku_name", "price")


def _cost_per_sku(usage: DataFrame, list_prices: DataFrame, workspace_id: str) -> DataFrame:
    """Cost of all usage of each SKU.

    Every usage row meets every latest price of its SKU, so the sum of all products is
    the summed quantity times the summed price: both sides shrink to one row per SKU
    before they are joined. A SKU without a price has a NULL cost.
    """
    per_sku = _of(usage, workspace_id).groupBy("sku_name").agg(F.sum("usage_quantity").alias("q"))
    priced = _price_per_sku(list_prices)
    return per_sku.join(priced, "sku_name", "left").select(
        "sku_name", (F.col("q") * F.col("price")).alias("cost")
    )


def total_cost(usage: DataFrame, list_prices: DataFrame, workspace_id: str) -> DataFrame:
    """Cost of all usage; usage without a price adds nothing."""
    rows = _cost_per_sku(usage, list_prices, workspace_id)
    return rows.agg(F.sum("cost").cast("float").alias("total_cost_cluster"))


def cost_by_sku(usage: DataFrame, list_prices: DataFrame, workspace_id: str) -> DataFrame:
    cost = F.col("cost").cast("float").alias("total_cost_cluster")
    rows = _cost_per_sku(usage, list_prices, workspace_id).select("sku_name", cost)
    return rows.orderBy(F.col("total_cost_cluster").desc())


# --- job runs ---------------------------------------------------------------


def outcome(state: Column) -> Column:
    return (
        F.when(state == fixed.RUN_OK, "SUCCESS")
        .when(state.isin(fixed.RUN_FAILURES), "ERROR")
        .when(state == fixed.RUN_TIMEOUT, fixed.RUN_TIMEOUT)
        .otherwise("OTHER")
    )


def _after_first_change(runs: DataFrame, jobs: DataFrame) -> DataFrame:
    return runs.where(F.col("period_start_time") > jobs.agg(F.min("change_time")).scalar())


def _live_jobs(jobs: DataFrame) -> DataFrame:
    """Jobs changed more than a minute after the last deletion; none if nothing was deleted."""
    last_delete = jobs.agg(F.max("delete_time") + F.expr("INTERVAL 1 MINUTE")).scalar()
    return jobs.where(F.col("change_time") > last_delete).select("job_id")


def active_runs(runs: DataFrame, jobs: DataFrame) -> DataFrame:
    """Runs after the first job change that belong to a live job."""
    return _after_first_change(runs, jobs).join(_live_jobs(jobs), "job_id", "left_semi")


def _active_counts(runs: DataFrame, jobs: DataFrame, label: Column, name: str) -> DataFrame:
    """Rows of ``active_runs`` per label, counted per job before the semi join."""
    per_job = (
        _after_first_change(runs, jobs)
        .groupBy("job_id", label.alias(name))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    live = per_job.join(_live_jobs(jobs), "job_id", "left_semi")
    return live.groupBy(name).agg(F.sum("n").alias("n"))


def run_outcomes(runs: DataFrame, jobs: DataFrame) -> DataFrame:
    """Active runs per outcome; an unknown state is ``OTHER``."""
    counts = _active_counts(runs, jobs, outcome(F.col("result_state")), "result_state")
    return counts.withColumnRenamed("n", "total_count").orderBy(F.col("total_count").desc())


def errors_by_task(runs: DataFrame, jobs: DataFrame) -> DataFrame:
    failed = runs.where(F.col("result_state").isin(fixed.RUN_FAILURES))
    counts = _active_counts(failed, jobs, F.col("task_key"), "task_key")
    return counts.withColumnRenamed("n", "error_count").orderBy(F.col("error_count").desc())


# --- lineage ----------------------------------------------------------------


def _lineage_actions(lineage: DataFrame) -> DataFrame:
    """A read and a write entry per lineage row, in one scan.

    A write is labelled with the schema of the source and the name of the target.
    """

    def action(kind: str, end: str) -> Column:
        label = F.concat(F.col("source_table_schema"), F.lit("."), F.col(f"{end}_table_name"))
        known = F.col(f"{end}_table_full_name").isNotNull()
        return F.struct(F.when(known, label).alias("table"), F.lit(kind).alias("type"))

    labelled = lineage.where(
        F.col("entity_type").isNotNull() & F.col("source_table_schema").isNotNull()
    )
    return labelled.select(
        F.inline(
            F.array(
                action(fixed.LINEAGE_READ, "source"),
                action(fixed.LINEAGE_WRITE, "target"),
            )
        )
    )


def lineage_by_table(lineage: DataFrame, prefix: str) -> DataFrame:
    """Reads and writes per table whose label starts with ``prefix``."""
    return (
        _lineage_actions(lineage)
        .where(F.col("table").startswith(prefix))
        .groupBy("table", "type")
        .agg(F.count(F.lit(1)).alias("total_count"))
        .orderBy(F.col("total_count").desc())
    )


def lineage_totals(lineage: DataFrame, prefix: str) -> DataFrame:
    """Reads and writes over all tables whose label starts with ``prefix``."""
    return (
        _lineage_actions(lineage)
        .where(F.col("table").startswith(prefix))
        .groupBy("type")
        .agg(F.count(F.lit(1)).alias("total_count"))
        .orderBy(F.col("total_count").desc())
    )
