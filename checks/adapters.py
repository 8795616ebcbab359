"""Inputs of the library derived from the given tables, always from whole tables.

``checks.oracles`` derives the same inputs in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORKSPACE = "w1"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def _money(cents: str) -> str:
    """Cents as ``1.234,50``."""
    return (
        f"concat(CASE WHEN {cents} >= 100000 THEN concat(cast({cents} div 100000 as string), '.', "
        f"lpad(cast(({cents} div 100) % 1000 as string), 3, '0')) "
        f"ELSE cast({cents} div 100 as string) END, ',', "
        f"lpad(cast({cents} % 100 as string), 2, '0'))"
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listings from ``lineitem`` and ``part``."""
    rows = (
        _lineitem(spark, sf_dir)
        .join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
        .selectExpr(
            "l_orderkey AS k",
            "l_linenumber AS line",
            "l_quantity AS qty",
            "p_size",
            "p_name",
            "l_suppkey",
            "l_shipdate",
            "cast(round(l_discount * 100) as int) AS pct",
            "cast(round(p_retailprice * 100) as bigint) + 100 * cast(l_quantity as bigint) AS cents",
            "cast(100000000 + l_partkey as string) AS code",
            "concat('loja', cast(l_suppkey % 5 as string)) AS shop",
        )
    )
    return rows.selectExpr(
        "CASE WHEN pct = 0 THEN NULL WHEN k % 19 = 0 THEN concat(cast(pct as string), '% OFF') "
        "WHEN k % 37 = 0 THEN concat('0.', lpad(cast(pct as string), 2, '0')) "
        "ELSE concat(cast(pct as string), '%') END AS desconto",
        "CASE WHEN line = 7 AND qty = 1 THEN NULL ELSE code END AS codigo",
        "concat('Console ', p_name, CASE p_size % 4 WHEN 0 THEN ' 32GB' WHEN 1 THEN ' 64 gb' "
        "WHEN 2 THEN ' Oled 64Gb' ELSE '' END) AS nome",
        "CASE WHEN k % 17 = 0 THEN 'indisponivel' "
        "WHEN k % 13 = 0 THEN concat(cast(cents div 100 as string), '.', "
        "lpad(cast(cents % 100 as string), 2, '0')) "
        f"ELSE concat('R$ ', {_money('cents')}) END AS preco",
        "CASE WHEN line = 2 THEN NULL WHEN k % 23 = 0 THEN 'em breve' "
        "ELSE concat(cast(line as string), CASE WHEN k % 41 = 0 THEN 'X' ELSE 'x' END, "
        f"' de R$ ', {_money('(cents div line)')}, ' sem juros') END AS parcelamento",
        "CASE WHEN k % 29 = 0 THEN concat('/p/', code) "
        "ELSE concat('https://www.', shop, '.com.br/p/', code) END AS link",
        "CASE WHEN k % 43 = 0 THEN NULL ELSE shop END AS origem",
        "CASE WHEN k % 31 = 0 THEN date_format(l_shipdate, 'yyyy/MM/dd HH:mm') "
        "ELSE date_format(l_shipdate, 'yyyy-MM-dd HH:mm') END AS extract",
    )


def raw_events(events: DataFrame) -> DataFrame:
    """Untyped marketplace events from ``events``, batch or streaming."""
    return events.selectExpr(
        "CASE WHEN event_id % 3 = 0 THEN NULL ELSE concat(cast(event_id % 10 as string), '%') END "
        "AS desconto",
        "CASE WHEN event_id % 97 = 0 THEN NULL ELSE cast(user_id as string) END AS codigo",
        "concat('item ', event_type) AS nome",
        "event_type AS preco",
        "CASE WHEN event_id % 11 = 0 THEN NULL ELSE cast(event_id % 2 as string) END AS parcelamento",
        "concat('https://www.loja.com.br/p/', cast(event_id as string)) AS link",
        "concat('loja', cast(user_id % 5 as string)) AS origem",
        "date_format(ts, 'yyyy-MM-dd HH:mm') AS extract",
        "CASE WHEN event_id % 59 = 0 THEN 'ontem' "
        "ELSE cast(ts + make_dt_interval(0, 0, 0, event_id % 20) as string) END "
        "AS EventProcessedUtcTime",
        "CASE WHEN event_id % 53 = 0 THEN 'p3' ELSE cast(event_id % 10 as string) END AS PartitionId",
        "cast(ts as string) AS EventEnqueuedUtcTime",
    )


_WORKSPACE_OF = "CASE WHEN {key} % 5 = 0 THEN 'w2' ELSE 'w1' END AS workspace_id"


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        _WORKSPACE_OF.format(key="o_orderkey"),
        "concat('c', cast(o_custkey as string)) AS cluster_id",
        "CASE WHEN o_orderkey % 11 = 0 THEN NULL "
        "WHEN o_orderkey % 3 = 0 THEN concat('job-', cast(o_orderkey as string)) "
        "ELSE concat('dev-', cast(o_custkey as string)) END AS cluster_name",
        "cast(o_orderdate as timestamp) AS create_time",
        "cast(o_orderdate + make_dt_interval(cast(o_orderkey % 30 as int)) as timestamp) "
        "AS change_time",
        "o_orderpriority AS driver_node_type",
        "o_orderstatus AS worker_node_type",
        "concat('1', cast(o_orderkey % 6 as string), '.x') AS dbr_version",
        "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'SINGLE' END AS data_security_mode",
    )


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _lineitem(spark, sf_dir)
        .join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
        .selectExpr(
            _WORKSPACE_OF.format(key="l_orderkey"),
            # Some usage has no SKU, some has one without a price.
            "CASE WHEN l_orderkey % 29 = 0 THEN NULL WHEN l_orderkey % 10 = 3 THEN concat(p_type, ' spot') "
            "ELSE concat(p_type, cast(p_size as string)) END AS sku_name",
            "cast(l_quantity + l_discount as decimal(18,4)) AS usage_quantity",
            "cast(l_shipdate as timestamp) AS usage_end_time",
        )
    )


def list_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of every part's SKU; several parts of a SKU may share the latest start."""
    return (
        _lineitem(spark, sf_dir)
        .join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
        .selectExpr(
            "concat(p_type, cast(p_size as string)) AS sku_name",
            "cast(p_retailprice as decimal(18,4)) AS price",
            "cast(date_trunc('year', l_shipdate) as timestamp) AS price_start_time",
        )
        .distinct()
        .selectExpr("sku_name", "named_struct('default', price) AS pricing", "price_start_time")
    )


def node_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(
        _WORKSPACE_OF.format(key="event_id"),
        "concat('c', cast(user_id as string)) AS cluster_id",
        "cast(ts as timestamp) AS start_time",
        "value AS cpu_user_percent",
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('j', cast(o_custkey as string)) AS job_id",
        "cast(o_orderdate as timestamp) AS change_time",
        "CASE WHEN o_orderkey % 50 = 0 AND o_orderdate < timestamp_ntz'2001-06-01' "
        "THEN cast(o_orderdate + make_dt_interval(10) as timestamp) END AS delete_time",
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(
        "concat('j', cast(user_id as string)) AS job_id",
        "concat('task', cast(event_id % 17 as string)) AS task_key",
        "CASE event_type WHEN 'view' THEN 'SUCCEEDED' WHEN 'signup' THEN 'FAILED' "
        "WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'TIMED_OUT' "
        "ELSE CASE event_id % 3 WHEN 0 THEN 'SKIPPED' WHEN 1 THEN 'RUNNING' END END "
        "AS result_state",
        "cast(ts - make_dt_interval(cast((event_id % 4) * 3650 as int)) as timestamp) "
        "AS period_start_time",
    )


def table_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(
        "CASE WHEN event_id % 31 = 0 THEN NULL ELSE event_type END AS source_table_schema",
        "concat('t', cast(user_id % 20 as string)) AS source_table_name",
        "CASE WHEN event_id % 7 = 0 THEN NULL ELSE concat('cat.', event_type) END "
        "AS source_table_full_name",
        "CASE WHEN event_id % 9 = 0 THEN NULL ELSE concat('m', cast(user_id % 7 as string)) END "
        "AS target_table_name",
        "CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'cat.target' END AS target_table_full_name",
        "CASE WHEN event_id % 13 = 0 THEN NULL ELSE 'JOB' END AS entity_type",
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extractor replies around every ``part``: good, broken and without JSON."""
    code = "cast(100000000 + p_partkey as string)"
    first = (
        f"""concat('{{"nome":"', p_name, '","preco":"R$ 1.359,87","link":"/p/', {code}, """
        f"""'","codigo":"', {code}, '","desconto":null,"parcelamento":"10x de R$ 149,90"}}')"""
    )
    spaced = (
        """concat('{\\n  "nome": "', p_name, ' ção",\\n  "preco": ', """
        f"""cast(p_size as string), ',\\n  "codigo": "', {code}, '"\\n}}')"""
    )
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        _reply_case(first, spaced),
    )


def _reply_case(first: str, spaced: str) -> str:
    cases = [
        f"concat('Segue: {{\"produtos\":[', {first}, ']}} fim')",
        f"concat('Claro!\\n{{ \"produtos\": [\\n', {spaced}, ' ] }}\\nAté logo')",
        "concat('Nada encontrado para ', p_name)",
        f"concat('{{\"produtos\":[', {first}, '}}')",
        "'{\"itens\":[]}'",
        f"concat('{{\"produtos\":[', {first}, ', ', {spaced}, ']}}')",
        f"concat('{{\"produtos\":[', {first}, ']}} {{\"x\": 1}}')",
        f"concat('{{\"produtos\":[', {first}, '],\"a\":{{\"b\":{{\"c\":1}}}}}}')",
    ]
    whens = " ".join(f"WHEN {i} THEN {case}" for i, case in enumerate(cases))
    return f"CASE p_partkey % 9 {whens} ELSE '{{\"produtos\":\"nada\"}}' END AS reply"


def block_replies(blocks: DataFrame) -> DataFrame:
    """A reply to each distinct block of pages: products, one of them broken, or no JSON."""
    code = "substr(md5(block), 1, 8)"
    one = f"""concat('{{"nome":"item ', length(block), '","preco":"R$ 1.359,87","codigo":"', {code}, '"}}')"""
    two = f"""concat('{{"nome":null,"preco":12,"codigo":"', {code}, 'x"}}')"""
    reply = (
        f"CASE substr(md5(block), 9, 1) WHEN '0' THEN 'Nada encontrado' "
        f"WHEN '1' THEN concat('{{\"produtos\":[', {one}, '}}') "
        f"ELSE concat('Segue: {{\"produtos\":[', {one}, ', ', {two}, ']}} fim') END AS reply"
    )
    return blocks.select("block").distinct().selectExpr("sha2(block, 256) AS content", reply)
