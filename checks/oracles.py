"""DuckDB SQL for the registered queries, written over the given tables.

Each text is a chain of named subqueries; the last one is the checked result.
"""

from __future__ import annotations

import textwrap


def _with(*steps: tuple[str, str], result: str) -> str:
    named = ",\n".join(f"{name} AS (\n{textwrap.indent(sql.strip(), '  ')}\n)" for name, sql in steps)
    return f"WITH {named}\n{result.strip()}"


def _money(cents: str) -> str:
    return (
        f"CASE WHEN {cents} >= 100000 THEN ({cents} // 100000)::varchar || '.' || "
        f"lpad((({cents} // 100) % 1000)::varchar, 3, '0') ELSE ({cents} // 100)::varchar END "
        f"|| ',' || lpad(({cents} % 100)::varchar, 2, '0')"
    )


def _round2(value: str) -> str:
    """Half up on the decimal text, as Spark rounds doubles."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,20)), 2) AS DOUBLE)"


# --- inputs -----------------------------------------------------------------

LISTINGS = (
    "listings",
    f"""
SELECT
  CASE WHEN pct = 0 THEN NULL WHEN k % 19 = 0 THEN pct::varchar || '% OFF'
       WHEN k % 37 = 0 THEN '0.' || lpad(pct::varchar, 2, '0')
       ELSE pct::varchar || '%' END AS desconto,
  CASE WHEN line = 7 AND qty = 1 THEN NULL ELSE code END AS codigo,
  'Console ' || p_name || CASE p_size % 4 WHEN 0 THEN ' 32GB' WHEN 1 THEN ' 64 gb'
       WHEN 2 THEN ' Oled 64Gb' ELSE '' END AS nome,
  CASE WHEN k % 17 = 0 THEN 'indisponivel'
       WHEN k % 13 = 0 THEN (cents // 100)::varchar || '.' || lpad((cents % 100)::varchar, 2, '0')
       ELSE 'R$ ' || {_money('cents')} END AS preco,
  CASE WHEN line = 2 THEN NULL WHEN k % 23 = 0 THEN 'em breve'
       ELSE line::varchar || CASE WHEN k % 41 = 0 THEN 'X' ELSE 'x' END || ' de R$ ' ||
            {_money('(cents // line)')} || ' sem juros' END AS parcelamento,
  CASE WHEN k % 29 = 0 THEN '/p/' || code
       ELSE 'https://www.' || shop || '.com.br/p/' || code END AS link,
  CASE WHEN k % 43 = 0 THEN NULL ELSE shop END AS origem,
  CASE WHEN k % 31 = 0 THEN strftime(l_shipdate, '%Y/%m/%d %H:%M')
       ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M') END AS extract
FROM (
  SELECT l_orderkey AS k, l_linenumber AS line, l_quantity AS qty, p_size, p_name, l_shipdate,
         round(l_discount * 100)::int AS pct,
         round(p_retailprice * 100)::bigint + 100 * l_quantity::bigint AS cents,
         (100000000 + l_partkey)::varchar AS code,
         'loja' || (l_suppkey % 5)::varchar AS shop
  FROM lineitem JOIN part ON p_partkey = l_partkey
)""",
)

_RAW_EVENT_SELECT = """
SELECT
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE (event_id % 10)::varchar || '%' END AS desconto,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id::varchar END AS codigo,
  'item ' || event_type AS nome,
  event_type AS preco,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE (event_id % 2)::varchar END AS parcelamento,
  'https://www.loja.com.br/p/' || event_id::varchar AS link,
  'loja' || (user_id % 5)::varchar AS origem,
  strftime(ts, '%Y-%m-%d %H:%M') AS extract,
  CASE WHEN event_id % 59 = 0 THEN NULL ELSE ts + to_seconds((event_id % 20)::int) END
    AS EventProcessedUtcTime,
  CASE WHEN event_id % 53 = 0 THEN NULL ELSE event_id % 10 END AS PartitionId,
  ts AS EventEnqueuedUtcTime
FROM events"""

EVENTS = ("typed", _RAW_EVENT_SELECT)

SILVER = (
    "silver",
    r"""
SELECT codigo, nome,
  coalesce(CASE WHEN regexp_matches(preco, '^R\$?\s?\d{1,3}(\.\d{3})*(,\d{2})?$')
       THEN TRY_CAST(replace(replace(replace(preco, 'R$', ''), '.', ''), ',', '.') AS DOUBLE)
       ELSE TRY_CAST(preco AS DOUBLE) END, 0.0) AS preco,
  coalesce(CASE WHEN regexp_full_match(desconto, '\d+%')
       THEN TRY_CAST(rtrim(desconto, '%') AS DOUBLE) / 100
       ELSE TRY_CAST(desconto AS DOUBLE) END, 0.0) AS desconto,
  CASE WHEN parcelamento IS NULL THEN 0
       ELSE TRY_CAST(regexp_extract(parcelamento, '(\d+)x', 1) AS BIGINT) END AS numero_parcelas,
  CASE WHEN parcelamento IS NULL THEN 0.0
       ELSE TRY_CAST(replace(regexp_extract(parcelamento, 'R\$ (\d+,\d{2})', 1), ',', '.') AS DOUBLE)
       END AS valor_prestacao,
  origem, link,
  coalesce(nullif(upper(regexp_extract(nome, '(?i)\d+\s*gb')), ''), '-') AS memoria,
  CASE WHEN nome ILIKE '%oled%' THEN 'Sim' ELSE 'Nao' END AS oled,
  try_strptime(extract, '%Y-%m-%d %H:%M') AS extract
FROM listings WHERE codigo IS NOT NULL""",
)

CDI_PCT = 10.5

BREAKDOWN = (
    "breakdown",
    f"""
SELECT *,
  {_round2('preco - preco_desconto')} AS save_desconto,
  CASE WHEN (preco - preco_parcelado) * (1 + {CDI_PCT}::double / 100) <= 0 THEN 0.0
       ELSE {_round2(f'(preco - preco_parcelado) * (1 + {CDI_PCT}::double / 100)')} END AS save_parcelado,
  {_round2('100.0::double - preco_parcelado / nullif(preco, 0) * 100')} AS pct_preco_parcelado
FROM (
  SELECT *,
    {_round2('preco - preco * desconto')} AS preco_desconto,
    {_round2('valor_prestacao * numero_parcelas')} AS preco_parcelado
  FROM silver
)""",
)


def _gold(discount: str = "desconto") -> tuple[str, str]:
    return (
        "gold",
        f"""
SELECT *, CASE WHEN {discount} < pct_preco_parcelado THEN 'Comprar Parcelado'
  WHEN {discount} > pct_preco_parcelado THEN 'Comprar a Vista Pix'
  ELSE 'Sem Vantagem Identificada' END AS recomendacao
FROM breakdown""",
    )


GOLD = _gold()

GOLD_COLUMNS = (
    "codigo, nome, preco, desconto, numero_parcelas, valor_prestacao, origem, link, memoria, oled, "
    "extract, recomendacao"
)

_TO_SILVER = (LISTINGS, SILVER)
_TO_GOLD = (LISTINGS, SILVER, BREAKDOWN, GOLD)

CURRENT = (
    "actual",
    """
SELECT DISTINCT ON (codigo) codigo, nome, origem, memoria, oled, recomendacao, link
FROM gold
ORDER BY codigo, extract DESC NULLS LAST, nome DESC NULLS LAST, origem DESC NULLS LAST,
  memoria DESC NULLS LAST, oled DESC NULLS LAST, recomendacao DESC NULLS LAST,
  link DESC NULLS LAST""",
)

OFFERS = (
    "offers",
    """
SELECT a.codigo, a.nome, a.origem, g.preco, a.oled, a.link, a.recomendacao
FROM gold g, actual a
WHERE g.codigo = a.codigo AND a.oled = 'Sim' AND a.origem IS NOT NULL""",
)

MASK = (
    "CASE WHEN length(codigo) = 0 THEN '' ELSE left(codigo, 2) || "
    "repeat('*', greatest(length(codigo) - 4, 0)) || right(codigo, 2) END"
)
HOST = r"regexp_extract(link, '^(.*?\.com)', 1)"

SUGGESTION = f"""
SELECT {MASK} AS codigo, preco AS menor_preco, recomendacao, origem, {HOST} AS link
FROM (SELECT DISTINCT ON (origem) * FROM offers
      ORDER BY origem, preco, codigo, nome, oled, link, recomendacao)"""

# --- consumer ---------------------------------------------------------------

COUNTS = (
    "counts",
    """
SELECT codigo, parcelamento, preco, count(codigo) AS "COUNT_codigo",
  time_bucket(INTERVAL '6 hours', EventEnqueuedUtcTime, TIMESTAMP '1970-01-01') + INTERVAL '6 hours'
    AS "Window_End_Time"
FROM typed GROUP BY ALL""",
)

MATCHES = (
    "matches",
    """
SELECT l.*, r.parcelamento AS r_parcelamento, r.preco AS r_preco, r."COUNT_codigo",
  r."Window_End_Time"
FROM typed l JOIN counts r ON l.codigo = r.codigo
 AND abs(floor(epoch(r."Window_End_Time")) - floor(epoch(l.EventEnqueuedUtcTime))) <= 21600""",
)

LISTING_COLUMNS = "desconto, codigo, nome, preco, parcelamento, link, origem, extract"

# One scrape of each advert, the earliest by text.
ARRIVED = (
    "arrived",
    """
SELECT * FROM listings QUALIFY row_number() OVER (PARTITION BY codigo, preco, desconto, parcelamento
  ORDER BY extract NULLS FIRST, nome NULLS FIRST, link NULLS FIRST, origem NULLS FIRST) = 1""",
)

# --- operational tables -----------------------------------------------------


def _workspace(key: str) -> str:
    return f"CASE WHEN {key} % 5 = 0 THEN 'w2' ELSE 'w1' END AS workspace_id"


CLUSTERS = (
    "own_clusters",
    f"""
SELECT * FROM (
  SELECT {_workspace('o_orderkey')}, 'c' || o_custkey::varchar AS cluster_id,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL
         WHEN o_orderkey % 3 = 0 THEN 'job-' || o_orderkey::varchar
         ELSE 'dev-' || o_custkey::varchar END AS cluster_name,
    o_orderdate AS create_time,
    o_orderdate + to_days((o_orderkey % 30)::int) AS change_time,
    o_orderpriority AS driver_node_type, o_orderstatus AS worker_node_type,
    '1' || (o_orderkey % 6)::varchar || '.x' AS dbr_version,
    CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'SINGLE' END AS data_security_mode
  FROM orders
) WHERE workspace_id = 'w1'""",
)

SHOWN_CLUSTERS = (
    "shown",
    """
SELECT * FROM (
  SELECT *, max(create_time) OVER () AS newest,
    (SELECT count(*) FROM (SELECT cluster_id FROM own_clusters GROUP BY 1)) AS known
  FROM own_clusters
)
WHERE left(cluster_name, 3) <> 'job' OR (left(cluster_name, 3) = 'job' AND create_time = newest)""",
)

USAGE = (
    "own_usage",
    f"""
SELECT * FROM (
  SELECT {_workspace('l_orderkey')},
    CASE WHEN l_orderkey % 29 = 0 THEN NULL WHEN l_orderkey % 10 = 3 THEN p_type || ' spot'
         ELSE p_type || p_size::varchar END AS sku_name,
    (l_quantity + l_discount)::decimal(18,4) AS usage_quantity, l_shipdate AS usage_end_time
  FROM lineitem JOIN part ON p_partkey = l_partkey
) WHERE workspace_id = 'w1'""",
)

LIST_PRICES = (
    "newest_prices",
    """
SELECT sku_name, price, price_start_time FROM (
  SELECT DISTINCT p_type || p_size::varchar AS sku_name, p_retailprice::decimal(18,4) AS price,
    date_trunc('year', l_shipdate)::timestamp AS price_start_time
  FROM lineitem JOIN part ON p_partkey = l_partkey
) QUALIFY dense_rank() OVER (PARTITION BY sku_name ORDER BY price_start_time DESC) = 1""",
)

COSTS = (
    "costs",
    """
SELECT sku_name, CAST(sum(usage_quantity * price) AS FLOAT) AS total_cost_cluster
FROM own_usage NATURAL LEFT JOIN newest_prices GROUP BY sku_name""",
)

RUNS = (
    "live_runs",
    """
SELECT task_key, result_state
FROM (
  SELECT 'j' || user_id::varchar AS job_id, 'task' || (event_id % 17)::varchar AS task_key,
    CASE WHEN event_type = 'view' THEN 'SUCCEEDED' WHEN event_type = 'signup' THEN 'FAILED'
         WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'purchase' THEN 'TIMED_OUT'
         WHEN event_id % 3 = 0 THEN 'SKIPPED' WHEN event_id % 3 = 1 THEN 'RUNNING' END
      AS result_state,
    ts - to_days(((event_id % 4) * 3650)::int) AS period_start_time
  FROM events
) r, (
  SELECT min(o_orderdate) AS first_change,
    max(CASE WHEN o_orderkey % 50 = 0 AND o_orderdate < TIMESTAMP '2001-06-01'
             THEN o_orderdate + INTERVAL 10 DAY END) + INTERVAL 1 MINUTE AS last_delete
  FROM orders
) b
WHERE r.period_start_time > b.first_change
  AND EXISTS (SELECT 1 FROM orders o WHERE 'j' || o.o_custkey::varchar = r.job_id
              AND o.o_orderdate > b.last_delete)""",
)

LINEAGE = (
    "actions",
    """
SELECT s || '.' || unnest([CASE WHEN event_id % 7 <> 0 THEN 't' || (user_id % 20)::varchar END,
    CASE WHEN event_id % 5 <> 0 AND event_id % 9 <> 0 THEN 'm' || (user_id % 7)::varchar END]) AS "table",
  unnest(['leitura', 'escrita']) AS "type"
FROM (SELECT *, CASE WHEN event_id % 31 <> 0 THEN event_type END AS s FROM events)
WHERE event_id % 13 <> 0""",
)

# --- replies ----------------------------------------------------------------

_CODE = "(100000000 + p_partkey)::varchar"
_FIRST = (
    f"""'{{"nome":"' || p_name || '","preco":"R$ 1.359,87","link":"/p/' || {_CODE} || """
    f"""'","codigo":"' || {_CODE} || '","desconto":null,"parcelamento":"10x de R$ 149,90"}}'"""
)
_SPACED = (
    """'{' || chr(10) || '  "nome": "' || p_name || ' ção",' || chr(10) || '  "preco": ' || """
    f"""p_size::varchar || ',' || chr(10) || '  "codigo": "' || {_CODE} || '"' || chr(10) || '}}'"""
)

REPLIES = (
    "replies",
    f"""
SELECT p_partkey, CASE p_partkey % 9
  WHEN 0 THEN 'Segue: {{"produtos":[' || {_FIRST} || ']}} fim'
  WHEN 1 THEN 'Claro!' || chr(10) || '{{ "produtos": [' || chr(10) || {_SPACED} || ' ] }}'
              || chr(10) || 'Até logo'
  WHEN 2 THEN 'Nada encontrado para ' || p_name
  WHEN 3 THEN '{{"produtos":[' || {_FIRST} || '}}'
  WHEN 4 THEN '{{"itens":[]}}'
  WHEN 5 THEN '{{"produtos":[' || {_FIRST} || ', ' || {_SPACED} || ']}}'
  WHEN 6 THEN '{{"produtos":[' || {_FIRST} || ']}} {{"x": 1}}'
  WHEN 7 THEN '{{"produtos":[' || {_FIRST} || '],"a":{{"b":{{"c":1}}}}}}'
  ELSE '{{"produtos":"nada"}}' END AS reply
FROM part""",
)
SPANS = (
    "spans",
    r"SELECT p_partkey, regexp_extract(reply, '(?s)\{.*\}') AS span FROM replies",
)
REPAIRED = (
    "repaired",
    "SELECT p_partkey, span, replace(replace('{' || span || '}', '{{', '{'), '}}', '}') AS json "
    "FROM spans",
)
PRODUCTS_IN = (
    "found",
    """
SELECT p_partkey, unnest(CASE WHEN json_valid(json) AND json_type(json, '$.produtos') = 'ARRAY'
  THEN json_extract(json, '$.produtos[*]') ELSE [] END) AS p
FROM repaired WHERE span <> ''""",
)
_FIELDS = ", ".join(
    f"p->>'$.{c}' AS {c}" for c in ("desconto", "codigo", "nome", "preco", "parcelamento", "link")
)


def _rules(source: str, rules: list[tuple[str, str]]) -> str:
    parts = [
        f"SELECT '{name}' AS expectation, count(*) FILTER ({test}) AS passed_records, "
        f"count(*) - count(*) FILTER ({test}) AS failed_records FROM {source}"
        for name, test in rules
    ]
    return "\nUNION ALL\n".join(parts)


_SILVER_KINDS = [
    ("codigo", "string"), ("nome", "string"), ("preco", "double"), ("desconto", "double"),
    ("numero_parcelas", "bigint"), ("valor_prestacao", "double"), ("origem", "string"),
    ("link", "string"), ("memoria", "string"), ("oled", "string"), ("extract", "timestamp"),
]
_GOLD_KINDS = [*_SILVER_KINDS, ("recomendacao", "string")]
_RAW = LISTING_COLUMNS.split(", ")


def _suite(dataset: str, source: str, columns: list[str], nulls: bool) -> str:
    names = sorted(columns)
    rows = [
        f"SELECT '{dataset}' AS dataset, 'table_exists' AS \"check\", true AS passed, 'found' AS detail",
        f"SELECT '{dataset}', 'columns', true, '{','.join(names)}'",
        f"SELECT '{dataset}', 'types', true, ''",
        f"SELECT '{dataset}', 'not_empty', count(*) > 0, count(*)::varchar FROM {source}",
    ]
    if nulls:
        rows += [
            f"SELECT '{dataset}', 'no_nulls:{c}', count({c}) = count(*), "
            f"(count(*) - count({c}))::varchar FROM {source}"
            for c in names
        ]
    return "\nUNION ALL\n".join(rows)


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # sources and sinks: what was written is what was given
    rows = f"SELECT {LISTING_COLUMNS} FROM listings"
    for key in ("s1_listing_stream", "s2_listing_batch"):
        sql[key] = _with(LISTINGS, result=rows)
    sql["k1_write_inbound"] = _with(
        EVENTS,
        result=f"SELECT {LISTING_COLUMNS}, strftime(EventEnqueuedUtcTime, '%Y-%m-%d_%H') AS folder "
        "FROM typed",
    )
    sql["k1_null_keys"] = _with(
        EVENTS,
        result="""SELECT count(*) AS "rows", count(*) FILTER (desconto IS NULL) AS null_desconto,
  count(*) FILTER (codigo IS NULL) AS null_codigo FROM typed""",
    )
    sql["k2_flush"] = _with(
        EVENTS,
        ("lanes", "SELECT coalesce(PartitionId % 2, -1) AS lane, count(*) AS n FROM typed GROUP BY 1"),
        result="""SELECT lane, flush, 'rows' AS reason, 2000::bigint AS "rows"
FROM (SELECT lane, unnest(range(n // 2000)) AS flush FROM lanes)
UNION ALL SELECT lane, n // 2000, 'age', n % 2000 FROM lanes WHERE n % 2000 > 0""",
    )
    sql["s1_quarantine"] = _with(
        LISTINGS,
        result=f"""SELECT {LISTING_COLUMNS}, NULL::varchar AS "text" FROM listings
WHERE preco <> 'indisponivel'
UNION ALL SELECT {', '.join('NULL' for _ in _RAW)}, left(line, length(line) - 1) FROM (
  SELECT CAST(json_object('codigo', codigo, 'nome', nome, 'preco', preco, 'desconto', desconto, 'parcelamento',
    parcelamento, 'link', link, 'origem', origem, 'extract', extract) AS VARCHAR) AS line
  FROM listings WHERE preco = 'indisponivel')""",
    )
    sql["k3_stream_table"] = _with(EVENTS, result=f"SELECT {LISTING_COLUMNS} FROM typed")
    silver_rows = "SELECT * FROM silver"
    sql["k4_write_view"] = _with(*_TO_SILVER, result=silver_rows)
    sql["k4_published_view"] = sql["k4_write_view"]
    sql["k5_both_keys"] = _with(
        *_TO_SILVER,
        result="""SELECT true AS few_files, count(*) AS "rows" FROM silver
WHERE extract BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-05-01'""",
    )
    laid_out = "SELECT 0::bigint AS overlapping_files, count(*) AS \"rows\" FROM"
    sql["k5_clustered_layout"] = _with(*_TO_SILVER, result=f"{laid_out} silver")
    sql["k5_gold_layout"] = _with(*_TO_GOLD, result=f"{laid_out} gold")
    sql["k6_product_events"] = _with(
        LISTINGS,
        result="""SELECT codigo AS "key", CAST(json_object('codigo', codigo, 'nome', nome,
  'preco', preco, 'desconto', desconto, 'parcelamento', parcelamento, 'link', link,
  'origem', origem, 'extract', extract) AS VARCHAR) AS "value" FROM listings""",
    )

    # extraction
    sql["x1_html_blocks"] = """
SELECT page_id, (unnest(range(len(b))))::int AS block_index, unnest(b) AS block
FROM (SELECT page_id, regexp_extract_all(html, '(?s)<div class="ad">.*?</div>') AS b FROM pages)"""
    sql["x2_reply_json_span"] = _with(REPLIES, SPANS, result="SELECT * FROM spans")
    sql["x3_brace_repair"] = _with(
        REPLIES, SPANS, REPAIRED, result="SELECT p_partkey, json FROM repaired"
    )
    sql["x4_reply_products"] = _with(
        REPLIES,
        SPANS,
        REPAIRED,
        PRODUCTS_IN,
        result="""SELECT r.p_partkey, count(f.p)::int AS products
FROM repaired r LEFT JOIN found f USING (p_partkey) GROUP BY r.p_partkey""",
    )
    sql["x5_products_from_reply"] = _with(
        REPLIES,
        SPANS,
        REPAIRED,
        PRODUCTS_IN,
        result=f"SELECT {_FIELDS}, 'loja' AS origem, '2025-10-05 19:00' AS extract FROM found",
    )

    product = """'{"codigo":"' || code || '","nome":"item ' || length(block)::varchar ||
  '","preco":"R$ 1.359,87","desconto":null,"parcelamento":null,"link":null,"origem":"loja","extract":"2025-10-05 19:00"}'"""
    other = """'{"codigo":"' || code || 'x","nome":null,"preco":"12","desconto":null,"parcelamento":null,' ||
  '"link":null,"origem":"loja","extract":"2025-10-05 19:00"}'"""
    sql["x6_page_messages"] = f"""
WITH blocks AS (
  SELECT unnest(regexp_extract_all(html, '(?s)<div class="ad">.*?</div>')) AS block FROM pages
), coded AS (SELECT block, left(md5(block), 8) AS code FROM blocks WHERE substr(md5(block), 9, 1) NOT IN ('0', '1'))
SELECT code AS "key", {product} AS "value" FROM coded
UNION ALL SELECT code || 'x', {other} FROM coded"""

    # consumer
    sql["c1_typed_events"] = _with(EVENTS, result="SELECT * FROM typed")
    sql["c1_strict_discount"] = _with(
        EVENTS, result="SELECT * REPLACE (NULL::varchar AS desconto) FROM typed"
    )
    sql["c3_adjusted_lateness"] = _with(
        EVENTS,
        result="""SELECT link, greatest(EventEnqueuedUtcTime,
  EventProcessedUtcTime - INTERVAL 5 SECOND) AS EventEnqueuedUtcTime FROM typed""",
    )
    sql["c3_adjusted_stream"] = sql["c3_adjusted_lateness"]
    sql["c3_out_of_order"] = _with(
        EVENTS,
        (
            "adjusted",
            """SELECT link, PartitionId, EventProcessedUtcTime AS arrived,
  greatest(EventEnqueuedUtcTime, EventProcessedUtcTime - INTERVAL 5 SECOND) AS moved FROM typed""",
        ),
        result="""SELECT link, CASE WHEN moved IS NOT NULL THEN max(moved) OVER (PARTITION BY PartitionId
  ORDER BY arrived NULLS FIRST, moved NULLS FIRST ROWS UNBOUNDED PRECEDING) END AS EventEnqueuedUtcTime FROM adjusted""",
    )
    sql["c3_out_of_order_stream"] = sql["c3_out_of_order"]
    sql["c4_passthrough"] = _with(EVENTS, result="SELECT * FROM typed")
    sql["c5_tumbling_count"] = _with(EVENTS, COUNTS, result="SELECT * FROM counts")
    matched = f"""SELECT {', '.join(f'{c} AS left_{c}' for c in _RAW)},
  EventProcessedUtcTime AS "left_EventProcessedUtcTime", PartitionId AS "left_PartitionId",
  EventEnqueuedUtcTime AS "left_EventEnqueuedUtcTime", codigo AS right_codigo,
  r_parcelamento AS right_parcelamento, r_preco AS right_preco,
  "COUNT_codigo" AS "right_COUNT_codigo", "Window_End_Time" AS "right_Window_End_Time"
FROM matches"""
    sql["c6_interval_join"] = _with(EVENTS, COUNTS, MATCHES, result=matched)
    sql["c7_singletons"] = _with(
        EVENTS, COUNTS, MATCHES, result=f'{matched} WHERE "COUNT_codigo" = 1'
    )
    out = f'SELECT {LISTING_COLUMNS} FROM matches WHERE "COUNT_codigo" = 1'
    sql["c8_listing_columns"] = _with(EVENTS, COUNTS, MATCHES, result=out)
    sql["c9_singleton_consumer"] = _with(EVENTS, COUNTS, MATCHES, result=out)
    sql["c9_singleton_consumer_stream"] = _with(
        EVENTS,
        COUNTS,
        MATCHES,
        result=out + ' AND "Window_End_Time" <= (SELECT max(ts) - INTERVAL 5 SECOND FROM events)',
    )

    sql["c9_heartbeat_stream"] = sql["c9_singleton_consumer"]

    # dedup
    sql["b1_stream_dedup"] = _with(
        EVENTS, result="SELECT DISTINCT codigo, preco, desconto, parcelamento FROM typed"
    )
    sql["b1_key_store"] = sql["b1_stream_dedup"]
    sql["b2_batch_dedup"] = _with(
        LISTINGS,
        result=f"""SELECT {LISTING_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY codigo, nome, preco, desconto, parcelamento
    ORDER BY link NULLS FIRST, origem NULLS FIRST, extract NULLS FIRST) AS n FROM listings
) WHERE n = 1""",
    )
    sql["b3_bronze_ingest"] = _with(LISTINGS, ARRIVED, result=f"SELECT {LISTING_COLUMNS} FROM arrived")

    # cleaning, one step at a time
    kept = "SELECT * FROM listings WHERE codigo IS NOT NULL"
    sql["v1_known_codes"] = _with(LISTINGS, result=f"SELECT {LISTING_COLUMNS} FROM ({kept})")

    per_step = {
        "v2_scrape_time": "extract AS raw, try_strptime(extract, '%Y-%m-%d %H:%M') AS extract",
        "v3_instalment_count": r"""parcelamento AS raw, CASE WHEN parcelamento IS NULL THEN 0 ELSE
  TRY_CAST(regexp_extract(parcelamento, '(\d+)x', 1) AS BIGINT) END AS numero_parcelas""",
        "v4_instalment_value": r"""parcelamento AS raw, CASE WHEN parcelamento IS NULL THEN 0.0 ELSE
  TRY_CAST(replace(regexp_extract(parcelamento, 'R\$ (\d+,\d{2})', 1), ',', '.') AS DOUBLE)
  END AS valor_prestacao""",
        "v5_discount_fraction": r"""desconto AS raw, coalesce(CASE
  WHEN regexp_full_match(desconto, '\d+%') THEN TRY_CAST(rtrim(desconto, '%') AS DOUBLE) / 100
  ELSE TRY_CAST(desconto AS DOUBLE) END, 0.0) AS desconto""",
        "v6_price_brl": r"""preco AS raw, coalesce(CASE
  WHEN regexp_matches(preco, '^R\$?\s?\d{1,3}(\.\d{3})*(,\d{2})?$')
  THEN TRY_CAST(replace(replace(replace(preco, 'R$', ''), '.', ''), ',', '.') AS DOUBLE)
  ELSE TRY_CAST(preco AS DOUBLE) END, 0.0) AS preco""",
        "v7_memory_label": r"""nome AS raw,
  coalesce(nullif(upper(regexp_extract(nome, '(?i)\d+\s*gb')), ''), '-') AS memoria""",
        "v8_oled_flag": "nome AS raw, CASE WHEN nome ILIKE '%oled%' THEN 'Sim' ELSE 'Nao' END AS oled",
    }
    for key, columns in per_step.items():
        sql[key] = _with(LISTINGS, result=f"SELECT codigo, {columns} FROM listings")
    sql["v9_silver_columns"] = _with(
        *_TO_SILVER,
        result="SELECT codigo, nome, origem, link, memoria, oled FROM silver",
    )
    sql["v10_silver_clean"] = _with(*_TO_SILVER, result=silver_rows)

    # advice
    to_breakdown = (LISTINGS, SILVER, BREAKDOWN)
    base = "codigo, preco, desconto, numero_parcelas, valor_prestacao"
    for key, column in {
        "g1_cash_price": "preco_desconto",
        "g2_instalment_total": "preco_parcelado",
        "g3_cash_saving": "save_desconto",
        "g4_instalment_saving": "save_parcelado",
        "g5_instalment_discount_pct": "pct_preco_parcelado",
    }.items():
        sql[key] = _with(*to_breakdown, result=f"SELECT {base}, {column} FROM breakdown")
    sql["g6_advice"] = _with(
        *_TO_GOLD,
        result="SELECT recomendacao, count(*) AS n FROM gold GROUP BY recomendacao",
    )
    sql["g6_advice_normalized"] = _with(
        *to_breakdown,
        _gold("desconto * 100"),
        result="SELECT recomendacao, count(*) AS n FROM gold GROUP BY recomendacao",
    )
    sql["g7_unknown_rate"] = _with(
        *to_breakdown,
        result=f"SELECT {base}, NULL::double AS save_parcelado FROM breakdown",
    )
    sql["g8_helpers_dropped"] = _with(*_TO_GOLD, result=f"SELECT {GOLD_COLUMNS} FROM gold")
    sql["g9_gold_recommendation"] = sql["g8_helpers_dropped"]

    # marts
    to_current = (*_TO_GOLD, CURRENT)
    to_offers = (*to_current, OFFERS)
    sql["n1_detalhes"] = _with(
        *to_current, result="SELECT codigo, memoria, oled, recomendacao, link FROM actual"
    )
    sql["n2_produtos"] = _with(*to_current, result="SELECT codigo, nome, origem FROM actual")
    history = """SELECT codigo, preco, numero_parcelas, valor_prestacao, desconto,
  extract AS "data" FROM gold"""
    sql["n3_precos"] = _with(*_TO_GOLD, result=history)
    sql["n4_precos_ordered"] = _with(
        *_TO_GOLD,
        result=f"""SELECT row_number() OVER (ORDER BY preco, codigo, "data" NULLS FIRST, numero_parcelas NULLS FIRST,
  valor_prestacao NULLS FIRST, desconto) - 1 AS place, * FROM ({history})""",
    )
    for key, columns in {
        "n4_detalhes_ordered": "codigo, memoria, oled, recomendacao, link",
        "n4_produtos_ordered": "codigo, nome, origem",
    }.items():
        sql[key] = _with(
            *to_current,
            result=f"SELECT row_number() OVER (ORDER BY codigo) - 1 AS place, {columns} FROM actual",
        )
    sql["m1_offer_join"] = _with(
        *to_current,
        result="""SELECT g.codigo, a.nome, a.origem, g.preco, a.oled, a.link, a.recomendacao
FROM gold g JOIN actual a ON g.codigo = a.codigo""",
    )
    sql["m2_oled_offers"] = _with(
        *to_current,
        result="""SELECT g.codigo, a.nome, a.origem, g.preco, a.link, a.recomendacao
FROM gold g JOIN actual a ON g.codigo = a.codigo WHERE a.oled = 'Sim'""",
    )
    sql["m3_known_marketplace"] = _with(*to_offers, result="SELECT * FROM offers")
    sql["m4_mask_code"] = _with(
        LISTINGS, result=f"SELECT codigo AS raw, {MASK} AS codigo FROM listings"
    )
    sql["m5_link_host"] = _with(LISTINGS, result=f"SELECT link AS raw, {HOST} AS link FROM listings")
    sql["m6_top1_by_marketplace"] = _with(
        *to_offers,
        result="""SELECT origem, min(preco) AS menor_preco FROM offers GROUP BY origem""",
    )
    sql["m7_sugestion"] = _with(*to_offers, result=SUGGESTION)
    sql["m7_sugestion_from_gold"] = sql["m7_sugestion"]

    # reports
    shown = (CLUSTERS, SHOWN_CLUSTERS)
    sql["r1_cluster_inventory"] = _with(
        *shown, result="SELECT cluster_id, known AS distinct_cluster_id_count FROM shown"
    )
    sql["r2_current_clusters"] = _with(
        *shown, result="SELECT cluster_id, cluster_name, create_time FROM shown"
    )
    sql["r3_total_usage"] = _with(
        USAGE,
        result="""SELECT CAST(round(CAST(CAST(sum(usage_quantity) AS FLOAT) AS DOUBLE), 2) AS FLOAT)
  AS total_usage_quantity FROM own_usage""",
    )
    sql["r4_daily_cpu_peak"] = _with(
        *shown,
        result="""SELECT cluster_id, ts::date AS start_time, max(value) AS max_cpu_user_percent
FROM (SELECT *, 'c' || user_id::varchar AS cluster_id FROM events WHERE event_id % 5 <> 0)
SEMI JOIN shown USING (cluster_id) GROUP BY ALL""",
    )
    sql["r5_latest_prices"] = _with(
        LIST_PRICES,
        result="""SELECT sku_name, CAST(price AS DOUBLE) AS "default",
  price_start_time::date AS price_start_date FROM newest_prices""",
    )
    sql["r6_total_cost"] = _with(
        USAGE,
        LIST_PRICES,
        result="""SELECT CAST(sum(usage_quantity * price) AS FLOAT) AS total_cost_cluster
FROM own_usage JOIN newest_prices USING (sku_name)""",
    )
    sql["r7_cost_by_sku"] = _with(USAGE, LIST_PRICES, COSTS, result="SELECT * FROM costs")
    sql["r8_daily_usage"] = _with(
        USAGE,
        result="""SELECT usage_end_time::date AS usage_end_date,
  CAST(round(CAST(CAST(sum(usage_quantity) AS FLOAT) AS DOUBLE), 2) AS FLOAT) AS total_dbu_usage
FROM own_usage WHERE usage_end_time::date >= DATE '2001-06-24' GROUP BY usage_end_date""",
    )
    sql["r9_cluster_listing"] = _with(
        *shown,
        result="""SELECT cluster_name, create_time, change_time, driver_node_type, worker_node_type,
  dbr_version, data_security_mode FROM shown""",
    )
    sql["r10_run_outcomes"] = _with(
        RUNS,
        result="""SELECT CASE WHEN result_state = 'SUCCEEDED' THEN 'SUCCESS'
  WHEN result_state IN ('ERROR', 'FAILED', 'SKIPPED') THEN 'ERROR'
  WHEN result_state = 'TIMED_OUT' THEN 'TIMED_OUT' ELSE 'OTHER' END AS result_state,
  count(*) AS total_count FROM live_runs GROUP BY 1""",
    )
    sql["r11_active_runs"] = _with(RUNS, result="SELECT task_key, result_state FROM live_runs")
    sql["r12_errors_by_task"] = _with(
        RUNS,
        result="""SELECT task_key, count(*) AS error_count FROM live_runs
WHERE result_state IN ('ERROR', 'FAILED', 'SKIPPED') GROUP BY task_key""",
    )
    sql["r13_lineage_totals"] = _with(
        LINEAGE,
        result="""SELECT "type", count(*) AS total_count FROM actions
WHERE starts_with("table", 'p') GROUP BY "type\"""",
    )
    sql["r14_lineage_by_table"] = _with(
        LINEAGE,
        result="""SELECT "table", "type", count(*) AS total_count FROM actions
WHERE starts_with("table", 'p') GROUP BY ALL""",
    )

    # quality
    sql["e1_bronze_rules"] = _with(
        LISTINGS,
        result=_rules(
            "listings",
            [
                ("required_columns", "codigo IS NOT NULL AND preco IS NOT NULL"),
                ("extract_format", r"regexp_full_match(extract, '\d{4}-\d{2}-\d{2} \d{2}:\d{2}')"),
            ],
        ),
    )
    sql["e0_streamed_rules"] = _with(
        LISTINGS,
        ARRIVED,
        result=_rules(
            "arrived",
            [
                ("required_columns", "codigo IS NOT NULL AND preco IS NOT NULL"),
                ("extract_format", r"coalesce(regexp_full_match(extract, '\d{4}-\d{2}-\d{2} \d{2}:\d{2}'), false)"),
            ],
        ),
    )
    sql["e2_silver_rules"] = _with(
        *_TO_SILVER,
        result=_rules("silver", [(f"{c}_{k}_not_null", f"{c} IS NOT NULL") for c, k in _SILVER_KINDS]),
    )
    sql["e3_gold_rules"] = _with(
        *_TO_GOLD,
        result=_rules("gold", [("recomendacao_string_not_null", "recomendacao IS NOT NULL")]),
    )
    sql["q4_null_counts"] = _with(
        LISTINGS,
        result="\nUNION ALL\n".join(
            f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM listings" for c in _RAW
        ),
    )
    sql["q6_bronze_suite"] = _with(LISTINGS, result=_suite("bronze.listings", "listings", _RAW, True))
    sql["q6_silver_suite"] = _with(
        *_TO_SILVER,
        result=_suite("silver.listings", "silver", [c for c, _ in _SILVER_KINDS], False),
    )
    sql["q6_gold_suite"] = _with(
        *_TO_GOLD,
        result=_suite("gold.recommendations", "gold", [c for c, _ in _GOLD_KINDS], False),
    )
    sql["p1_refresh"] = _with(
        EVENTS,
        COUNTS,
        MATCHES,
        (
            "listings",
            """SELECT DISTINCT codigo, preco, desconto, parcelamento, NULL::varchar AS nome,
  NULL::varchar AS origem, NULL::varchar AS link, NULL::varchar AS extract
FROM matches WHERE "COUNT_codigo" = 1""",
        ),
        SILVER,
        BREAKDOWN,
        GOLD,
        result="""
SELECT 'bronze' AS layer, codigo, NULL AS preco, NULL AS numero_parcelas, NULL AS valor_prestacao, NULL AS desconto,
  NULL AS recomendacao FROM listings
UNION ALL SELECT l, codigo, preco, numero_parcelas, valor_prestacao, desconto, NULL
  FROM silver, (SELECT unnest(['silver', 'precos']) AS l)
UNION ALL SELECT 'gold', codigo, preco, numero_parcelas, valor_prestacao, desconto, recomendacao FROM gold
UNION ALL SELECT l, codigo, NULL, NULL, NULL, NULL, NULL
  FROM (SELECT DISTINCT codigo FROM silver), (SELECT unnest(['detalhes', 'produtos']) AS l)""",
    )
    sql["p3_marts_merge"] = _with(
        *_TO_GOLD,
        CURRENT,
        result="""SELECT a.codigo, a.nome, a.origem, a.memoria, a.oled, a.recomendacao, a.link, g.menor_preco
FROM actual a JOIN (SELECT codigo, min(preco) AS menor_preco FROM gold GROUP BY codigo) g USING (codigo)""",
    )
    sql["p2_refresh_incremental"] = sql["p1_refresh"]
    wrong = sorted(c for c, _ in _SILVER_KINDS if c != "oled")
    right = sorted(c for c, _ in _SILVER_KINDS)
    sql["q6_failing_tables"] = _with(
        *_TO_SILVER,
        result=f"""SELECT 'missing' AS dataset, 'table_exists' AS "check", false AS passed, 'missing' AS detail
UNION ALL SELECT 'wrong', 'table_exists', true, 'found'
UNION ALL SELECT 'wrong', 'columns', false, '{",".join(wrong)}'
UNION ALL SELECT 'wrong', 'types', false, 'oled,preco'
UNION ALL SELECT 'wrong', 'not_empty', count(*) > 0, count(*)::varchar FROM silver
UNION ALL SELECT 'empty', 'table_exists', true, 'found'
UNION ALL SELECT 'empty', 'columns', true, '{",".join(right)}'
UNION ALL SELECT 'empty', 'types', true, ''
UNION ALL SELECT 'empty', 'not_empty', false, '0'""",
    )
    return sql
