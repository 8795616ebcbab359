"""All registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Timestamps leave as zone-less ones, so they compare with DuckDB's plain TIMESTAMP.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from checks import adapters
from checks.oracles import CDI_PCT
from vitrine import fixed_values as fixed
from vitrine import schemas
from vitrine.functions import listing as lst
from vitrine.operators import quality, replies
from vitrine.operators.dedup import dedup, dedup_latest
from vitrine.operators.html import html_blocks
from vitrine.plans import layers, marts, merged, reports
from vitrine.plans.refresh import Names, refresh
from vitrine.session import configure, scratch_dir, settings
from vitrine.sinks.inbound import write_inbound
from vitrine.sinks.tables import (
    clustered,
    clustered_on_each,
    files_of_range,
    overlapping_files,
    write_stream_table,
    write_view,
)
from vitrine.sinks.versions import publish_view
from vitrine.sources.events import beats, event_stream, type_events, with_event_time, with_heartbeat
from vitrine.sources.listings import (
    checked_stream,
    dataset,
    good_listings,
    listing_batch,
    listing_stream,
    quarantine,
    write_checked,
)
from vitrine.streaming import consumer
from vitrine.streaming.extraction import page_messages
from vitrine.streaming.flush import flushed, write_flushed
from vitrine.streaming.ingest import bronze_ingest
from vitrine.streaming.keystore import KeyStore, dedup_stream
from vitrine.streaming.rulelog import log_rules, logged

Query = Callable[[SparkSession, str], DataFrame]

W = adapters.WORKSPACE
LINEAGE_PREFIX = "p"
AS_OF = dt.date(2001, 7, 1)
# Events of one code lie hours apart in the given table.
WINDOW_S = 6 * 3600
ADVICE_INPUT = ["codigo", "preco", "desconto", "numero_parcelas", "valor_prestacao"]


def _plain(df: DataFrame) -> DataFrame:
    """Zoned timestamps to zone-less ones."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


# --- shared inputs ----------------------------------------------------------


def _listings(spark, sf):
    return adapters.listings(spark, sf)


def _silver(spark, sf):
    return layers.clean(_listings(spark, sf))


def _breakdown(spark, sf):
    return layers.breakdown(_silver(spark, sf), CDI_PCT)


def _gold(spark, sf):
    return layers.recommend(_silver(spark, sf), CDI_PCT)


def _events(spark, sf):
    raw = adapters.raw_events(adapters.events(spark, sf))
    return with_event_time(type_events(raw))


def _event_stream(spark, sf):
    """The events table as a stream of files, typed and with event time."""
    schema = adapters.table(spark, sf, "events").schema
    # A pattern, because the table may be one file and a stream wants a folder otherwise.
    raw = event_stream(spark, f"{sf}/events.parquet*", "parquet", schema)
    return with_event_time(type_events(adapters.raw_events(raw)))


def _run(query) -> None:
    query.awaitTermination()


def _landed(spark, sf) -> str:
    """The listings as landing files."""
    path = scratch_dir(spark, "inbound")
    rows = _listings(spark, sf).withColumn("landed", F.current_timestamp())
    write_inbound(rows, path, "landed", as_they_lie=True, compression="gzip")
    return path


def _streamed(spark, df: DataFrame, label: str) -> DataFrame:
    """Run a stream over its whole input into a Parquet folder and read that."""
    path = scratch_dir(spark, label)
    _run(
        df.writeStream.format("parquet")
        .option("checkpointLocation", scratch_dir(spark, f"{label}-checkpoint"))
        .trigger(availableNow=True)
        .start(path)
    )
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _own_database(spark) -> Iterator[str]:
    """A database of this run alone, dropped in the end.

    Its tables lie in folders of their own, so a DataFrame that has been resolved still reads
    them after that.
    """
    name = f"checks_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark, name)}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def _stored(spark, rows: DataFrame, cluster_by=()) -> DataFrame:
    with _own_database(spark) as database:
        target = f"{database}.stored"
        write_view(rows, target, "stored", cluster_by, scratch_dir(spark, "stored"))
        return dataset(spark, target)


# --- sources and sinks ------------------------------------------------------


def s1_listing_stream(spark, sf):
    return _streamed(spark, listing_stream(spark, _landed(spark, sf)), "listing-stream")


def s1_quarantine(spark, sf):
    """Listing lines of which some are cut off, sorted out by a checked stream."""
    inbound, out = scratch_dir(spark, "inbound"), scratch_dir(spark, "checked")
    line = F.to_json(F.struct(*fixed.MESSAGE_FIELDS), {"ignoreNullFields": "false"})
    broken = F.col("preco") == "indisponivel"
    cut = F.when(broken, F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)
    _listings(spark, sf).select(cut).write.text(inbound)
    _run(write_checked(checked_stream(spark, inbound), out, scratch_dir(spark, "checked-checkpoint")))
    bad = quarantine(spark, out).select(*[F.lit(None).cast("string").alias(c) for c in schemas.LISTING.names], "text")
    return good_listings(spark, out).withColumn("text", F.lit(None).cast("string")).unionByName(bad)


def s2_listing_batch(spark, sf):
    return listing_batch(spark, _landed(spark, sf))


def _inbound_of_events(spark, sf) -> str:
    path = scratch_dir(spark, "inbound")
    rows = _event_stream(spark, sf).select(*schemas.LISTING.names, consumer.EVENT_TIME)
    _run(write_inbound(rows, path, consumer.EVENT_TIME, scratch_dir(spark, "inbound-checkpoint")))
    return path


def k1_write_inbound(spark, sf):
    rows = listing_batch(spark, _inbound_of_events(spark, sf))
    folder = F.regexp_extract("_metadata.file_path", "/folder=([^/]+)/", 1)
    return rows.select(*schemas.LISTING.names, folder.alias("folder"))


def k1_null_keys(spark, sf):
    lines = spark.read.option("recursiveFileLookup", "true").text(_inbound_of_events(spark, sf))

    def null_key(name):
        return F.count_if(F.col("value").contains(f'"{name}":null')).alias(f"null_{name}")

    return lines.agg(F.count("value").alias("rows"), null_key("desconto"), null_key("codigo"))


def k2_flush(spark, sf):
    """Rows of each flush of the landing files. A thin lane waits for its age, seconds here in place of a minute."""
    path = scratch_dir(spark, "flushed")
    events = _event_stream(spark, sf).select(*schemas.LISTING.names, "PartitionId")
    lane = F.coalesce(F.col("PartitionId") % 2, F.lit(-1))
    # Folders by the hour of landing: by the hour of the event, a backlog of weeks is a file or two per hour.
    due = flushed(events.withColumn("landed", F.current_timestamp()), "landed", age_seconds=5, lane=lane)
    query = write_flushed(due, path, scratch_dir(spark, "flushed-checkpoint"), by_flush=True)
    try:
        # Timers keep the stream going; it is done when all rows have landed.
        expected = adapters.events(spark, sf).count()
        landed, deadline = 0, time.monotonic() + 300
        while (now := _lines(spark, path).count()) < expected:
            # A large backlog is one long trigger: only a stream that stands still has failed.
            if now > landed or not query.recentProgress:
                landed, deadline = now, time.monotonic() + 300
            if query.exception() is not None or time.monotonic() > deadline:
                raise RuntimeError("the stream did not flush all rows") from query.exception()
            time.sleep(1)
    finally:
        query.stop()
    return _lines(spark, path).groupBy("lane", "flush", "reason").agg(F.count("*").alias("rows"))


def _lines(spark, path: str) -> DataFrame:
    """Landed lines with their folders; none as long as nothing has landed."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], "lane long, flush long, reason string")
    found = spark.read.text(path)
    if "lane" not in found.columns:
        return spark.createDataFrame([], "lane long, flush long, reason string")
    return found.select(F.col("lane").cast("long"), F.col("flush").cast("long"), "reason")


def k3_stream_table(spark, sf):
    rows = _event_stream(spark, sf).select(*schemas.LISTING.names)
    checkpoint = scratch_dir(spark, "events-checkpoint")
    with _own_database(spark) as database:
        target = f"{database}.events"
        _run(write_stream_table(rows, target, checkpoint, scratch_dir(spark, "events")))
        return dataset(spark, target)


def k4_write_view(spark, sf):
    return _stored(spark, _silver(spark, sf))


def k4_published_view(spark, sf):
    """Published twice; the second version is read. What both versions are made of is cleaned once."""
    rows = _written(spark, _silver(spark, sf), "silver")
    with _own_database(spark) as database:
        target, root = f"{database}.published", scratch_dir(spark, "published")
        publish_view(rows.where(F.col("numero_parcelas") > 3), target, "first", root=root)
        publish_view(rows, target, "second", root=root)
        return dataset(spark, target)


def k5_both_keys(spark, sf):
    """Of a table laid out by both keys, a twentieth of its time span touches a part of the files."""
    rows = _silver(spark, sf)
    size = max(1, _listings(spark, sf).count() // 256)
    path = scratch_dir(spark, "both-keys")
    raw = clustered_on_each(v1_known_codes(spark, sf), fixed.CLUSTER_KEYS)
    layers.clean(raw).write.option("maxRecordsPerFile", size).parquet(path)
    low, high = F.lit("1997-01-01").cast("timestamp"), F.lit("1997-05-01").cast("timestamp")
    found = files_of_range(spark.read.schema(rows.schema).parquet(path), "extract", low, high)
    return found.select((3 * F.col("touched_files") < F.col("files")).alias("few_files"), "rows")


def k5_clustered_layout(spark, sf):
    # Laid out before it is parsed, so the sampling of ranges parses nothing.
    raw = clustered(v1_known_codes(spark, sf), fixed.CLUSTER_KEYS)
    return overlapping_files(_stored(spark, layers.clean(raw)), "codigo")


def k5_gold_layout(spark, sf):
    silver = clustered(_stored(spark, _silver(spark, sf)), fixed.CLUSTER_KEYS)
    return overlapping_files(_stored(spark, layers.recommend(silver, CDI_PCT)), "codigo")


def k6_product_events(spark, sf):
    return replies.product_events(_listings(spark, sf))


# --- extraction -------------------------------------------------------------


def x1_html_blocks(spark, sf):
    pages = adapters.pages(spark, sf).select("page_id", "html")
    return html_blocks(pages, "div", "ad")


def _spans(spark, sf):
    span = replies.reply_json_span(F.col("reply")).alias("span")
    return adapters.replies(spark, sf).select("p_partkey", "reply", span)


def x2_reply_json_span(spark, sf):
    return _spans(spark, sf).drop("reply")


def x3_brace_repair(spark, sf):
    repaired = replies.repair_braces(F.col("span")).alias("json")
    return _spans(spark, sf).select("p_partkey", repaired)


def x4_reply_products(spark, sf):
    found = F.size(replies.reply_products(F.col("reply")))
    return adapters.replies(spark, sf).select(
        "p_partkey", F.greatest(F.coalesce(found, F.lit(0)), F.lit(0)).alias("products")
    )


def x5_products_from_reply(spark, sf):
    asof = F.lit("2025-10-05 19:00:00").cast("timestamp")
    return replies.products_from_reply(adapters.replies(spark, sf), "reply", "loja", asof)


def x6_page_messages(spark, sf):
    """Pages as a stream, the stored replies to their blocks, products, keyed messages."""
    pages = adapters.pages(spark, sf).select("page_id", "html")
    replies = adapters.block_replies(html_blocks(pages, "div", "ad"))
    stored = scratch_dir(spark, "replies")
    replies.write.parquet(stored)
    stream = event_stream(spark, f"{sf}/pages.parquet*", "parquet", adapters.pages(spark, sf).schema)
    asof = F.lit("2025-10-05 19:00:00").cast("timestamp")
    return _streamed(spark, page_messages(stream, spark.read.parquet(stored), "loja", asof), "messages")


# --- consumer ---------------------------------------------------------------


def c1_typed_events(spark, sf):
    return type_events(adapters.raw_events(adapters.events(spark, sf)))


def c1_strict_discount(spark, sf):
    return type_events(adapters.raw_events(adapters.events(spark, sf)), True)


def c3_adjusted_lateness(spark, sf):
    return with_event_time(c1_typed_events(spark, sf), late="adjust").select(
        "link", consumer.EVENT_TIME
    )


def c3_adjusted_stream(spark, sf):
    schema = adapters.table(spark, sf, "events").schema
    raw = event_stream(spark, f"{sf}/events.parquet*", "parquet", schema)
    typed = with_event_time(type_events(adapters.raw_events(raw)), late="adjust")
    return _streamed(spark, typed.select("link", consumer.EVENT_TIME), "adjusted")


def c3_out_of_order(spark, sf):
    ordered = with_event_time(c1_typed_events(spark, sf), late="adjust", out_of_order="adjust")
    return ordered.select("link", consumer.EVENT_TIME)


def c3_out_of_order_stream(spark, sf):
    schema = adapters.table(spark, sf, "events").schema
    raw = event_stream(spark, f"{sf}/events.parquet*", "parquet", schema)
    typed = with_event_time(type_events(adapters.raw_events(raw)), late="adjust", out_of_order="adjust")
    return _streamed(spark, typed.select("link", consumer.EVENT_TIME), "in-order")


def c4_passthrough(spark, sf):
    return consumer.passthrough(_events(spark, sf))


def c5_tumbling_count(spark, sf):
    return consumer.tumbling_count(_events(spark, sf), window=f"{WINDOW_S} seconds")


def c6_interval_join(spark, sf):
    return consumer.matched_windows(_events(spark, sf), WINDOW_S, WINDOW_S)


def c7_singletons(spark, sf):
    return consumer.singletons(c6_interval_join(spark, sf))


def c8_listing_columns(spark, sf):
    return consumer.listing_columns(c7_singletons(spark, sf))


def c9_singleton_consumer(spark, sf):
    return consumer.singleton_consumer(_events(spark, sf), WINDOW_S, WINDOW_S)


def c9_singleton_consumer_stream(spark, sf):
    rows = consumer.singleton_consumer(_event_stream(spark, sf), WINDOW_S, WINDOW_S)
    return _streamed(spark, rows, "consumer")


def c9_heartbeat_stream(spark, sf):
    """The consumer's stream with heartbeats a day after each event: no window stays open."""
    schema = adapters.table(spark, sf, "events").schema
    raw = event_stream(spark, f"{sf}/events.parquet*", "parquet", schema)
    ticks = beats(raw.select((F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("at")), "at")
    events = with_event_time(with_heartbeat(type_events(adapters.raw_events(raw)), ticks))
    return _streamed(spark, consumer.singleton_consumer(events, WINDOW_S, WINDOW_S), "beating")


# --- dedup ------------------------------------------------------------------


def b1_stream_dedup(spark, sf):
    rows = dedup(_event_stream(spark, sf), fixed.STREAM_DEDUP_KEYS)
    return _streamed(spark, rows.select(*fixed.STREAM_DEDUP_KEYS), "dedup")


def b1_key_store(spark, sf):
    """Dedup of the event stream by a table of known keys; the second run of the stream brings only repeats."""
    store = KeyStore(scratch_dir(spark, "key-store"), tuple(fixed.STREAM_DEDUP_KEYS))
    checkpoint, source = scratch_dir(spark, "key-store-checkpoint"), scratch_dir(spark, "key-store-input")
    rows = _events(spark, sf).select(*schemas.LISTING.names)
    for _ in range(2):
        rows.write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        _run(dedup_stream(stream, store, checkpoint))
    return store.rows(spark).select(*fixed.STREAM_DEDUP_KEYS)


def b2_batch_dedup(spark, sf):
    return dedup_latest(
        _listings(spark, sf), fixed.BATCH_DEDUP_KEYS, ["link", "origem", "extract"]
    )


# A listing is some ten times as large as what is read or moved of its tables: tasks of the usual size spill when they sort.
_SMALL_TASKS = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def _come_in(spark, waiting: str, folder: str) -> None:
    """Move a folder of landing files below ``folder``: a rename, nothing is written again."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    source = path(waiting)
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.rename(source, path(folder, source.getName())):
        raise OSError(f"{waiting} did not come into {folder}")


def _landed_twice(spark, sf) -> Iterator[str]:
    """A folder of landing files, after each of two landings: one scrape of each advert, then all scrapes.

    The first landing decides which scrape stays. All scrapes are built and written once: they wait beside the folder
    while the first landing is taken from them.
    """
    inbound, waiting = scratch_dir(spark, "inbound"), scratch_dir(spark, "waiting")

    def land(rows: DataFrame, path: str) -> None:
        now = rows.withColumn("landed", F.current_timestamp())
        with settings(spark, _SMALL_TASKS):
            write_inbound(now, path, "landed", as_they_lie=True, compression="gzip")

    land(_listings(spark, sf), waiting)
    land(dedup_latest(listing_batch(spark, waiting), fixed.STREAM_DEDUP_KEYS, ["extract"]), inbound)
    yield inbound
    _come_in(spark, waiting, inbound)
    yield inbound


def b3_bronze_ingest(spark, sf):
    checkpoint, path = scratch_dir(spark, "bronze-checkpoint"), scratch_dir(spark, "ingested")
    with _own_database(spark) as database:
        target = f"{database}.ingested"
        for inbound in _landed_twice(spark, sf):
            _run(bronze_ingest(spark, inbound, target, checkpoint, path))
        return dataset(spark, target)


# --- cleaning ---------------------------------------------------------------


def v1_known_codes(spark, sf):
    return _listings(spark, sf).where(F.col("codigo").isNotNull())


def _parsed(function, raw: str, name: str) -> Query:
    def query(spark, sf):
        return _listings(spark, sf).select(
            "codigo", F.col(raw).alias("raw"), function(F.col(raw)).alias(name)
        )

    return query


def v9_silver_columns(spark, sf):
    return _silver(spark, sf).select("codigo", "nome", "origem", "link", "memoria", "oled")


# --- advice -----------------------------------------------------------------


def _amount(name: str) -> Query:
    return lambda spark, sf: _breakdown(spark, sf).select(*ADVICE_INPUT, name)


def _advice_counts(gold: DataFrame) -> DataFrame:
    return gold.groupBy("recomendacao").agg(F.count(F.lit(1)).alias("n"))


def g6_advice(spark, sf):
    return _advice_counts(_gold(spark, sf))


def g6_advice_normalized(spark, sf):
    return _advice_counts(layers.recommend(_silver(spark, sf), CDI_PCT, normalized_units=True))


def g7_unknown_rate(spark, sf):
    return layers.recommend(_silver(spark, sf), None, with_breakdown=True).select(
        *ADVICE_INPUT, "save_parcelado"
    )


def g8_helpers_dropped(spark, sf):
    kept = layers.recommend(_silver(spark, sf), CDI_PCT, with_breakdown=True)
    helpers = [c for c in kept.columns if c not in schemas.GOLD.names]
    return kept.drop(*helpers)


# --- marts ------------------------------------------------------------------


def n1_detalhes(spark, sf):
    return marts.details(_gold(spark, sf))


def n2_produtos(spark, sf):
    return marts.products(_gold(spark, sf))


def n3_precos(spark, sf):
    return marts.prices(_gold(spark, sf))


def _placed(spark, rows: DataFrame, *order) -> DataFrame:
    """The rows in order, with the place of each.

    The sorted rows are written with their partition's number. The rows before a partition are
    a sum over one row per partition.
    """
    rows = rows.orderBy(*order).withColumn("__id", F.monotonically_increasing_id())
    path = scratch_dir(spark, "ordered")
    rows.write.parquet(path)
    written = spark.read.schema(rows.schema).parquet(path)
    part = F.shiftright("__id", 33).alias("__part")
    before = F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = written.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    numbered = written.withColumn("__part", part).join(starts, "__part")
    inside = F.col("__id") - F.call_function("shiftleft", F.col("__part"), F.lit(33))
    return numbered.withColumn("place", F.col("__before") + inside).drop("__id", "__part", "__before")


def n4_precos_ordered(spark, sf):
    # The other columns follow, so equal prices spread over tasks and the order is fixed.
    ties = ["codigo", "data", "numero_parcelas", "valor_prestacao", "desconto"]
    return _placed(spark, n3_precos(spark, sf), "preco", *[F.col(c).asc_nulls_first() for c in ties])


def n4_detalhes_ordered(spark, sf):
    return _placed(spark, n1_detalhes(spark, sf), "codigo")


def n4_produtos_ordered(spark, sf):
    return _placed(spark, n2_produtos(spark, sf), "codigo")


def _written(spark, rows: DataFrame, label: str) -> DataFrame:
    """The rows from a folder: whatever reads them several times derives them once."""
    path = scratch_dir(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _offered_gold(spark, sf) -> DataFrame:
    """Gold with the columns of offers and prices."""
    wanted = dict.fromkeys([*marts.OFFER, "memoria", "numero_parcelas", "valor_prestacao", "desconto", "extract"])
    return _written(spark, _gold(spark, sf).select(*wanted), "offered")


def m1_offer_join(spark, sf):
    return marts.offers_from_gold(_offered_gold(spark, sf))


def m2_oled_offers(spark, sf):
    return m1_offer_join(spark, sf).where(F.col("oled") == fixed.OLED_YES).drop("oled")


def m3_known_marketplace(spark, sf):
    return marts.offers_from_gold(_offered_gold(spark, sf), fixed.OLED_YES)


def m4_mask_code(spark, sf):
    code = F.col("codigo")
    return _listings(spark, sf).select(code.alias("raw"), lst.mask_code(code).alias("codigo"))


def m5_link_host(spark, sf):
    link = F.col("link")
    return _listings(spark, sf).select(link.alias("raw"), lst.link_host(link).alias("link"))


def m6_top1_by_marketplace(spark, sf):
    # Only the lowest price of a code can win: the history is reduced before the join.
    return marts.suggestion_from_gold(_gold(spark, sf)).select("origem", "menor_preco")


def m7_sugestion(spark, sf):
    gold = _offered_gold(spark, sf)
    return marts.suggestion(marts.products(gold), marts.prices(gold), marts.details(gold))


def m7_sugestion_from_gold(spark, sf):
    return marts.suggestion_from_gold(_gold(spark, sf))


# --- reports ----------------------------------------------------------------


def r1_cluster_inventory(spark, sf):
    return reports.cluster_inventory(adapters.clusters(spark, sf), W)


def r2_current_clusters(spark, sf):
    return reports.current_clusters(adapters.clusters(spark, sf), W).select(
        "cluster_id", "cluster_name", "create_time"
    )


def r3_total_usage(spark, sf):
    return reports.total_usage(adapters.usage(spark, sf), W)


def r4_daily_cpu_peak(spark, sf):
    return reports.daily_cpu_peak(
        adapters.node_timeline(spark, sf), adapters.clusters(spark, sf), W
    )


def r5_latest_prices(spark, sf):
    newest = reports.latest_prices(adapters.list_prices(spark, sf))
    return newest.withColumn("default", F.col("default").cast("double"))


def r6_total_cost(spark, sf):
    return reports.total_cost(adapters.usage(spark, sf), adapters.list_prices(spark, sf), W)


def r7_cost_by_sku(spark, sf):
    return reports.cost_by_sku(adapters.usage(spark, sf), adapters.list_prices(spark, sf), W)


def r8_daily_usage(spark, sf):
    return reports.daily_usage(adapters.usage(spark, sf), W, AS_OF)


def r9_cluster_listing(spark, sf):
    return reports.cluster_listing(adapters.clusters(spark, sf), W)


def r10_run_outcomes(spark, sf):
    return reports.run_outcomes(adapters.runs(spark, sf), adapters.jobs(spark, sf))


def r11_active_runs(spark, sf):
    active = reports.active_runs(adapters.runs(spark, sf), adapters.jobs(spark, sf))
    return active.select("task_key", "result_state")


def r12_errors_by_task(spark, sf):
    return reports.errors_by_task(adapters.runs(spark, sf), adapters.jobs(spark, sf))


def r13_lineage_totals(spark, sf):
    return reports.lineage_totals(adapters.table_lineage(spark, sf), LINEAGE_PREFIX)


def r14_lineage_by_table(spark, sf):
    return reports.lineage_by_table(adapters.table_lineage(spark, sf), LINEAGE_PREFIX)


# --- quality ----------------------------------------------------------------


def e1_bronze_rules(spark, sf):
    return quality.expectations(_listings(spark, sf), quality.BRONZE_RULES)


def e2_silver_rules(spark, sf):
    return quality.expectations(_silver(spark, sf), quality.SILVER_RULES)


def e3_gold_rules(spark, sf):
    return quality.expectations(_gold(spark, sf), quality.GOLD_RULES)


def q4_null_counts(spark, sf):
    return quality.null_counts(_listings(spark, sf))


def e0_streamed_rules(spark, sf):
    """Rule counts of an ingest over a restart, from the log of its table."""
    checkpoint = scratch_dir(spark, "rules-checkpoint")
    path, log = scratch_dir(spark, "ingested"), scratch_dir(spark, "rules")
    with _own_database(spark) as database:
        target = f"{database}.ingested"
        for inbound in _landed_twice(spark, sf):
            _run(bronze_ingest(spark, inbound, target, f"{checkpoint}/rows", path))
            stored = spark.readStream.table(target)
            _run(log_rules(stored, quality.BRONZE_RULES, log, f"{checkpoint}/rules"))
    return logged(spark, log)


def _suite(spark, rows: DataFrame | None, label: str, schema: T.StructType, **options) -> DataFrame:
    """The suite of a table that is stored for it (or missing), reported as ``label``."""
    with _own_database(spark) as database:
        target = f"{database}.checked"
        if rows is not None:
            write_view(rows, target, label, path=scratch_dir(spark, "checked"))
        found = quality.run_suite(spark, target, schema, **options)
        return found.withColumn("dataset", F.lit(label))


def q6_bronze_suite(spark, sf):
    return _suite(spark, _listings(spark, sf), "bronze.listings", schemas.LISTING, forbid_nulls=True)


def q6_silver_suite(spark, sf):
    return _suite(spark, _silver(spark, sf), "silver.listings", schemas.SILVER)


def q6_gold_suite(spark, sf):
    return _suite(spark, _gold(spark, sf), "gold.recommendations", schemas.GOLD)


def q6_failing_tables(spark, sf):
    """A missing table, one with a column lost and another of the wrong type, and an empty one."""
    silver = _silver(spark, sf)
    wrong = silver.drop("oled").withColumn("preco", F.col("preco").cast("string"))
    return (
        _suite(spark, None, "missing", schemas.SILVER)
        .union(_suite(spark, wrong, "wrong", schemas.SILVER))
        .union(_suite(spark, silver.where(F.lit(False)), "empty", schemas.SILVER))
    )


def _one_check(check: str) -> Query:
    """One check of gold under a name of the session's catalog; nothing is stored for it."""

    def query(spark, sf):
        name = f"gold_{uuid.uuid4().hex}"
        _gold(spark, sf).createTempView(name)
        try:
            found = quality.run_suite(spark, name, schemas.GOLD).where(F.col("check") == check)
            return found.withColumn("dataset", F.lit("gold.recommendations"))
        finally:
            spark.catalog.dropTempView(name)

    return query


# --- the whole chain ---------------------------------------------------------


def _refreshed(spark, landings: list[DataFrame], incremental: bool) -> DataFrame:
    """Rows of every layer after a refresh for each of the landings.

    Which scrape of an advert arrives first is chance, so the columns that do not depend on it are compared.
    """
    inbound, checkpoint = scratch_dir(spark, "inbound"), scratch_dir(spark, "refresh-checkpoint")
    parsed = ["preco", "numero_parcelas", "valor_prestacao", "desconto"]
    with _own_database(spark) as database:
        names = Names(*[f"{database}.{f.name}" for f in fields(Names)])
        for rows in landings:
            write_inbound(rows, inbound, consumer.EVENT_TIME)
            refresh(spark, inbound, checkpoint, CDI_PCT, names, incremental, max_files_per_trigger=500, buckets=16)
        layers_of = {
            "bronze": dataset(spark, names.bronze).select("codigo"),
            "silver": dataset(spark, names.silver).select("codigo", *parsed),
            "gold": dataset(spark, names.gold).select("codigo", *parsed, "recomendacao"),
            "detalhes": dataset(spark, names.details).select("codigo"),
            "produtos": dataset(spark, names.products).select("codigo"),
            "precos": dataset(spark, names.prices).select("codigo", *parsed),
            "sugestion": dataset(spark, names.suggestion).select("codigo", "recomendacao"),
        }
        found = None
        for layer, rows in layers_of.items():
            rows = rows.withColumn("layer", F.lit(layer))
            found = rows if found is None else found.unionByName(rows, allowMissingColumns=True)
        # The tables go with the database.
        return _written(spark, found, "layers")


def _consumed(spark, sf) -> DataFrame:
    return consumer.singleton_consumer(
        _events(spark, sf), WINDOW_S, WINDOW_S, keep=[consumer.EVENT_TIME]
    )


def p1_refresh(spark, sf):
    """Events through consumer, landing files, ingest, cleaning, advice and marts."""
    return _refreshed(spark, [_consumed(spark, sf)], incremental=False)


def p2_refresh_incremental(spark, sf):
    """The same in two landings, of which the second brings repeats of the first."""
    rows = _written(spark, _consumed(spark, sf), "consumed")
    early = F.pmod(F.xxhash64("link"), F.lit(2)) == 0
    return _refreshed(spark, [rows.where(early), rows], incremental=True)


def p3_marts_merge(spark, sf):
    """Current row and lowest price per code, merged from two parts of gold, the second after a restart."""
    gold = _gold(spark, sf)
    source, root = scratch_dir(spark, "gold"), scratch_dir(spark, "current")
    checkpoint = scratch_dir(spark, "merge-checkpoint")
    early = F.pmod(F.xxhash64("codigo", "preco"), F.lit(3)) > 0
    with _own_database(spark) as database:
        target = f"{database}.current_rows"
        for rows in (gold.where(early), gold.where(~early)):
            rows.write.mode("append").parquet(source)
            stream = spark.readStream.schema(gold.schema).parquet(source)
            _run(merged.merge_stream(stream, target, root, checkpoint, 64))
        current = dataset(spark, target)
        flat = current.select("codigo", "last.*", F.col("preco").alias("menor_preco"))
        rows = flat.select("codigo", "nome", "origem", "memoria", "oled", "recomendacao", "link", "menor_preco")
        # The partitions go with the database.
        path = scratch_dir(spark, "merged")
        rows.write.parquet(path)
    return spark.read.parquet(path)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        s1_listing_stream, s1_quarantine, s2_listing_batch,
        k1_write_inbound, k1_null_keys, k2_flush, k3_stream_table, k4_write_view, k4_published_view,
        k5_both_keys, k5_clustered_layout,
        k5_gold_layout, k6_product_events,
        x1_html_blocks, x2_reply_json_span, x3_brace_repair, x4_reply_products,
        x5_products_from_reply, x6_page_messages,
        c1_typed_events, c1_strict_discount, c3_adjusted_lateness, c3_adjusted_stream, c3_out_of_order,
        c3_out_of_order_stream, c4_passthrough,
        c5_tumbling_count, c6_interval_join, c7_singletons, c8_listing_columns,
        c9_singleton_consumer, c9_singleton_consumer_stream, c9_heartbeat_stream,
        b1_stream_dedup, b1_key_store, b2_batch_dedup, b3_bronze_ingest,
        v1_known_codes,
    )
}
QUERIES |= {
    "v2_scrape_time": _parsed(lst.scrape_time, "extract", "extract"),
    "v3_instalment_count": _parsed(lst.instalment_count, "parcelamento", "numero_parcelas"),
    "v4_instalment_value": _parsed(lst.instalment_value, "parcelamento", "valor_prestacao"),
    "v5_discount_fraction": _parsed(lst.discount_fraction, "desconto", "desconto"),
    "v6_price_brl": _parsed(lst.price_brl, "preco", "preco"),
    "v7_memory_label": _parsed(lst.memory_label, "nome", "memoria"),
    "v8_oled_flag": _parsed(lst.oled_flag, "nome", "oled"),
    "v9_silver_columns": v9_silver_columns,
    "v10_silver_clean": _silver,
    "g1_cash_price": _amount("preco_desconto"),
    "g2_instalment_total": _amount("preco_parcelado"),
    "g3_cash_saving": _amount("save_desconto"),
    "g4_instalment_saving": _amount("save_parcelado"),
    "g5_instalment_discount_pct": _amount("pct_preco_parcelado"),
    "g6_advice": g6_advice,
    "g6_advice_normalized": g6_advice_normalized,
    "g7_unknown_rate": g7_unknown_rate,
    "g8_helpers_dropped": g8_helpers_dropped,
    "g9_gold_recommendation": _gold,
}
QUERIES |= {
    f.__name__: f
    for f in (
        n1_detalhes, n2_produtos, n3_precos, n4_precos_ordered, n4_detalhes_ordered,
        n4_produtos_ordered, m1_offer_join, m2_oled_offers, m3_known_marketplace, m4_mask_code, m5_link_host,
        m6_top1_by_marketplace, m7_sugestion, m7_sugestion_from_gold,
        r1_cluster_inventory, r2_current_clusters, r3_total_usage, r4_daily_cpu_peak,
        r5_latest_prices, r6_total_cost, r7_cost_by_sku, r8_daily_usage, r9_cluster_listing,
        r10_run_outcomes, r11_active_runs, r12_errors_by_task, r13_lineage_totals,
        r14_lineage_by_table,
        e0_streamed_rules, e1_bronze_rules, e2_silver_rules, e3_gold_rules, q4_null_counts,
        q6_bronze_suite, q6_silver_suite, q6_gold_suite, q6_failing_tables,
        p1_refresh, p2_refresh_incremental, p3_marts_merge,
    )
}
QUERIES |= {
    "q1_table_exists": _one_check("table_exists"),
    "q2_column_set": _one_check("columns"),
    "q3_column_types": _one_check("types"),
    "q5_not_empty": _one_check("not_empty"),
}


def queries() -> dict[str, Query]:
    def runnable(query: Query) -> Query:
        return lambda spark, sf_dir: _plain(query(configure(spark), sf_dir))

    return {name: runnable(query) for name, query in QUERIES.items()}
