"""One refresh of all layers, each dataset written once."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from vitrine import fixed_values as fixed
from vitrine.operators.quality import (
    BRONZE_RULES,
    GOLD_RULES,
    SILVER_RULES,
    observed,
    observed_counts,
)
from vitrine.plans import merged
from vitrine.plans.layers import clean, recommend
from vitrine.plans.marts import current_listing, prices, suggestion
from vitrine.schemas import DETAILS, PRODUCTS
from vitrine.session import scratch_dir
from vitrine.sinks.tables import clustered, write_stream_table
from vitrine.sinks.versions import publish_view
from vitrine.sources.listings import dataset
from vitrine.streaming.ingest import METRICS, bronze_ingest
from vitrine.streaming.rulelog import last_trigger, log_rules, logged

Counts = dict[str, tuple[int, int]]
REPORT_SECONDS = 10


@dataclass(frozen=True)
class Names:
    """Table names of the layers."""

    bronze: str = "bronze.listings"
    silver: str = "silver.listings"
    gold: str = "gold.recommendations"
    details: str = "gold.detalhes"
    products: str = "gold.produtos"
    prices: str = "gold.precos"
    suggestion: str = "gold.sugestion"
    current: str = "gold.current_rows"


def _watched_view(df: DataFrame, rules: Mapping[str, str], target: str, comment: str) -> Counts:
    watch = Observation(target.replace(".", "_"))
    publish_view(observed(df, rules, watch), target, comment)
    return observed_counts(watch.get, rules)


class _Triggers(StreamingQueryListener):
    """Every progress of one run of a query, as it is reported."""

    def __init__(self, run: str) -> None:
        self.run, self.seen, self.ended = run, [], threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.runId) == self.run:
            self.seen.append(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run:
            self.ended.set()


def rule_counts(query: StreamingQuery, rules: Mapping[str, str], metrics: str = METRICS) -> Counts:
    """Wait for a stream's end and add up the rule counts of all its triggers in this run.

    A query remembers its latest triggers only; a listener gets each. Should a trigger still be missing, this raises
    rather than give a part of the counts. Counts that outlive the driver are those of ``log_rules``.
    """
    streams, listener = SparkSession.active().streams, _Triggers(str(query.runId))
    streams.addListener(listener)
    try:
        earlier = list(query.recentProgress)
        query.awaitTermination()
        # The end is reported after all progress. A query that ended before the listener came reports none.
        listener.ended.wait(REPORT_SECONDS)
    finally:
        streams.removeListener(listener)
    seen: dict[int, dict | None] = {}
    for progress in [*earlier, *listener.seen, *query.recentProgress]:
        row = progress.observedMetrics.get(metrics)
        if row is not None or progress.batchId not in seen:
            seen[progress.batchId] = None if row is None else row.asDict()
    if seen and len(seen) < max(seen) - min(seen) + 1:
        raise RuntimeError("triggers passed unseen: raise spark.sql.streaming.numRecentProgressUpdates")
    total = {rule: (0, 0) for rule in rules}
    for row in seen.values():
        if row is not None:
            for rule, (passed, failed) in observed_counts(row, rules).items():
                total[rule] = (total[rule][0] + passed, total[rule][1] + failed)
    return total


def _logged_counts(spark: SparkSession, table: str, rules: Mapping[str, str], checkpoint: str) -> Counts:
    """Counts of the rows that came into a stream table since the last call, kept in a log beside its checkpoint."""
    log = f"{checkpoint}-rules"
    before = last_trigger(spark, log)
    log_rules(spark.readStream.table(table), rules, log, f"{log}-checkpoint").awaitTermination()
    found = {r.expectation: (r.passed_records, r.failed_records) for r in logged(spark, log, before).collect()}
    return {rule: found.get(rule, (0, 0)) for rule in rules}


def _appended(
    spark: SparkSession,
    source: str,
    layer: Callable[[DataFrame], DataFrame],
    rules: Mapping[str, str],
    target: str,
    checkpoint: str,
) -> Counts:
    """New rows of ``source`` through a row-by-row ``layer``, appended to ``target``."""
    rows = layer(spark.readStream.table(source))
    write_stream_table(rows, target, checkpoint).awaitTermination()
    return _logged_counts(spark, target, rules, checkpoint)


def refresh_marts(spark: SparkSession, names: Names = Names()) -> None:
    """Marts from the stored gold table.

    The row per code that two marts share is found once and kept in a written table:
    it survives lost executors and is small next to the history. The marts are rewritten as a
    whole, and each is published at once.
    """
    gold = dataset(spark, names.gold)
    staged = scratch_dir(spark, "current-listing")
    current_listing(gold).write.parquet(staged)
    current = spark.read.parquet(staged)
    publish_view(current.select(*DETAILS), names.details, "Latest details per code")
    publish_view(current.select(*PRODUCTS), names.products, "Latest name and marketplace per code")
    publish_view(prices(gold), names.prices, "Price and payment history")
    best = suggestion(
        dataset(spark, names.products),
        dataset(spark, names.prices),
        dataset(spark, names.details),
    )
    publish_view(best, names.suggestion, "Cheapest offer per marketplace")


def merge_marts(
    spark: SparkSession, checkpoint: str, names: Names = Names(), buckets: int = merged.BUCKETS
) -> None:
    """New gold rows into the marts: nothing reads the whole history.

    Prices are appended. The current row per code is merged into ``names.current``, of which details, products and the
    suggestion are views.
    """
    def stream() -> DataFrame:
        return spark.readStream.table(names.gold)

    write_stream_table(prices(stream()), names.prices, f"{checkpoint}/prices").awaitTermination()
    root = f"{checkpoint}/current-rows"
    merged.merge_stream(stream(), names.current, root, f"{checkpoint}/current", buckets).awaitTermination()
    for target, view in {
        names.details: merged.DETAILS_SQL,
        names.products: merged.PRODUCTS_SQL,
        names.suggestion: merged.suggestion_sql(),
    }.items():
        spark.sql(f"CREATE OR REPLACE VIEW {target} AS {view.format(current=names.current)}")


def refresh(
    spark: SparkSession,
    inbound: str,
    checkpoint: str,
    cdi_pct: float | None = None,
    names: Names = Names(),
    incremental: bool = False,
    max_files_per_trigger: int | None = None,
    delay: str | None = None,
    collapse: bool = False,
    buckets: int = merged.BUCKETS,
) -> dict[str, Counts]:
    """New landing files through all layers; ``(passed, failed)`` per rule come back.

    The ingest is always incremental through ``checkpoint``. Silver and gold are
    rewritten in clustered files or, with ``incremental``, take only the new rows:
    both are computed row by row, so the rows are the same. The marts follow: published anew
    as a whole, or merged (``merge_marts``). Tables stay with the way they were first written.

    ``max_files_per_trigger`` bounds a backlog; ``delay`` bounds the state of the ingest by
    the scrape time (see ``bronze_ingest``); ``collapse`` helps it with hot adverts. ``buckets`` is the number of
    partitions of the merged marts, which stays once they are there.
    """
    ingest = bronze_ingest(
        spark,
        inbound,
        names.bronze,
        f"{checkpoint}/bronze",
        max_files_per_trigger=max_files_per_trigger,
        delay=delay,
        collapse=collapse,
    )
    ingest.awaitTermination()
    counts = {"bronze": _logged_counts(spark, names.bronze, BRONZE_RULES, f"{checkpoint}/bronze")}

    def advised(silver: DataFrame) -> DataFrame:
        return recommend(silver, cdi_pct)

    if incremental:
        counts["silver"] = _appended(
            spark, names.bronze, clean, SILVER_RULES, names.silver, f"{checkpoint}/silver"
        )
        counts["gold"] = _appended(
            spark, names.silver, advised, GOLD_RULES, names.gold, f"{checkpoint}/gold"
        )
        merge_marts(spark, checkpoint, names, buckets)
    else:
        # Raw rows are laid out first: codes stay as they are and scrape times sort as
        # text, so the range sampling scans plain columns and parsing runs once.
        raw = dataset(spark, names.bronze).where(F.col("codigo").isNotNull())
        silver = clean(clustered(raw, fixed.CLUSTER_KEYS))
        counts["silver"] = _watched_view(silver, SILVER_RULES, names.silver, "Typed listings")
        # A scan packs files by size, not by order, so gold is laid out again before the advice.
        gold = advised(clustered(dataset(spark, names.silver), fixed.CLUSTER_KEYS))
        counts["gold"] = _watched_view(gold, GOLD_RULES, names.gold, "Listings with advice")
        refresh_marts(spark, names)
    return counts
