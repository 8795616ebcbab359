import json
import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from helpers import bag, listings, plan
from pyspark.sql import functions as F
from vitrine import fixed_values as fixed
from vitrine import schemas
from vitrine.operators.dedup import dedup_latest
from vitrine.plans.layers import clean, recommend
from vitrine.plans.refresh import Names, refresh
from vitrine.session import scratch_dir
from vitrine.sinks.inbound import write_inbound
from vitrine.sinks.tables import overlapping_files, write_stream_table, write_view
from vitrine.sources.listings import dataset, listing_batch, listing_stream
from vitrine.streaming.ingest import bronze_ingest, bronze_rows


def adverts(spark, n=40, start=0):
    return listings(
        spark,
        *[
            dict(codigo=f"{i % 7:05d}", nome="Console oled 32GB", preco=f"R$ {1 + i % 9},00",
                 parcelamento=None if i % 2 else f"{1 + i % 3}x de R$ 1,50", origem=f"s{i % 2}",
                 link="https://a.com/x", extract=f"2025-10-{1 + i % 28:02d} 19:00")
            for i in range(start, start + n)
        ],
    )


def landed(df, at):
    return df.withColumn("at", F.lit(at).cast("timestamp"))


def test_inbound_layout(spark, tmp_path):
    path = str(tmp_path / "inbound")
    df = adverts(spark)
    write_inbound(landed(df, "2025-10-05 19:59:59"), path, "at")
    write_inbound(landed(df, "2025-10-05 20:00:00"), path, "at", writers=1)
    folders = sorted(p.name for p in Path(path).iterdir() if p.is_dir())
    assert folders == ["folder=2025-10-05_19", "folder=2025-10-05_20"]
    assert len(list(Path(path, folders[1]).glob("*.json"))) == 1
    assert len(list(Path(path, folders[0]).glob("*.json"))) == 1
    line = next(Path(path, folders[1]).glob("*.json")).read_text().splitlines()[0]
    assert set(json.loads(line)) == set(schemas.LISTING.names)
    assert '"desconto":null' in line
    back = listing_batch(spark, path)
    assert bag(back) == bag(df.unionByName(df))


def test_inbound_stream_needs_checkpoint(spark, tmp_path):
    path = str(tmp_path / "in")
    adverts(spark).write.json(path)
    stream = landed(listing_stream(spark, path), "2025-10-05 19:00:00")
    with pytest.raises(ValueError):
        write_inbound(stream, str(tmp_path / "out"), "at")
    write_inbound(stream, str(tmp_path / "out"), "at", str(tmp_path / "c")).awaitTermination()
    assert bag(listing_batch(spark, str(tmp_path / "out"))) == bag(adverts(spark))


def test_view_with_comment_and_layout(spark, tmp_path):
    path = tmp_path / "silver"
    silver = clean(adverts(spark, 400))
    for _ in range(2):
        write_view(silver, "clustered_view", "it's typed", ["codigo", "extract"], str(path))
    stored = dataset(spark, "clustered_view")
    assert bag(stored) == bag(silver)
    comment = spark.catalog.getTable("clustered_view").description
    assert comment == "it's typed"
    spans = []
    for file in path.glob("*.parquet"):
        codes = pq.read_table(file, columns=["codigo"])["codigo"].to_pylist()
        assert codes == sorted(codes)
        spans.append((codes[0], codes[-1]))
    spans.sort()
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    spark.sql("DROP TABLE clustered_view")


def test_scratch_follows_the_session(spark):
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


@pytest.mark.parametrize("incremental", [False, True])
def test_refresh_twice(spark, tmp_path, incremental):
    for schema in ("rbronze", "rsilver", "rgold"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{tmp_path / schema}'")
    names = Names(
        "rbronze.l", "rsilver.l", "rgold.r", "rgold.d", "rgold.p", "rgold.h", "rgold.s", "rgold.c"
    )
    inbound, checkpoint = str(tmp_path / "inbound"), str(tmp_path / "checkpoint")
    write_inbound(landed(adverts(spark, 40), "2025-10-05 19:00:00"), inbound, "at")
    counts = refresh(spark, inbound, checkpoint, 10.0, names, incremental)
    first = dataset(spark, names.bronze).count()
    assert counts["bronze"]["required_columns"] == (first, 0)
    assert counts["silver"]["codigo_string_not_null"] == (first, 0)
    assert counts["gold"]["recomendacao_string_not_null"] == (first, 0)

    write_inbound(landed(adverts(spark, 60), "2025-10-05 20:00:00"), inbound, "at")
    counts = refresh(spark, inbound, checkpoint, 10.0, names, incremental)
    keys = ["codigo", "preco", "desconto", "parcelamento"]
    expected = adverts(spark, 60).select(*keys).distinct().count()
    assert dataset(spark, names.bronze).count() == expected
    assert counts["bronze"]["required_columns"] == (expected - first, 0)
    written = expected - first if incremental else expected
    assert counts["silver"]["codigo_string_not_null"] == (written, 0)
    assert counts["gold"]["recomendacao_string_not_null"] == (written, 0)
    whole = recommend(clean(dataset(spark, names.bronze)), 10.0)
    assert bag(dataset(spark, names.gold)) == bag(whole)
    assert dataset(spark, names.details).count() == 7
    assert dataset(spark, names.products).columns == schemas.PRODUCTS
    assert dataset(spark, names.prices).count() == expected
    best = dataset(spark, names.suggestion).collect()
    assert {r.origem for r in best} <= {"s0", "s1"} and all(r.codigo.startswith("00") for r in best)
    for schema in ("rbronze", "rsilver", "rgold"):
        spark.sql(f"DROP DATABASE {schema} CASCADE")


def test_rule_counts_of_more_triggers_than_spark_remembers(spark, tmp_path):
    from vitrine.operators.quality import BRONZE_RULES
    from vitrine.plans.refresh import rule_counts
    from vitrine.streaming.ingest import bronze_ingest

    path = str(tmp_path / "inbound")
    for i in range(8):
        adverts(spark, 5, 5 * i).coalesce(1).write.mode("append").json(path)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    spark.sql(f"CREATE DATABASE rules LOCATION '{tmp_path / 'rules'}'")
    try:
        query = bronze_ingest(spark, path, "rules.l", str(tmp_path / "c"), max_files_per_trigger=1)
        counts = rule_counts(query, BRONZE_RULES)
        assert counts["required_columns"] == (spark.table("rules.l").count(), 0)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
        spark.sql("DROP DATABASE rules CASCADE")


def test_bounded_ingest(spark, tmp_path):
    from vitrine.streaming.ingest import bronze_ingest

    path = str(tmp_path / "inbound")
    adverts(spark, 60).write.json(path)
    spark.sql(f"CREATE DATABASE bounded LOCATION '{tmp_path / 'bounded'}'")
    try:
        for _ in range(2):
            bronze_ingest(spark, path, "bounded.l", str(tmp_path / "c"), delay="365 days", collapse=True).awaitTermination()
        stored = spark.table("bounded.l")
        assert stored.columns == schemas.LISTING.names
        keys = ["codigo", "preco", "desconto", "parcelamento"]
        assert bag(stored, *keys) == bag(adverts(spark, 60).select(*keys).distinct())
    finally:
        spark.sql("DROP DATABASE bounded CASCADE")


def test_gold_layout_of_a_refresh(spark, tmp_path):
    from vitrine.sinks.tables import overlapping_files

    spark.sql(f"CREATE DATABASE laid LOCATION '{tmp_path / 'laid'}'")
    names = Names(*[f"laid.{n}" for n in "abcdefg"])
    try:
        write_inbound(landed(adverts(spark, 200), "2025-10-05 19:00:00"), str(tmp_path / "in"), "at")
        refresh(spark, str(tmp_path / "in"), str(tmp_path / "c"), 10.0, names, max_files_per_trigger=1)
        for table in (names.silver, names.gold):
            row = overlapping_files(dataset(spark, table), "codigo").first()
            assert row.overlapping_files == 0 and row.rows == dataset(spark, names.bronze).count()
    finally:
        spark.sql("DROP DATABASE laid CASCADE")


def test_one_landing_is_neither_moved_nor_plain_text(spark, tmp_path):
    df = landed(adverts(spark, 500).repartition(3), "2025-10-05 19:00:00")
    write_inbound(df, str(tmp_path / "in"), "at", as_they_lie=True, compression="gzip")
    files = list((tmp_path / "in" / "folder=2025-10-05_19").glob("*.json.gz"))
    assert len(files) == 3  # as the rows lay
    assert bag(listing_batch(spark, str(tmp_path / "in"))) == bag(adverts(spark, 500))
    query = write_stream_table(listing_stream(spark, str(tmp_path / "in")), "unpacked", str(tmp_path / "c"), str(tmp_path / "t"))
    query.awaitTermination()
    try:
        assert bag(spark.table("unpacked")) == bag(adverts(spark, 500))
    finally:
        spark.sql("DROP TABLE unpacked")


def test_landings_of_the_queries_are_written_once_and_small(spark, tmp_path):
    """What the queries land is shuffled for no reason of its own, and takes a part of its plain text."""
    from checks.catalogue import _landed, _listings

    found = Path(_landed(spark, "/root/testdata/sf0.01").removeprefix("file://"))
    size = sum(f.stat().st_size for f in found.rglob("part-*"))
    plain = _listings(spark, "/root/testdata/sf0.01").selectExpr("sum(length(to_json(struct(*))))").first()[0]
    assert size * 4 < plain
    assert bag(listing_batch(spark, str(found))) == bag(_listings(spark, "/root/testdata/sf0.01").select(*schemas.LISTING.names))


def test_ends_of_files_are_found_without_sorting_rows(spark, tmp_path):
    for name, rows in {"a": ["b", None, "f"], "b": ["e", "h"], "c": ["h", "ção"], "d": [None]}.items():
        spark.createDataFrame([(r, 1) for r in rows], "code string, x int").coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    found = overlapping_files(spark.read.parquet(str(tmp_path / "t")), "code")
    # Sorted by their least value: b to f, e to h (begins below f), h to ção; the file without values counts its row.
    assert [tuple(r) for r in found.collect()] == [(1, 8)]
    scan = plan(found).split("Scan parquet")[0]
    assert "MapInArrow" in scan[scan.rindex("SortAggregate"):]


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f.name for d in folders for f in Path(d.getPath()).rglob("shuffle_*")}


def left_over(spark, before, seconds=10):
    """Shuffle files that were not there before and do not go, which Spark may take a moment for."""
    end = time.monotonic() + seconds
    while (more := shuffle_files(spark) - before) and time.monotonic() < end:
        time.sleep(0.1)
    return more


def test_landing_and_ingest_leave_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    rows = dedup_latest(adverts(spark, 300), fixed.STREAM_DEDUP_KEYS, ["extract"])
    write_inbound(landed(rows, "2025-10-05 19:00:00"), str(tmp_path / "in"), "at", as_they_lie=True, compression="gzip")
    assert not left_over(spark, before)
    spark.sql(f"CREATE DATABASE left_over LOCATION '{tmp_path / 'left_over'}'")
    try:
        bronze_ingest(spark, str(tmp_path / "in"), "left_over.l", str(tmp_path / "c")).awaitTermination()
        assert not left_over(spark, before)
        keys = ["codigo", "preco", "desconto", "parcelamento"]
        assert spark.table("left_over.l").count() == adverts(spark, 300).select(*keys).distinct().count()
    finally:
        spark.sql("DROP DATABASE left_over CASCADE")


def test_ingest_stores_small_and_goes_on_with_an_older_checkpoint(spark, tmp_path):
    inbound, checkpoint, path = (str(tmp_path / n) for n in ("in", "c", "t"))
    keys = ["codigo", "preco", "desconto", "parcelamento"]
    spark.sql(f"CREATE DATABASE older LOCATION '{tmp_path / 'older'}'")
    try:
        adverts(spark, 30).write.json(inbound)
        # As the ingest was before: the session's codecs for state and table.
        rows = bronze_rows(listing_stream(spark, inbound))
        write_stream_table(rows, "older.l", checkpoint, path).awaitTermination()
        for last in (60, 90):
            adverts(spark, last).write.mode("append").json(inbound)
            bronze_ingest(spark, inbound, "older.l", checkpoint, path).awaitTermination()
            assert bag(spark.table("older.l"), *keys) == bag(adverts(spark, last).select(*keys).distinct())
        bronze_ingest(spark, inbound, "older.new", str(tmp_path / "c2"), str(tmp_path / "t2")).awaitTermination()
        assert bag(spark.table("older.new"), *keys) == bag(adverts(spark, 90).select(*keys).distinct())
        assert {f.name.split(".", 1)[1] for f in (tmp_path / "t2").glob("part-*")} == {"zstd.parquet"}
        assert '"spark.sql.streaming.stateStore.compression.codec":"zstd"' in (tmp_path / "c2" / "offsets" / "0").read_text()
    finally:
        spark.sql("DROP DATABASE older CASCADE")


def test_two_landings_build_the_listings_once(spark, monkeypatch):
    from checks import catalogue

    sf, built = "/root/testdata/sf0.001", []
    whole = catalogue._listings(spark, sf).select(*schemas.LISTING.names)
    monkeypatch.setattr(catalogue, "_listings", lambda *a: built.append(a) or whole)
    first = bag(dedup_latest(whole, fixed.STREAM_DEDUP_KEYS, ["extract"]))
    landings = [bag(listing_batch(spark, inbound)) for inbound in catalogue._landed_twice(spark, sf)]
    assert landings == [first, first + bag(whole)]
    assert len(built) == 1
