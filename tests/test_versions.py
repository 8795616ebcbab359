import threading

import pytest
from helpers import bag, listings
from pyspark.sql import functions as F
from vitrine import schemas
from vitrine.plans import marts, merged
from vitrine.plans.layers import clean, recommend
from vitrine.sinks.versions import publish_view, versions


def test_readers_never_miss_the_table(spark, tmp_path):
    """A reader runs without a gap while the table is rewritten, and always sees one whole version."""
    root, seen, failed, stop = str(tmp_path / "t"), [], [], threading.Event()

    def version(n):
        return spark.range(1000).select(F.lit(n).alias("n"), "id")

    publish_view(version(0), "watched", "it's \\ watched", root=root)

    def read():
        while not stop.is_set():
            try:
                row = spark.table("watched").agg(F.min("n"), F.max("n"), F.count("*")).first()
                seen.append(tuple(row))
            except Exception as error:  # noqa: BLE001 - the test looks at it
                failed.append(error)
                return

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 8):
        publish_view(version(n), "watched", "it's \\ watched", root=root, keep=3)
    stop.set()
    reader.join()
    assert not failed and len(seen) > 3
    assert all(low == high and rows == 1000 for low, high, rows in seen)
    assert [n for n, _, _ in seen] == sorted(n for n, _, _ in seen)
    assert len(versions(spark, root)) == 3
    assert spark.catalog.getTable("watched").description == "it's \\ watched"
    spark.sql("DROP TABLE watched")


def test_a_failed_rewrite_is_never_seen(spark, tmp_path):
    publish_view(spark.range(5), "steady", root=str(tmp_path / "t"))
    broken = spark.range(5).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        publish_view(broken, "steady", root=str(tmp_path / "t"))
    assert spark.table("steady").count() == 5
    publish_view(spark.table("steady").where("id > 2"), "steady", root=str(tmp_path / "t"))  # reads what it replaces
    assert spark.table("steady").count() == 2
    publish_view(spark.range(3).select(F.col("id").alias("other")), "steady", root=str(tmp_path / "t"))
    assert spark.table("steady").columns == ["other"]
    spark.sql("DROP TABLE steady")


def gold(spark, first, n):
    rows = [
        dict(codigo=f"{i * 7 % 40:05d}", nome=f"Console oled {i % 3} 32GB", preco=None if i == 77 else f"R$ {1 + i * 13 % 29},00",
             parcelamento=f"{1 + i % 3}x de R$ 1,50", origem=None if i % 11 == 0 else f"s{i % 3}", link="https://a.com/x",
             extract=f"2025-10-{1 + i % 28:02d} 19:00")
        for i in range(first, first + n)
    ]
    return recommend(clean(listings(spark, *rows)), 10.0)


def full(rows):
    return marts.details(rows), marts.products(rows), marts.suggestion_from_gold(rows)


def kept(current):
    return merged.details(current), merged.products(current), merged.suggestion(current)


def test_merged_marts_equal_the_full_form(spark, tmp_path):
    root = str(tmp_path / "current")
    first, second = gold(spark, 0, 120), gold(spark, 120, 4)
    merged.create_current(spark, "current_rows", root, first)
    assert kept(spark.table("current_rows"))[0].columns == schemas.DETAILS
    merged.merge(spark, first, "current_rows", root, 16)
    before = set(spark.table("current_rows").inputFiles())
    touched = merged.merge(spark, second, "current_rows", root, 16)
    assert 0 < len(touched) <= 4
    # Only the touched partitions have new files.
    after = set(spark.table("current_rows").inputFiles())
    assert {f"bucket={b}" for b in touched} == {f.split("/")[-2] for f in after - before}
    everything = first.union(second)
    for ours, wanted in zip(kept(spark.table("current_rows")), full(everything)):
        assert bag(ours) == bag(wanted)
    merged.merge(spark, second, "current_rows", root, 16)  # a repeated batch changes nothing
    merged.merge(spark, second.limit(0), "current_rows", root, 16)
    for ours, wanted in zip(kept(spark.table("current_rows")), full(everything)):
        assert bag(ours) == bag(wanted)
    spark.sql("DROP TABLE current_rows")


def test_merge_stream_goes_on_after_a_restart(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("gold", "current", "checkpoint"))
    parts = [gold(spark, 0, 50), gold(spark, 50, 30)]
    for part in parts:
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(part.schema).parquet(source)
        merged.merge_stream(stream, "streamed_rows", root, checkpoint, 8).awaitTermination()
    for ours, wanted in zip(kept(spark.table("streamed_rows")), full(parts[0].union(parts[1]))):
        assert bag(ours) == bag(wanted)
    spark.sql("DROP TABLE streamed_rows")
