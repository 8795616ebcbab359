import random

from pyspark.sql import functions as F

from helpers import bag, listings, rows
from vitrine import fixed_values as fixed
from vitrine import schemas
from vitrine.operators.dedup import collapse_repeats, dedup, dedup_latest
from vitrine.operators.groups import latest_by, top1_by
from vitrine.sources.listings import listing_stream

KEYS = fixed.STREAM_DEDUP_KEYS


def adverts(spark, n=300, seed=1):
    """Few distinct adverts, a third of all rows being one of them."""
    rng = random.Random(seed)
    items = []
    for i in range(n):
        if i % 3 == 0:
            items.append(dict(codigo="hot", preco="1", extract=str(i)))
        else:
            items.append(
                dict(codigo=rng.choice(["a", "b", None]), preco=rng.choice("12"),
                     desconto=rng.choice([None, "5%"]), nome=rng.choice("xy"), extract=str(i))
            )
    return listings(spark, *items)


def distinct_keys(df, keys):
    return set(bag(df.select(*keys)))


def test_collapse_keeps_first_per_batch(spark):
    df = adverts(spark).coalesce(1)
    got = collapse_repeats(df, KEYS)
    assert got.schema == df.schema
    assert distinct_keys(got, KEYS) == distinct_keys(df, KEYS)
    hot = [r.extract for r in got.where("codigo = 'hot'").collect()]
    assert hot == ["0"]


def test_batch(spark):
    df = adverts(spark)
    got = dedup(df, KEYS)
    assert bag(got, *KEYS) == dict.fromkeys(distinct_keys(df, KEYS), 1)


def run(spark, df, tmp_path, name="out"):
    out = str(tmp_path / name)
    df.writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / f"{name}-checkpoint")
    ).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def test_stream_over_two_runs(spark, tmp_path):
    source = str(tmp_path / "in" / "folder=1")
    first, second = adverts(spark, 90, 1), adverts(spark, 200, 2)
    first.write.json(source)
    stream = dedup(listing_stream(spark, str(tmp_path / "in")), KEYS)
    run(spark, stream, tmp_path)
    second.write.mode("append").json(source)
    again = dedup(listing_stream(spark, str(tmp_path / "in")), KEYS)
    got = run(spark, again, tmp_path)
    everything = first.unionByName(second)
    assert bag(got, *KEYS) == dict.fromkeys(distinct_keys(everything, KEYS), 1)


def test_bounded_state(spark, tmp_path):
    adverts(spark, 60).write.json(str(tmp_path / "in"))
    stream = listing_stream(spark, str(tmp_path / "in")).withColumn(
        "seen", F.lit("2025-01-01 00:00:00").cast("timestamp")
    )
    bounded = dedup(stream, KEYS, within="seen")
    got = run(spark, bounded, tmp_path)
    assert bag(got, *KEYS) == dict.fromkeys(distinct_keys(adverts(spark, 60), KEYS), 1)


def test_repeat_after_the_delay_comes_again(spark, tmp_path):
    def land(hour):
        rows = adverts(spark, 1).withColumn("seen", F.lit(f"2025-01-01 0{hour}:00:00"))
        rows.write.mode("append").json(str(tmp_path / "in"))

    schema = "codigo string, preco string, desconto string, parcelamento string, seen timestamp"
    for hour in (0, 5, 9):
        land(hour)
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        got = run(spark, dedup(stream, KEYS, within="seen", delay="1 hour"), tmp_path)
    # State goes when the watermark has passed it, which the trigger at 05:00 brings about.
    assert sorted(r.seen.hour for r in got.collect()) == [0, 9]


def test_latest_survivor_is_fixed(spark):
    df = adverts(spark)
    keys = fixed.BATCH_DEDUP_KEYS
    once = bag(dedup_latest(df, keys, ["extract"]))
    again = bag(dedup_latest(df.repartition(7), keys, ["extract"]))
    assert once == again
    best = {}
    for row in df.collect():
        key = tuple(row[k] for k in keys)
        best[key] = min(best.get(key, row.extract), row.extract)
    position = [schemas.LISTING.names.index(k) for k in keys]
    at = schemas.LISTING.names.index("extract")
    assert {tuple(r[i] for i in position): r[at] for r in once} == best


def test_latest_and_top1_order_of_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", None, "y"), ("a", 1, "z"), ("b", None, "q"), (None, 3, "n")],
        "k string, v int, t string",
    )
    assert set(rows(latest_by(df, ["k"], "v"))) == {("a", 1, "z"), ("b", None, "q"), (None, 3, "n")}
    assert set(rows(top1_by(df, ["k"], "v"))) == {("a", None, "y"), ("b", None, "q"), (None, 3, "n")}
