import datetime as dt
import random

import pytest
from helpers import bag
from vitrine import schemas
from vitrine.operators.ordering import in_order
from vitrine.sources.events import beats, with_event_time, with_heartbeat
from vitrine.streaming.consumer import singleton_consumer

START = dt.datetime(2025, 10, 5, 12)
SCHEMA = "name string, part long, arrived timestamp, at timestamp"


def events(n=400, seed=3):
    chance = random.Random(seed)
    rows = []
    for i in range(n):
        arrived = None if chance.random() < 0.03 else START + dt.timedelta(seconds=chance.randrange(4000))
        at = None if chance.random() < 0.05 else (arrived or START) - dt.timedelta(seconds=chance.randrange(300))
        rows.append((f"e{i}", chance.choice([None, 1, 1, 1, 2]), arrived, at))
    return rows


def brute(rows):
    out, latest = [], {}
    for name, part, arrived, at in sorted(rows, key=lambda r: (r[2] is not None, r[2] or START, r[3] is not None, r[3] or START)):
        if at is not None:
            at = latest[part] = max(at, latest.get(part, at))
        out.append((name, part, arrived, at))
    return sorted(out)


@pytest.mark.parametrize("bucket", [1, 60, 10**6])
def test_batch_is_a_running_maximum(spark, bucket):
    rows = events()
    got = in_order(spark.createDataFrame(rows, SCHEMA), "at", "part", "arrived", bucket)
    assert got.columns == ["name", "part", "arrived", "at"]
    assert sorted(map(tuple, got.collect())) == brute(rows)
    assert in_order(spark.createDataFrame([], SCHEMA), "at", "part", "arrived").count() == 0


def test_stream_remembers_over_triggers_and_restarts(spark, tmp_path):
    rows = sorted(events(), key=lambda r: (r[2] is not None, r[2] or START, r[3] is not None, r[3] or START))
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "c"))
    for part in (rows[:150], rows[150:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = in_order(spark.readStream.schema(SCHEMA).parquet(source), "at", "part", "arrived")
        query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start(out).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == brute(rows)


def test_a_trigger_is_held_as_blocks(spark, tmp_path):
    """Rows of a trigger pass through their partition's task compressed, with all column types kept."""
    rows = spark.range(30_000).selectExpr(
        "concat('advert ', id) AS name", "if(id % 10 = 0, NULL, id % 2) AS part", "array(id, NULL) AS more",
        "timestamp'2025-10-05 12:00:00' + make_dt_interval(0, 0, 0, id * 7919 % 30000) AS arrived",
        "if(id % 13 = 0, NULL, timestamp'2025-10-05 12:00:00' + make_dt_interval(0, 0, 0, id * 7907 % 30000)) AS at",
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = in_order(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), "at", "part", "arrived")
    assert stream.dtypes == rows.dtypes
    query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
    query = query.trigger(availableNow=True).start(str(tmp_path / "out"))
    query.awaitTermination()
    assert query._jsq.explainInternal(False).count("MapInArrow") == 2
    got, wanted = spark.read.parquet(str(tmp_path / "out")), in_order(rows, "at", "part", "arrived")
    assert got.exceptAll(wanted).count() == 0 and got.count() == 30_000


def test_policy_is_checked(spark):
    with pytest.raises(ValueError):
        with_event_time(spark.createDataFrame([], schemas.EVENT), out_of_order="drop")


def test_heartbeats_bring_out_the_last_windows(spark, tmp_path):
    def event(i, second):
        at = START + dt.timedelta(seconds=second)
        return (None, f"c{i}", f"n{i}", "1", None, "l", "o", "x", at, 1, at)

    rows = [event(i, 7 * i) for i in range(12)]
    source = str(tmp_path / "events")
    df = spark.createDataFrame(rows, schemas.EVENT)
    df.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(schemas.EVENT).parquet(source)
    ticks = beats(stream.selectExpr("EventEnqueuedUtcTime + INTERVAL 1 HOUR AS at"), "at")

    def consumed(events, name):
        out = str(tmp_path / name)
        rows = singleton_consumer(with_event_time(events))
        query = rows.writeStream.format("parquet").option("checkpointLocation", f"{out}-c")
        query.trigger(availableNow=True).start(out).awaitTermination()
        return bag(spark.read.schema(schemas.LISTING).parquet(out))

    wanted = bag(singleton_consumer(with_event_time(df)))
    assert consumed(with_heartbeat(stream, ticks), "beating") == wanted
    idle = consumed(stream, "idle")
    assert sum(idle.values()) < sum(wanted.values())
