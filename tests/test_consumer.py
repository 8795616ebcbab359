import datetime as dt
import random
from collections import Counter

import pytest

from helpers import bag, rows
from vitrine import schemas
from vitrine.operators.intervals import interval_join
from vitrine.operators.replies import product_events
from vitrine.sources.events import decode_broker, event_stream, type_events, with_event_time
from vitrine.streaming import consumer

START = dt.datetime(2025, 1, 1)


def event(code, price, second, instalments="1x", tag=None):
    at = START + dt.timedelta(seconds=second)
    return (
        None, code, tag, price, instalments, "/p", "o", "2025-01-01 00:00", at, 1, at,
    )


def frame(spark, events):
    return spark.createDataFrame(events, schemas.EVENT)


FOUR = [
    event("1", "20", 3), event("1", "20", 8), event("1", "20", 10.3), event("1", "30", 11.5),
]


def ends(df):
    out = {}
    for at, end in rows(df.select("left_EventEnqueuedUtcTime", "right_Window_End_Time")):
        out.setdefault((at - START).total_seconds(), []).append((end - START).seconds)
    return {k: sorted(v) for k, v in out.items()}


def test_matched_windows(spark):
    got = ends(consumer.matched_windows(frame(spark, FOUR)))
    assert got == {3.0: [5], 8.0: [5, 10], 10.3: [5, 10, 15, 15], 11.5: [10, 15, 15]}


def random_events(n, seed, codes="ab"):
    rng = random.Random(seed)
    return [
        event(
            rng.choice([*codes, None]), rng.choice("12"), rng.randint(0, 600) / 10,
            rng.choice(["x", None]), str(i),
        )
        for i in range(n)
    ]


def brute_force(events, window_s=5, tolerance_s=5):
    """Tag counts of the consumer's output, straight from its definition."""
    epoch = dt.datetime(1970, 1, 1)
    groups = Counter()
    for e in events:
        second = (e[10] - epoch).total_seconds()
        groups[(e[1], e[4], e[3], (second // window_s + 1) * window_s)] += e[1] is not None
    out = Counter()
    for e in events:
        second = int((e[10] - epoch).total_seconds())
        for (code, _, _, end), n in groups.items():
            if n == 1 and code == e[1] and abs(end - second) <= tolerance_s:
                out[e[2]] += 1
    return out


@pytest.mark.parametrize("window_s, tolerance_s", [(5, 5), (5, 12), (7, 3)])
def test_against_brute_force(spark, window_s, tolerance_s):
    events = random_events(150, 3)
    df = frame(spark, events)
    expected = Counter({(k,): v for k, v in brute_force(events, window_s, tolerance_s).items()})
    assert bag(consumer.singleton_consumer(df, window_s, tolerance_s), "nome") == expected
    long_way = consumer.listing_columns(
        consumer.singletons(consumer.matched_windows(df, window_s, tolerance_s))
    )
    assert bag(long_way, "nome") == expected
    assert long_way.columns == schemas.LISTING.names


def test_salts_change_nothing(spark):
    df = frame(spark, random_events(200, 5, "a"))
    plain = bag(consumer.singleton_consumer(df))
    assert bag(consumer.singleton_consumer(df, salts=7)) == plain
    assert sum(plain.values()) > 0


def test_interval_join_before_1970(spark):
    left = spark.createDataFrame([("k", dt.datetime(1969, 12, 31, 23, 59, 58))], "k string, t timestamp")
    right = spark.createDataFrame(
        [("k", dt.datetime(1970, 1, 1, 0, 0, s)) for s in range(6)], "k string, t timestamp"
    )
    got = interval_join(left, right, ["k"], "t", "t", -5, 5)
    assert sorted(t.second for (t,) in rows(got.select("right_t"))) == [0, 1, 2, 3]


def test_count_skips_null_codes(spark):
    df = frame(spark, [event(None, "1", 1), event("a", "1", 1), event("a", "1", 4.999), event("a", "1", 5)])
    got = {(r.codigo, (r.Window_End_Time - START).seconds): r.COUNT_codigo
           for r in consumer.tumbling_count(df).collect()}
    assert got == {(None, 5): 0, ("a", 5): 2, ("a", 10): 1}


@pytest.mark.parametrize("salts", [1, 3])
def test_stream_equals_batch_of_closed_windows(spark, tmp_path, salts):
    events = sorted(random_events(120, 11), key=lambda e: e[10])
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    frame(spark, events).coalesce(1).write.json(source)
    stream = with_event_time(type_events(event_stream(spark, source)))
    query = (
        consumer.singleton_consumer(stream, salts=salts)
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    closed = max(e[10] for e in events) - dt.timedelta(seconds=5)
    batch = consumer.matched_windows(frame(spark, events))
    batch = batch.where(batch.right_Window_End_Time <= closed)
    expected = bag(consumer.listing_columns(consumer.singletons(batch)), "nome", "codigo", "preco")
    got = bag(spark.read.schema(schemas.LISTING).parquet(out), "nome", "codigo", "preco")
    assert got == expected and sum(got.values()) > 0


def test_adjusted_event_time(spark):
    late = list(event("a", "1", 0))
    late[8] = START + dt.timedelta(seconds=60)
    df = with_event_time(frame(spark, [tuple(late), event("b", "1", 0)]), late="adjust")
    got = {r.codigo: r.EventEnqueuedUtcTime for r in df.collect()}
    assert got == {"a": START + dt.timedelta(seconds=55), "b": START}
    with pytest.raises(ValueError):
        with_event_time(df, late="never")


def test_strict_discount(spark):
    row = list(event("a", "1", 0))
    row[0] = "15%"
    df = frame(spark, [tuple(row)])
    assert type_events(df).first().desconto == "15%"
    assert type_events(df, strict_discount_record=True).first().desconto is None


def test_state_is_dropped_over_many_triggers(spark, tmp_path):
    events = sorted(random_events(400, 13), key=lambda e: e[10])
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(0, 400, 80):
        frame(spark, events[i : i + 80]).coalesce(1).write.mode("append").json(source)
    stream = event_stream(spark, source, options={"maxFilesPerTrigger": "1"})
    query = (
        consumer.singleton_consumer(with_event_time(type_events(stream)))
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    closed = max(e[10] for e in events) - dt.timedelta(seconds=5)
    batch = consumer.matched_windows(frame(spark, events))
    batch = batch.where(batch.right_Window_End_Time <= closed)
    expected = bag(consumer.listing_columns(consumer.singletons(batch)), "nome")
    assert bag(spark.read.schema(schemas.LISTING).parquet(out), "nome") == expected
    last = query.recentProgress[-1].stateOperators
    join = next(op for op in last if op.operatorName == "symmetricHashJoin")
    # Events of the last twenty of sixty seconds may still wait for a window.
    assert join.numRowsTotal < 200


def test_broker_records_carry_product_events(spark):
    sent = frame(spark, [event("a", "1", 0, tag="ção"), event(None, "2", 1)])
    records = product_events(sent).selectExpr(
        "cast(value as binary) AS value", "3 AS partition", "timestamp'2025-01-01 00:00:07' AS timestamp"
    )
    got = type_events(decode_broker(records))
    assert got.columns == schemas.EVENT.names
    assert bag(got, *schemas.LISTING.names) == bag(sent, *schemas.LISTING.names)
    assert {(r.PartitionId, r.EventEnqueuedUtcTime) for r in got.collect()} == {
        (3, START + dt.timedelta(seconds=7))
    }
