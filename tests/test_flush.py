import json
import time
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pytest
from helpers import bag, listings
from pyspark.sql import functions as F
from vitrine import schemas
from vitrine.sources.listings import listing_batch, listing_stream
from vitrine.streaming.flush import _lines, _packed, flushed, write_flushed


def adverts(spark, first, n):
    rows = [dict(codigo=str(i), nome="ção", preco=None, extract=f"2025-10-05 {i % 2:02d}:00") for i in range(first, first + n)]
    return listings(spark, *rows)


def sizes(path):
    """Rows of each flush as (lane, flush, reason)."""
    found = Counter()
    for file in Path(path).rglob("*.txt"):
        parts = dict(p.split("=", 1) for p in file.parts if "=" in p)
        found[int(parts["lane"]), int(parts["flush"]), parts["reason"]] += len(file.read_text().splitlines())
    return dict(found)


def wait_for(query, path, rows, seconds=60):
    end = time.time() + seconds
    while sum(sizes(path).values()) < rows:
        assert query.exception() is None, query.exception()
        assert time.time() < end, sizes(path)
        time.sleep(0.3)


def wait_for_input(query, rows, seconds=60):
    """Timers make the stream tick for ever, so it is never "all processed"."""
    end = time.time() + seconds
    while sum(p.numInputRows for p in query.recentProgress) < rows:
        assert query.exception() is None, query.exception()
        assert time.time() < end
        time.sleep(0.2)


@pytest.fixture
def running(spark, tmp_path):
    queries = []

    def start(age, rows=10):
        stream = listing_stream(spark, str(tmp_path / "in")).withColumn("at", F.to_timestamp("extract"))
        due = flushed(stream, "at", rows, age, lane=F.col("codigo").cast("long") % 2)
        queries.append(write_flushed(due, str(tmp_path / "out"), str(tmp_path / "c"), "200 milliseconds", by_flush=True))
        return queries[-1]

    yield start
    for query in queries:
        query.stop()


def test_by_rows_then_by_age(spark, tmp_path, running):
    adverts(spark, 0, 50).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    query = running(age=3)
    wait_for(query, tmp_path / "out", 50)
    # 25 rows in each lane: two flushes of ten at once, five rows when they are three seconds old.
    assert sizes(tmp_path / "out") == {(lane, f, r): n for lane in (0, 1) for f, r, n in ((0, "rows", 10), (1, "rows", 10), (2, "age", 5))}
    back = listing_batch(spark, str(tmp_path / "out"))
    assert bag(back, *schemas.LISTING.names) == bag(adverts(spark, 0, 50))
    folders = {p.name for p in (tmp_path / "out").glob("folder=*")}
    assert folders == {"folder=2025-10-05_00", "folder=2025-10-05_01"}
    line = next((tmp_path / "out").rglob("*.txt")).read_text().splitlines()[0]
    assert json.loads(line)["preco"] is None and "ção" in line


def test_rows_wait_over_triggers_and_restarts(spark, tmp_path, running):
    adverts(spark, 0, 8).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    query = running(age=600)
    wait_for_input(query, 8)
    assert sizes(tmp_path / "out") == {}  # four rows in each lane wait
    query.stop()
    query = running(age=600)
    adverts(spark, 8, 14).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    wait_for(query, tmp_path / "out", 20)
    wait_for_input(query, 14)
    assert sizes(tmp_path / "out") == {(0, 0, "rows"): 10, (1, 0, "rows"): 10}


def test_a_backlog_reaches_its_lane_as_blocks(spark, tmp_path):
    n = 40_000
    rows = spark.range(n).selectExpr(
        "cast(id as string) AS codigo", "repeat('ção ', 20) AS nome", "if(id % 5 = 0, NULL, 'p') AS preco",
        "if(id % 7 = 0, NULL, timestamp'2025-10-05 01:00:00') AS at",
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    due = flushed(stream, "at", 1000, 1, lane=F.col("codigo").cast("long") % 3)
    query = write_flushed(due, str(tmp_path / "out"), str(tmp_path / "c"), "200 milliseconds", by_flush=True)
    try:
        wait_for(query, tmp_path / "out", n)
        plan = query._jsq.explainInternal(False)
    finally:
        query.stop()
    found = sizes(tmp_path / "out")
    for lane in range(3):
        held = len(range(lane, n, 3))
        assert sorted(v for (at, *_), v in found.items() if at == lane) == sorted([1000] * (held // 1000) + [held % 1000])
    back = spark.read.json(str(tmp_path / "out")).selectExpr("codigo", "folder = '2025-10-05_01' AS dated")
    assert bag(back) == bag(rows.selectExpr("codigo", "if(at IS NULL, NULL, true) AS dated"))
    # Neither what a lane's task sorts nor what it sends on are single lines.
    assert plan.count("MapInArrow") == 2 and plan.count("Exchange hashpartitioning(lane") == 2


def test_lines_of_a_lane_are_one_block():
    folders, lanes = ["a", None, "b", "a"], pa.array([1, None, 1, None], pa.int64())
    (out,) = _packed([pa.RecordBatch.from_pydict({"folder": folders, "line": ["1", "2", "3", "4"], "lane": lanes})])
    found = {row["lane"]: _lines(row["size"], row["lines"]) for row in out.to_pylist()}
    assert found == {1: ["a\t1", "b\t3"], None: ["\t2", "a\t4"]}
