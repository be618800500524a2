import random

import pytest
from pyspark.sql import functions as F

from promptframe.operators import ordering, sharding


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbers_follow_the_global_order(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "a", "z", None]), rng.randint(0, 50), i) for i in range(2000)]
    frame = spark.createDataFrame(rows, "k string, n int, id int").repartition(7)
    got = ordering.with_seq(frame, ["k", "n", "id"], ranges=6).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))
    assert [(r.k, r.n, r.id) for r in sorted(got, key=lambda r: r.seq)] == want
    assert sorted(r.seq for r in got) == list(range(2000))


def test_a_hot_value_spreads_over_ranges(spark):
    frame = spark.range(4000).select(F.lit("hot").alias("k"), "id")
    sizes = ordering.with_range(frame, ["k", "id"], 8).groupBy(ordering.RANGE).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 1000


def test_rows_are_not_gathered_in_one_task(spark):
    frame = spark.range(1000).withColumn("text", F.lit("x"))
    text = plan(ordering.with_seq(frame, ["id"], ranges=4))
    # The one single-partition exchange works on a row per range: it sits below the broadcast.
    assert text.count("SinglePartition") == 1
    assert text.index("BroadcastExchange") < text.index("SinglePartition")


def test_previous_row_crosses_ranges(spark):
    rows = [(b, t, random.Random(b * 100 + t).choice("xyz")) for b in range(3) for t in range(b * 200 + 1)]
    frame = spark.createDataFrame(rows, "b int, t int, s string").repartition(5)
    got = ordering.with_previous(frame, ["b", "t"], {"pb": "b", "ps": "s"}, ranges=9).collect()
    ordered = sorted(got, key=lambda r: (r.b, r.t))
    assert (ordered[0].pb, ordered[0].ps) == (None, None)
    assert all((now.pb, now.ps) == (before.b, before.s) for before, now in zip(ordered, ordered[1:]))


def test_empty_and_tiny_inputs(spark):
    none = spark.createDataFrame([], "id int")
    assert ordering.with_seq(none, ["id"]).count() == 0
    assert ordering.with_seq(spark.range(1), ["id"]).head().seq == 0


def greedy(sizes, max_requests, max_bytes):
    shards, held, filled = [], 0, 0
    for size in sizes:
        full = held and (held >= max_requests or filled + size > max_bytes)
        shards.append((shards[-1] if shards else 1) + bool(full))
        held, filled = (1, size) if full else (held + 1, filled + size)
    return shards


@pytest.mark.parametrize(
    ("lines", "max_requests", "max_bytes", "ranges"),
    [(10, 3, 10**9, 4), (1500, 50, 4000, 7), (300, 7, 300, 40), (1200, 700, 60_000, 9), (60, 1000, 150, 3)],
)
def test_packing_equals_the_sequential_rule(spark, lines, max_requests, max_bytes, ranges):
    rng = random.Random(lines)
    sizes = [rng.choice([rng.randint(1, 200), 30, 5000 if rng.random() < 0.05 else 7]) for _ in range(lines)]
    frame = spark.createDataFrame([(f"d{i:05}", s) for i, s in enumerate(sizes)], "id string, size long").repartition(6)
    packed = sharding.pack(frame, ["id"], F.col("size"), max_requests, max_bytes, ranges)
    assert [r.shard for r in packed.orderBy("id").collect()] == greedy(sizes, max_requests, max_bytes)


@pytest.mark.parametrize("fan_in", [2, 3, 16])
def test_packing_by_a_tree_of_any_fan_in(spark, monkeypatch, fan_in):
    monkeypatch.setattr(sharding, "FAN_IN", fan_in)
    rnd = random.Random(fan_in)
    sizes = [rnd.choice([1, 2, 9, 30, 70]) for _ in range(400)]
    frame = spark.createDataFrame(list(enumerate(sizes)), "id int, size int")
    packed = sharding.pack(frame, ["id"], F.col("size"), 6, 64, 23)
    assert [r.shard for r in packed.orderBy("id").collect()] == greedy(sizes, 6, 64)


def test_shard_files(spark, tmp_path):
    frame = spark.createDataFrame([(f"d{i}", "x" * i) for i in range(10)], "id string, line string")
    size = F.octet_length("line") + 1
    packed = sharding.pack(frame, ["id"], size, 3)
    summary = {r.shard: (r.requests, r.bytes) for r in sharding.review_summary(packed, size).collect()}
    assert summary == {None: (10, 55), 1: (3, 6), 2: (3, 15), 3: (3, 24), 4: (1, 10)}
    for _ in range(2):
        sharding.write_shards(packed, F.col("line"), str(tmp_path / "shards"), ["id"])
    manifest = sharding.shard_manifest(spark, str(tmp_path / "shards")).orderBy("shard").collect()
    assert [(r.shard, r.bytes) for r in manifest] == [(1, 6), (2, 15), (3, 24), (4, 10)]
    files = sorted(tmp_path.glob("shards/shard=*/part*"))
    assert len(files) == 4
    assert files[1].read_text() == "xxx\nxxxx\nxxxxx\n"
    assert manifest[0].batch_id == "batch_" + manifest[0].sha256[:16]
