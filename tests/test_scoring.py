"""Scores that are committed while they are made, with tasks and drivers that stop."""

import json
import os
import subprocess
import sys
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from promptframe.operators import inference, runlog
from promptframe.sources import score_log
from promptframe.sources.steps import put_rows


def chats(spark, n):
    payload = F.struct(F.col("id").alias("n"))
    rows = spark.range(n).select(F.col("id").alias("seq"), F.concat(F.lit("c"), "id").alias("custom_id"), payload.alias("payload"))
    return rows


def table(spark, folder, n):
    path = f"{folder}/chats"
    chats(spark, n).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def answer(payload):
    return {"message": {"content": str(payload["n"])}, "model": "m"}


def noted(folder):
    """A scorer that leaves a file for each call."""

    def score(payload, endpoint):
        open(f"{folder}/{payload['n']}-{time.time_ns()}", "w").close()
        return answer(payload)

    return score


def calls(folder):
    return Counter(int(name.split("-")[0]) for name in os.listdir(folder))


@pytest.fixture
def seen(tmp_path):
    (tmp_path / "seen").mkdir()
    return str(tmp_path / "seen")


def check(found, n):
    rows = found.collect()
    assert sorted(r.seq for r in rows) == list(range(n))
    assert all(r.response.message.content == str(r.seq) and r.custom_id == f"c{r.seq}" for r in rows)


def test_scores_equal_the_plain_way(spark, tmp_path, seen):
    rows, log = table(spark, tmp_path, 95), str(tmp_path / "log")
    found = inference.score_committed(rows, noted(seen), log, ["a", "b", "a"], 2, block_rows=7)
    check(found, 95)
    plain = inference.run_inference(rows, lambda p, e: answer(p), ["a", "b", "a"], 2)
    columns = ["seq", "custom_id", "endpoint", "response", "error", "attempts"]
    assert sorted(map(str, found.select(columns).collect())) == sorted(map(str, plain.select(columns).collect()))
    told = json.load(open(f"{log}/closed/run-000001/_blocks.json"))
    assert sum(x["rows"] for x in told) == 95 and all(len(x["blocks"]) == -(-x["rows"] // 7) for x in told)


def test_nothing_is_scored_twice_and_more_requests_go_on(spark, tmp_path, seen):
    log, score = str(tmp_path / "log"), noted(seen)
    inference.score_committed(table(spark, tmp_path, 30), score, log, ["a"], 2, block_rows=4)
    inference.score_committed(table(spark, tmp_path, 30), score, log, ["a"], 3, block_rows=4)
    found = inference.score_committed(table(spark, tmp_path, 55), score, log, ["a", "b"], 1, block_rows=10)
    check(found, 55)
    assert set(calls(seen).values()) == {1} and len(calls(seen)) == 55


@pytest.mark.parametrize("bad", [0, 17, 29])
def test_a_failing_task_keeps_its_blocks(spark, tmp_path, seen, bad):
    log, score = str(tmp_path / "log"), noted(seen)

    def fails(payload, endpoint):
        if payload["n"] == bad:
            raise RuntimeError("stopped")
        return score(payload, endpoint)

    rows = table(spark, tmp_path, 30)
    with pytest.raises(Exception, match="stopped"):
        inference.score_committed(rows, fails, log, ["a"], 1, block_rows=5)
    check(inference.score_committed(rows, score, log, ["a"], 1, block_rows=5), 30)
    # Only the block that was being made is made again.
    assert all(n == 1 or k // 5 == bad // 5 for k, n in calls(seen).items())


def test_what_a_dead_run_writes_later_is_not_read(spark, tmp_path, seen):
    log, score = str(tmp_path / "log"), noted(seen)
    rows = table(spark, tmp_path, 20)
    inference.score_committed(rows, score, log, ["a"], block_rows=5)
    late = f"{log}/open/run-000001"
    os.makedirs(late)
    block = next(n for n in os.listdir(f"{log}/closed/run-000001") if n.endswith(".parquet"))
    os.link(f"{log}/closed/run-000001/{block}", f"{late}/000009-000000.parquet")
    assert score_log.read_log(spark, log, inference._RESULT).count() == 20


DRIVER = """
import os, sys, time
sys.path[:0] = [{repo!r}, {tests!r}]
import test_scoring
from promptframe.operators import inference
from promptframe.session import local_session
spark = local_session(2, partitions=2)
slow = test_scoring.noted({seen!r})
def score(payload, endpoint):
    time.sleep(0.05)
    return slow(payload, endpoint)
inference.score_committed(spark.read.parquet({chats!r}), score, {log!r}, ["a"], 2, block_rows=5)
"""


def test_a_killed_driver_in_the_first_round(spark, tmp_path, seen):
    rows, log = table(spark, tmp_path, 400), str(tmp_path / "log")
    tests = os.path.dirname(os.path.abspath(__file__))
    code = DRIVER.format(repo=os.path.dirname(tests), tests=tests, seen=seen, chats=f"{tmp_path}/chats", log=log)
    driver = subprocess.Popen([sys.executable, "-c", code], start_new_session=True)
    try:
        for _ in range(600):
            if len(os.listdir(seen)) >= 60:
                break
            time.sleep(0.1)
    finally:
        os.killpg(driver.pid, 9)
        driver.wait()
    before = len(os.listdir(seen))
    assert 60 <= before < 400
    found = inference.score_committed(rows, noted(seen), log, ["a", "b"], 2, block_rows=50)
    check(found, 400)
    # At most a block a partition was lost.
    assert 400 <= sum(calls(seen).values()) <= 400 + 2 * 5


def test_calls_in_flight_of_each_endpoint(spark, tmp_path, seen):
    def score(payload, endpoint):
        began = time.time()
        time.sleep(0.2 if endpoint == "slow" else 0.01)
        with open(f"{seen}/{payload['n']}-{time.time_ns()}", "w") as out:
            json.dump([endpoint, began, time.time()], out)
        return answer(payload)

    inference.score_committed(table(spark, tmp_path, 60), score, str(tmp_path / "log"), ["slow", "quick"], 2, block_rows=3)
    spans = [json.load(open(f"{seen}/{n}")) for n in os.listdir(seen)]
    for endpoint in ("slow", "quick"):
        own = [(b, e) for name, b, e in spans if name == endpoint]
        assert len(own) == 30
        assert max(sum(b <= at < e for b, e in own) for at, _ in own) <= 2


def test_events_of_a_step_that_is_done_again(spark, tmp_path):
    log = str(tmp_path / "events")
    for spent in (5.0, 7.0):
        for step in ("records", "export"):
            event = {"batch_name": "b", "step": step, "status": "completed", "duration_ms": spent}
            runlog.log_events(spark, log, [event], keys=["batch_name", "step"])
    rows = spark.read.parquet(log).collect()
    assert sorted((r.step, r.duration_ms) for r in rows) == [("export", 7.0), ("records", 7.0)]


def test_manifest_rows_of_a_rerun(spark, tmp_path):
    folder = str(tmp_path / "manifest")
    for batch, n in (("a", 1), ("b", 2), ("a", 3)):
        put_rows(spark.createDataFrame([(batch, n)], "batch string, n int"), folder, ["batch"])
    assert sorted((r.batch, r.n) for r in spark.read.parquet(folder).collect()) == [("a", 3), ("b", 2)]
