import dataclasses
import datetime
import json

import pytest
from pyspark.sql import functions as F

from promptframe.operators import chain, inference, runlog
from promptframe.plans import job, recipes
from promptframe.sources.truth import prefix_map
from promptframe.streaming import files

MAILS = {
    "ham__1.eml": "From: bob@x.org\nSubject: Lunch\n\nShall we have lunch on Friday? Bring the notes.\n",
    "ham__2.eml": "From: ann@x.org\nSubject: Minutes\n\nThe minutes of the meeting are attached below.\n",
    "spam__1.eml": "From: win@x.biz\nSubject: Winner\n\nYou are a WINNER, claim the free money now!\n",
    "spam__2.txt": "From: win@x.biz\nSubject: Offer\n\nFree money, click here to claim your prize.\n",
    "ham__3.eml": "Subject: empty\n\n\n",
    "image.png": "x",
}


def scorer(payload, endpoint):
    text = payload["messages"][-1]["content"].lower()
    spam = "money" in text
    answer = {"classification": "spam" if spam else "ham", "confidence": 0.99 if spam else 0.04, "reason": "words"}
    return {"message": {"content": json.dumps(answer)}, "model": payload["model"]}


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    for name, text in MAILS.items():
        (tmp_path / "in" / name).write_text(text)
    return tmp_path


def test_job_from_folder_to_evaluation(spark, folder):
    recipe = recipes.spam_recipe()
    documents = recipe.reader.read(spark, str(folder / "in"))
    options = dict(
        folder=str(folder / "out"), model="m", prefixes=prefix_map(spark, {"spam": "spam", "ham": "ham"}),
        positive="spam", endpoints=["e"], rows_per_round=3,
    )
    result = job.run_job(documents, recipe, scorer, **options)
    assert [r.filename for r in result.dropped.collect()] == ["ham__3.eml"]
    assert result.requests.count() == result.records.count() == result.valid.count() == 4
    assert result.rejected.count() == 0
    summary = {r.metric: r.value for r in result.evaluation.summary.collect()}
    assert summary["accuracy"] == summary["macro_f1"] == summary["auc"] == 1.0

    def never(payload, endpoint):
        raise AssertionError("scored again")

    with pytest.raises(ValueError, match="another run"):
        job.run_job(documents, recipe, never, **options)
    again = job.run_job(documents, recipe, never, resume=True, **options)
    assert again.valid.count() == 4
    written = {p.name for p in (folder / "out").iterdir()}
    assert {"manifest", "shards", "submissions", "events", "export"} <= written
    assert (folder / "out" / "export" / "evaluation.json").exists()
    before = spark.read.parquet(str(folder / "out" / "requests")).collect()
    with pytest.raises(ValueError, match="other settings"):
        job.run_job(documents, recipe, never, resume=True, **{**options, "model": "other"})
    assert spark.read.parquet(str(folder / "out" / "requests")).collect() == before


def test_recipes(spark):
    pii = recipes.pii_recipe()
    frame = spark.createDataFrame(
        [("a", {"Subject": "s"}, "body long enough to be kept", (["x.pdf"],))],
        "custom_id string, headers map<string,string>, body string, metadata struct<attachment_names:array<string>>",
    )
    cleaned = job.clean_documents(frame, pii)
    text = cleaned.documents.select(pii.reader.package().alias("t")).head().t
    assert text == "Subject: s\n\nbody long enough to be kept\n\nAttachments:\n  - x.pdf"
    assert cleaned.dropped.count() == 0


def test_streams_equal_the_batch_steps(spark, folder):
    recipe = recipes.spam_recipe()
    documents = files.stream_documents(spark, str(folder / "in"), recipe)
    requests = files.stream_requests(documents, recipe, "m", "do")
    target, check = str(folder / "requests"), str(folder / "check")
    files.write_stream(requests, target, check, once=True).awaitTermination()
    assert spark.read.parquet(target).count() == 4
    (folder / "in" / "ham__9.eml").write_text(MAILS["ham__1.eml"])
    again = files.stream_requests(files.stream_documents(spark, str(folder / "in"), recipe), recipe, "m", "do")
    files.write_stream(again, target, check, once=True).awaitTermination()
    batch = job.requests_of(
        job.clean_documents(recipe.reader.read(spark, str(folder / "in")), recipe).documents, recipe, "m", "do"
    )
    got = sorted(r.custom_id for r in spark.read.parquet(target).collect())
    assert got == sorted(r.custom_id for r in batch.collect()) and len(got) == 5


def test_answer_stream(spark, folder):
    (folder / "answers").mkdir()
    message = {"type": "message", "content": [{"type": "output_text", "text": '{"a":1}'}]}
    line = json.dumps({"custom_id": "a", "response": {"body": {"output": [message]}}})
    (folder / "answers" / "1.jsonl").write_text(line + "\n\nbad\n")
    checked = files.stream_answers(spark, str(folder / "answers")).select("custom_id", "status")
    files.write_stream(checked, str(folder / "v"), str(folder / "c"), once=True).awaitTermination()
    assert sorted(r.status for r in spark.read.parquet(str(folder / "v")).collect()) == ["malformed", "valid"]


def test_stage_statistics_and_histogram(spark):
    events = spark.createDataFrame([("render", 50.0), ("render", 100.0), ("render", 150.0)], "step string, duration_ms double")
    assert tuple(runlog.step_statistics(events).head()) == ("render", 3, 300.0, 50.0, 150.0, 100.0)
    seconds = F.col("duration_ms") / 1000
    counts = {r.le: r.n for r in runlog.duration_histogram(events, ["step"], seconds, runlog.STEP_BUCKETS).collect()}
    assert counts[0.1] == 2 and counts[0.5] == 3 and counts[float("inf")] == 3 and len(counts) == 11


def test_progress(spark):
    frame = spark.createDataFrame(
        [(10, 3, 1, 2.0), (2, 3, 1, 2.0), (0, 0, 0, 0.0), (5, 0, 0, 3.0)], "t long, c long, f long, s double"
    )
    rows = [tuple(r)[4:] for r in runlog.progress(frame, "t", "c", "f", "s").collect()]
    assert rows == [
        (10, 4, 6, 40.0, 2.0, 2.0, 3.0),
        (4, 4, 0, 100.0, 2.0, 2.0, None),
        (0, 0, 0, 0.0, 0.0, None, None),
        (5, 0, 5, 0.0, 3.0, None, None),
    ]


def test_status_changes_and_age(spark):
    def at(s):
        return datetime.datetime(2024, 1, 1, 0, 0, s)

    polls = [("b", "run", at(1)), ("b", "run", at(2)), ("b", "done", at(5)), ("c", "done", at(1)), ("c", None, at(3)), ("c", None, at(4))]
    frame = spark.createDataFrame([(*p, i) for i, p in enumerate(polls)], "batch string, status string, at timestamp, id int")
    changes = runlog.status_changes(frame, "batch", "status", "at", "id", ranges=3)
    assert sorted(r.id for r in changes.collect()) == [0, 2, 3, 4]
    now = F.lit("2024-01-01 00:00:15").cast("timestamp")
    ages = {r.batch: (r.status, r.state_elapsed_seconds) for r in runlog.state_age(changes, "batch", "status", "at", "id", now).collect()}
    assert ages == {"b": ("done", 10.0), "c": (None, 12.0)}


def test_run_log(spark, tmp_path):
    for status in ("ok", "failed"):
        runlog.log_events(spark, str(tmp_path / "log"), [{"step": "render", "status": status, "duration_ms": 5.0}])
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.where("timestamp is null or level is null").count() == 0
    assert dict(runlog.outcome_counts(log, ["status"]).collect()) == {"ok": 1, "failed": 1}


def test_documents_are_transformed_once_and_repeated_ids_refused(spark, folder):
    calls = spark.sparkContext.accumulator(0)

    def count(row):
        calls.add(1)
        return {}

    recipe = dataclasses.replace(recipes.spam_recipe(), transforms=(chain.RowTransform("count", count),))
    documents = recipe.reader.read(spark, str(folder / "in"))
    job.run_job(documents, recipe, scorer, folder=str(folder / "one"), model="m", endpoints=["e"])
    assert calls.value == 4
    with pytest.raises(ValueError, match="duplicate"):
        job.run_job(documents.unionByName(documents), recipe, scorer, folder=str(folder / "two"), model="m", endpoints=["e"])
    assert not (folder / "two" / "records").exists()


def test_scoring_goes_on_with_other_rounds(spark, tmp_path):
    def chats(n):
        return spark.range(n).select(F.col("id").alias("seq"), F.concat(F.lit("c"), "id").alias("custom_id"))

    scored = spark.sparkContext.accumulator(0)

    def score(df):
        def seen(batches):
            for b in batches:
                scored.add(len(b))
                yield b

        return df.mapInPandas(seen, df.schema)

    target = str(tmp_path / "records")
    inference.score_resumable(chats(8), score, target, 5)
    out = inference.score_resumable(chats(20), score, target, 10)
    again = inference.score_resumable(chats(20), score, target, 3)
    assert out.count() == again.select("custom_id").distinct().count() == 20 and scored.value == 20


def test_an_endpoint_listed_twice_gets_two_shares(spark):
    chats = spark.range(30).select(F.col("id").alias("seq"), F.col("id").cast("string").alias("custom_id"), F.struct(F.lit(1)).alias("payload"))
    done = inference.run_inference(chats, lambda p, e: {}, ["a", "b", "a"], 2)
    assert dict(done.groupBy("endpoint").count().collect()) == {"a": 20, "b": 10}
    four = inference.run_inference(chats, lambda p, e: {}, ["a", "b"], 1, shards=3)
    assert dict(four.groupBy("endpoint").count().collect()) == {"a": 20, "b": 10}
