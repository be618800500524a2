import json

import pytest
from pyspark.sql import functions as F

from promptframe.operators import inference, ordering, render, validate
from promptframe.operators.contract import SPAM_CONTRACT, Contract, Field
from promptframe.sources.lines import parse_requests

SIMPLE = Contract("S", (Field("label", "string"), Field("confidence", "number")))


def record(custom_id, text, **more):
    message = {"type": "message", "content": [{"type": "output_text", "text": text}]}
    return {"custom_id": custom_id, "error": None, "response": {"status_code": 200, "body": {"output": [message]}}, **more}


def frame(spark, records):
    texts = [r if isinstance(r, str) else json.dumps(r) for r in records]
    return validate.parse_outputs(spark.createDataFrame([(t,) for t in texts], "line string"))


def test_statuses(spark):
    records = [
        record("ok", '{"label":"spam","confidence":0.9}'),
        record("extra", '{"label":"spam","confidence":0.9,"x":1}'),
        record("err", "{}", error={"code": "E"}),
        record("text_err", "{}", error="boom"),
        record("bad", "not valid json {{{"),
        {"custom_id": "none", "response": None},
        {"custom_id": "odd", "response": {"body": {"output": [3, {"type": "message", "content": "x"}]}}},
        {"custom_id": "null_body", "response": {"body": None}},
        "{broken",
    ]
    checked = validate.validate_outputs(frame(spark, records), SIMPLE)
    status = {r.custom_id: r.status for r in checked.collect()}
    assert status == {
        "ok": "valid", "extra": "invalid", "err": "skipped", "text_err": "skipped", "bad": "invalid", "none": "skipped",
        "odd": "skipped", "null_body": "skipped", "": "malformed",
    }
    assert validate.valid_rows(checked).count() == 1 and validate.quarantine(checked).count() == 8
    counts = dict(validate.validation_counts(checked).collect())
    assert counts == {"valid": 1, "invalid": 2, "skipped": 5, "malformed": 1, "total": 9}
    with pytest.raises(Exception, match="no JSON"):
        validate.validate_outputs(frame(spark, records), SIMPLE, malformed="fail").collect()


def test_without_contract_any_json_is_valid(spark):
    records = [record("a", "3"), record("b", '{"x":1}'), record("c", ""), record("d", '{"x":1}\n```')]
    rows = {r.custom_id: r.status for r in validate.validate_outputs(frame(spark, records)).collect()}
    assert rows == {"a": "valid", "b": "valid", "c": "invalid", "d": "invalid"}


def test_output_text_takes_first_non_empty(spark):
    def output(*items):
        return {"custom_id": "x", "response": {"body": {"output": list(items)}}}

    def message(*texts):
        return {"type": "message", "content": [{"type": "output_text", "text": t} for t in texts]}

    records = [
        output(message("", "second")),
        output(message(""), message("later")),
        output(message("")),
        output({"type": "reasoning", "content": [{"type": "output_text", "text": "no"}]}),
        output({"type": "message", "content": [{"type": "refusal", "text": "no"}]}),
        output(message(None, "b")),
    ]
    got = [r.raw_text for r in frame(spark, records).collect()]
    assert got == ["second", "later", "", None, None, "b"]


def documents(spark, n=12):
    rows = [(f"d{i:02}", {"From": "a", "Subject": "s" if i % 2 else ""}, f"text {i} é\n") for i in range(n)]
    return spark.createDataFrame(rows, "custom_id string, headers map<string,string>, body string")


def test_request_line(spark):
    block = SPAM_CONTRACT.text_format()
    requests = render.render_requests(documents(spark), render.package_text(), "m", "do", block)
    line = json.loads(requests.select(render.request_line(requests).alias("x")).orderBy("x").head().x)
    assert line == {
        "custom_id": "d00",
        "method": "POST",
        "url": "/v1/responses",
        "body": {
            "model": "m",
            "instructions": "do",
            "input": [{"role": "user", "content": [{"type": "input_text", "text": "From: a\n\ntext 0 é\n"}]}],
            "text": json.loads(json.dumps(block)),
        },
    }
    assert list(line["body"]["text"]["format"]["schema"]["properties"]) == SPAM_CONTRACT.names
    plain = render.render_requests(documents(spark), F.lit("t"), "m", "do")
    assert "text" not in json.loads(plain.select(render.request_line(plain).alias("x")).head().x)["body"]
    back = parse_requests(requests.select(render.request_line(requests).alias("line")))
    assert render.require_valid_requests(back, "malformed").count() == 12


def test_body_is_cut_on_request_only(spark):
    long = spark.createDataFrame([({}, "é" * 40_000)], "headers map<string,string>, body string")
    lengths = long.select(
        F.length(render.package_text()), F.length(render.package_text(max_chars=30_000)), render.is_cut(30_000), render.is_cut(40_000)
    ).head()
    assert tuple(lengths) == (40_001, 30_001, True, False)


def test_chat_schema_is_a_constant_or_found_by_text(spark):
    block = SPAM_CONTRACT.text_format()
    requests = render.render_requests(documents(spark), F.lit("t"), "m", "do", block)
    one, other = (render.to_chat(requests, "m", text_format=x).select("custom_id", "payload.format") for x in (block, None))
    assert sorted(one.collect()) == sorted(other.collect())
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_no_text_can_hold_its_own_mark(spark, column):
    from promptframe.functions.answers import parse_whole

    texts = ['{"a":1}', '{"a":1},"⟂"', '{"a":1},"⟂"] and more', '{"a":1} x', '{"a":1},{"b":2}', "1] [2"]
    whole = column(texts, F.to_json(parse_whole("x")))
    assert whole == ['{"a":1}', None, None, None, None, None]


def test_request_checks(spark):
    good = render.render_requests(documents(spark), F.lit("t"), "m", "do")
    other = good.withColumn("body", F.col("body").withField("model", F.lit("n")))
    renamed = other.withColumn("custom_id", F.concat(F.lit("x"), "custom_id"))
    for broken, message in [
        (good.union(good), "duplicate"),
        (good.where("false"), "no requests"),
        (good.union(renamed), "mixed models"),
        (good.withColumn("method", F.lit("GET")), "POST"),
        (good.withColumn("url", F.lit("x")), "url"),
        (good.withColumn("custom_id", F.lit("")), "custom_id"),
    ]:
        with pytest.raises(ValueError, match=message):
            render.require_valid_requests(broken)


def test_chat_payload(spark):
    requests = render.render_requests(documents(spark), F.lit("t"), "m", "do", SPAM_CONTRACT.text_format())
    row = render.to_chat(requests, "small").orderBy("custom_id").head().payload
    assert [(m.role, m.content) for m in row.messages] == [("system", "do"), ("user", "t")]
    schema = json.loads(row.format)
    assert schema["properties"]["confidence"] == {"type": "number"} and row.model == "small" and row.stream is False
    silent = render.override_prompt(requests, "")
    assert render.to_chat(silent.withColumn("body", F.col("body").withField("instructions", F.lit(""))), "m").head().payload.messages[0].role == "user"


def scored(spark, scorer, **options):
    requests = render.render_requests(documents(spark), render.package_text(), "m", "do")
    chats = render.to_chat(ordering.with_seq(requests, ["custom_id"]), "m", keep=["seq"])
    return inference.run_inference(chats, scorer, **{"endpoints": ["e1", "e2"], "backoff": 0.0, **options})


def test_inference_retries_and_records(spark, tmp_path):
    seen = str(tmp_path)

    def scorer(payload, endpoint):
        import os

        text = payload["messages"][-1]["content"]
        if "text 3 " in text:
            raise TimeoutError("slow")
        if "text 4 " in text and not os.path.exists(f"{seen}/4"):
            open(f"{seen}/4", "w").close()
            raise ConnectionError("once")
        return {"message": {"content": '{"label":"a"}'}, "model": "m", "prompt_eval_count": 2}

    results = scored(spark, scorer, parallel=2)
    assert results.rdd.getNumPartitions() == 4
    good, bad = inference.split_outputs(inference.output_records(results, keep=["seq"]), str(tmp_path / "out"))
    assert [r.custom_id for r in bad.collect()] == ["d03"] and bad.head().error.code == "TimeoutError"
    assert good.count() == 11 and bad.head().response is None
    usage = inference.usage_totals(good).head()
    assert (usage.requests, usage.input_tokens, usage.output_tokens) == (11, 22, 0)
    again = {r.custom_id: r for r in results.collect()}
    assert again["d03"].attempts == 3 and again["d00"].endpoint == "e1" and again["d01"].endpoint == "e2"
    inference.write_outputs(good.union(bad), str(tmp_path / "files"))
    names = [json.loads(r.value)["custom_id"] for r in spark.read.text(str(tmp_path / "files/output.jsonl")).collect()]
    assert sorted(names) == sorted(r.custom_id for r in good.collect())
    line = json.loads(spark.read.text(str(tmp_path / "files/errors.jsonl")).head().value)
    assert line == {"custom_id": "d03", "error": {"code": "TimeoutError", "message": "slow"}, "response": None}
    row = inference.submission_summary(good.union(bad), [], F.lit(4.0)).head()
    assert (row.completed_requests, row.failed_requests, row.status) == (11, 1, "completed_with_errors")
    assert row.requests_per_second == 11 / 4.0


def test_other_errors_fail_or_are_recorded(spark):
    def scorer(payload, endpoint):
        raise KeyError("x")

    with pytest.raises(Exception):
        scored(spark, scorer).collect()
    rows = scored(spark, scorer, on_error="record").collect()
    assert {(r.error.code, r.attempts) for r in rows} == {("KeyError", 1)}


def test_record_ids_on_request(spark):
    result = scored(spark, lambda p, e: {"message": {"content": "x"}})
    body = inference.output_records(result, with_ids=True).head().response
    assert body.request_id.startswith("chat_") and len(body.body.id) == len("chat_") + 32
