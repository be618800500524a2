import json

import pytest
from pyspark.sql import functions as F

from promptframe.sources import documents, emails, lines, prompts, steps, truth

HAM = "From: a@x.org\nTo: b@x.org\nSubject: =?utf-8?q?Caf=C3=A9?=\nDate: Mon, 1 Jan 2024 10:00:00 +0000\n\nHello there.\n"
HTML = 'Subject: h\nContent-Type: text/html; charset="utf-8"\n\n<html><head><style>p{}</style></head><body><p>Hi</p></body></html>\n'
PARTS = """Subject: m
MIME-Version: 1.0
Content-Type: multipart/mixed; boundary="b"

--b
Content-Type: multipart/alternative; boundary="c"

--c
Content-Type: text/plain; charset="utf-8"

plain part
--c
Content-Type: text/html; charset="utf-8"

<p>html part</p>
--c--
--b
Content-Type: text/plain; charset="no-such-charset"
Content-Disposition: attachment; filename="notes.txt"

more
--b--
"""


@pytest.fixture
def folder(tmp_path):
    for name, text in {"ham.eml": HAM, "html.TXT": HTML, "parts": PARTS, "x+y %.msg": HAM, "skip.csv": HAM, "a.PNG": "x"}.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "inner.eml").write_text(HAM)
    return str(tmp_path)


def test_only_accepted_files_are_opened(spark, folder):
    found = documents.read_documents(spark, folder)
    assert sorted(r.custom_id for r in found.select("custom_id").collect()) == ["ham.eml", "html.TXT", "parts", "x+y %.msg"]
    leaf = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    found.collect()
    assert leaf.metadata().get("PushedFilters").isDefined()
    assert leaf.inputRDDs().head().getNumPartitions() >= 1
    assert "content" not in documents.list_documents(spark, folder)._jdf.queryExecution().executedPlan().toString()


def test_emails(spark, folder):
    parsed = emails.as_messages(emails.parse_emails(documents.read_documents(spark, folder)))
    rows = {r.custom_id: r for r in parsed.collect()}
    ham, html, parts = rows["ham.eml"], rows["html.TXT"], rows["parts"]
    assert ham.headers["Subject"] == "Café" and "Cc" not in ham.headers
    assert ham.body == "Hello there.\n" and ham.metadata.content_type == "text/plain" and ham.metadata.num_parts == 1
    assert html.body == "Hi"
    # A part in an unknown charset has no text.
    assert parts.body == "plain part" and parts.metadata.num_parts == 5
    assert parts.metadata.attachment_names == ["notes.txt"]


def test_email_errors_are_kept_or_fail(spark):
    frame = spark.createDataFrame([("a", bytearray(b"Subject: x\n\nbody")), ("b", None)], "custom_id string, content binary")
    rows = {r.custom_id: r.parse_error for r in emails.parse_emails(frame).collect()}
    assert rows["a"] is None and rows["b"]
    with pytest.raises(Exception):
        emails.parse_emails(frame, on_error="fail").collect()


def test_truth_csv(spark, tmp_path):
    def labels(text, **options):
        path = tmp_path / "t.csv"
        path.write_text(text, encoding="utf-8")
        return dict(truth.read_truth_csv(spark, str(path), **options).collect())

    assert labels("filename,label\na.eml,Spam\nb.eml, ham \n") == {"a.eml": "spam", "b.eml": "ham"}
    assert labels("a.eml,spam\nb.eml,ham\na.eml,HAM\n") == {"a.eml": "ham", "b.eml": "ham"}
    assert labels("a.eml,\nb.eml\n ,x\nc.eml,x,extra\n") == {"a.eml": "", "c.eml": "x"}
    assert labels('"a,1.eml",spam\n"two\nlines",ham\n"q""q",x\n') == {"a,1.eml": "spam", "two\nlines": "ham", 'q"q': "x"}
    assert labels("first,spam\nb.eml,ham\n") == {"b.eml": "ham"}
    assert labels("first,spam\nb.eml,ham\n", header=False) == {"first": "spam", "b.eml": "ham"}
    assert labels("") == {}


def test_prefix_map(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"Spam": "SPAM", "ham": "ham", "SPAM": "other"}')
    assert dict(truth.read_prefix_map(spark, str(tmp_path / "m.json")).collect()) == {"spam": "SPAM", "ham": "ham"}


def test_prompts(spark, tmp_path):
    assert prompts.read_prompt(spark) == prompts.DEFAULT_PROMPT
    (tmp_path / "prompt.txt").write_text(" job \n")
    (tmp_path / "p.txt").write_text("named\n")
    assert prompts.read_prompt(spark, job_folder=tmp_path.as_uri()) == "job"
    assert prompts.read_prompt(spark, (tmp_path / "p.txt").as_uri(), tmp_path.as_uri()) == "named"
    assert prompts.prompt_override(spark, "inline", str(tmp_path / "p.txt")) == "inline"
    assert prompts.prompt_override(spark, None, str(tmp_path / "p.txt")) == "named"
    assert prompts.prompt_override(spark) is None
    with pytest.raises(FileNotFoundError):
        prompts.read_prompt(spark, (tmp_path / "none.txt").as_uri())


def test_answer_files(spark, tmp_path):
    for name in ("b.jsonl", "a.jsonl", "errors.jsonl", "status_history.jsonl", "other.txt"):
        (tmp_path / name).write_text(f'{{"f":"{name}"}}\n\n  \n')
    found = lines.read_outputs(spark, str(tmp_path))
    assert sorted(json.loads(r.line)["f"] for r in found.collect()) == ["a.jsonl", "b.jsonl"]
    (tmp_path / "output.jsonl").write_text("{}\n")
    assert [r.line for r in lines.read_outputs(spark, str(tmp_path)).collect()] == ["{}"]


def test_request_lines(spark):
    texts = [
        '{"custom_id":"a","method":"POST","url":"u","body":{"model":"m","instructions":"i","input":'
        '[{"content":["bare",{"type":"input_text"},{"type":"image","text":"x"}]},{"role":"tool"}],'
        '"text":{"format":{"type":"json_schema","name":"n","schema":{"type":"object"},"strict":true}}}}',
        '{"custom_id":"b"}',
        "{broken",
    ]
    rows = lines.parse_requests(spark.createDataFrame([(t,) for t in texts], "line string")).collect()
    first = rows[0].body
    assert [(p.type, p.text) for p in first.input[0].content] == [("input_text", "bare"), ("input_text", ""), ("image", "x")]
    assert (first.input[0].role, first.input[1].role, first.input[1].content) == ("user", "tool", [])
    assert json.loads(first.text.format.schema) == {"type": "object"} and first.text.format.strict is True
    assert [r.malformed for r in rows] == [False, False, True]
    assert rows[1].body.text.format is None and rows[2].custom_id is None


def test_step_tables(spark, tmp_path):
    frame = spark.createDataFrame([('{"filename":"a","x":[1]}',), ("bad",)], "t string")
    frame.write.text(str(tmp_path / "v"))
    valid = steps.read_validated_json(spark, str(tmp_path / "v"))
    again = steps.write_step(valid, str(tmp_path), "valid")
    assert again.select("custom_id", F.to_json("data")).collect() == [("a", '{"filename":"a","x":[1]}')]
    (tmp_path / "e.json").write_text(json.dumps({"per_class": [{"label": "a", "tp": 2, "fp": 0, "fn": 2}]}))
    row = steps.read_evaluation(spark, (tmp_path / "e.json").as_uri())["per_class"][0]
    assert (row["support"], row["precision"], row["recall"]) == (4, 1.0, 0.5)
    for _ in range(2):
        steps.append_rows(spark.range(1), str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
