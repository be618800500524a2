"""One query per operator or group of operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import corpus as C
from promptframe.functions.text import (
    clean_xml,
    fingerprint,
    html_to_text_basic,
    squeeze_whitespace,
    token_estimate,
)
from promptframe.operators import chain, evaluate, inference, ordering, render, reports, runlog, sharding, truth, validate
from promptframe.operators.schema import SchemaContract
from promptframe.operators.contract import PII_CONTRACT, SPAM_CONTRACT, Contract, Field, contract_from_json_schema
from promptframe.plans import job, recipes
from promptframe.session import durable, ensure_checkpoint_dir
from promptframe.sources.documents import accepts_mail_name
from promptframe.sources.emails import parse_emails
from promptframe.sources.lines import parse_requests
from promptframe.sources.truth import last_label_wins, prefix_map, read_truth_csv

MODEL, PROMPT = "small-1", "Classify the message."


def six(name: str):
    return F.round(name, 6).alias(name)


# Documents, filters, transforms


def can_read(spark: SparkSession, folder: str) -> DataFrame:
    docs = C.corpus(spark, folder)
    return docs.select("custom_id", accepts_mail_name("custom_id").alias("accepted"))


def emails(spark: SparkSession, folder: str) -> DataFrame:
    head = "Subject: note\nMIME-Version: 1.0\nContent-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: 8bit\n"
    docs = C.table(spark, folder, "documents")
    raw = F.concat(F.lit("From: "), "source", F.lit("@example.org\n" + head + "\n"), "text").cast("binary")
    parsed = parse_emails(docs.select("doc_id", raw.alias("content")))
    return parsed.select(
        "doc_id",
        F.col("headers")["From"].alias("sender"),
        F.col("headers")["Subject"].alias("subject"),
        "body",
        F.col("metadata.content_type").alias("content_type"),
        F.col("metadata.num_parts").alias("num_parts"),
    )


SUFFIXES = [
    "", ".EML", ".txt", ".msg", ".unknown", ".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tiff", ".webp", ".PDF", ".doc", ".docx",
    ".xls", ".xlsx", ".ppt", ".pptx", ".zip", ".gz", ".tar", ".bz2", ".7z", ".rar", ".mp3", ".mp4", ".avi", ".mov", ".wav",
    ".exe", ".dll", ".so", ".dylib", ".py", ".js", ".ts", ".css", ".html", ".json", ".xml", ".csv", ".toml", ".yaml", ".yml",
    ".ini", ".cfg", ".conf", ".md", ".rst", ".log",
]


def all_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    ends = F.element_at(F.array(*[F.lit(x) for x in SUFFIXES]), (F.col("doc_id") % len(SUFFIXES) + 1).cast("int"))
    names = C.table(spark, folder, "documents").select("doc_id", F.concat(F.lit("f"), ends).alias("name"))
    return names.select("doc_id", accepts_mail_name("name").alias("accepted"))


PHRASES = [
    "Out of Office: x", "Automatic reply", "an AUTO-REPLY", "autoreply", "Delivery Status Notification (Failure)",
    "Undeliverable: y", "vacation reply", "plain",
]


def all_phrases(spark: SparkSession, folder: str) -> DataFrame:
    subject = F.element_at(F.array(*[F.lit(x) for x in PHRASES]), (F.col("doc_id") % len(PHRASES) + 1).cast("int"))
    docs = C.table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("custom_id"), F.create_map(F.lit("Subject"), subject).alias("headers")
    )
    return chain.drop_audit(chain.mark_rejects(docs, [chain.auto_reply_filter()]))


def _marked(spark: SparkSession, folder: str) -> DataFrame:
    filters = [chain.empty_body_filter(), chain.min_length_filter(), chain.auto_reply_filter()]
    return chain.mark_rejects(C.corpus(spark, folder), filters)


def filter_chain(spark: SparkSession, folder: str) -> DataFrame:
    return chain.kept(_marked(spark, folder)).select("custom_id")


def drop_audit(spark: SparkSession, folder: str) -> DataFrame:
    return chain.drop_audit(_marked(spark, folder))


def filter_counts(spark: SparkSession, folder: str) -> DataFrame:
    return chain.filter_counts(_marked(spark, folder))


def _two_passes() -> recipes.Recipe:
    return recipes.Recipe(
        "two_passes",
        recipes.spam_recipe().reader,
        SPAM_CONTRACT,
        filters=(chain.empty_body_filter(),),
        transforms=(chain.trim_whitespace(),),
        filters_after=(chain.min_length_filter(min_chars=60), chain.auto_reply_filter()),
    )


def two_pass_audit(spark: SparkSession, folder: str) -> DataFrame:
    return job.clean_documents(C.corpus(spark, folder), _two_passes()).dropped


def two_pass_kept(spark: SparkSession, folder: str) -> DataFrame:
    return job.clean_documents(C.corpus(spark, folder), _two_passes()).documents.select("custom_id", "body")


def trim(spark: SparkSession, folder: str) -> DataFrame:
    return C.corpus(spark, folder).select("custom_id", squeeze_whitespace("body").alias("body"))


def python_chain(spark: SparkSession, folder: str) -> DataFrame:
    def shout(row: dict) -> dict:
        return {"custom_id": row["custom_id"].upper()}

    def refuse(row: dict) -> dict:
        if row["doc_id"] % 9 == 0:
            raise ValueError("ninth")
        return {"custom_id": row["custom_id"] + "!"}

    steps = [chain.RowTransform("shout", shout), chain.RowTransform("refuse", refuse)]
    docs = C.corpus(spark, folder).select("doc_id", "custom_id")
    errors = F.array_join(F.transform(chain.TRANSFORM_ERRORS, lambda e: F.concat(e["step"], F.lit("="), e["error"])), ";")
    return chain.run_transforms(docs, steps).select("doc_id", "custom_id", errors.alias("errors"))


def python_filter(spark: SparkSession, folder: str) -> DataFrame:
    def long_enough(n_chars: int) -> tuple[bool, str]:
        return n_chars >= 200, f"only {n_chars}"

    docs = C.corpus(spark, folder).select("custom_id", "n_chars")
    return chain.drop_audit(chain.mark_rejects(docs, [chain.python_filter("long", long_enough, "n_chars")]))


def html_basic(spark: SparkSession, folder: str) -> DataFrame:
    return C.table(spark, folder, "pages").select("page_id", html_to_text_basic("html").alias("text"))


def clean_cells(spark: SparkSession, folder: str) -> DataFrame:
    dirty = F.concat(F.lit("\x07"), "text", F.lit("\U0001f600\x0b end"))
    return C.table(spark, folder, "documents").select("doc_id", clean_xml(dirty).alias("cell"))


def tokens(spark: SparkSession, folder: str) -> DataFrame:
    return C.table(spark, folder, "documents").select("doc_id", token_estimate("text").alias("tokens"))


def fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return C.table(spark, folder, "documents").select("doc_id", fingerprint("text", "batch_").alias("batch_id"))


# Requests


def package(spark: SparkSession, folder: str) -> DataFrame:
    return C.corpus(spark, folder).select("custom_id", render.package_text().alias("text"))


def package_attachments(spark: SparkSession, folder: str) -> DataFrame:
    docs = chain.annotate_attachments().apply(C.corpus(spark, folder))
    text = render.with_attachments(render.package_text(), F.col("metadata.attachment_names"))
    return docs.select("custom_id", text.alias("text"))


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    return job.requests_of(C.corpus(spark, folder), recipes.spam_recipe(), MODEL, PROMPT)


def render_lines(spark: SparkSession, folder: str) -> DataFrame:
    requests = _requests(spark, folder)
    back = parse_requests(requests.select(render.request_line(requests).alias("line")))
    item = F.col("body.input")[0]
    return back.select(
        "custom_id",
        "method",
        "url",
        F.col("body.model").alias("model"),
        F.col("body.instructions").alias("instructions"),
        item["role"].alias("role"),
        item["content"][0]["text"].alias("text"),
        F.col("body.text.format.type").alias("format_type"),
        F.col("body.text.format.strict").alias("strict"),
    )


def bare_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Request lines whose content mixes bare strings, text parts, other parts and numbers, as chat messages."""
    docs = C.table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    quoted = F.regexp_extract(F.to_json(F.struct("text")), r'(?s)^\{"text":(.*)\}$', 1)
    parts = [quoted, F.lit('{"type":"input_text","text":"part"}'), F.lit('{"type":"image","text":"x"}'), F.lit('{"type":"input_text"}'), F.lit("7")]
    content = F.array_join(F.array(*parts, F.lit('"last"')), ",")
    body = F.concat(F.lit('{"instructions":"","input":[{"content":["first"]},{"role":"tool","content":['), content, F.lit("]}]}"))
    line = F.concat(F.lit('{"custom_id":"'), F.col("id"), F.lit('","body":'), body, F.lit("}"))
    chats = render.to_chat(parse_requests(docs.select(line.alias("line"))), MODEL)
    messages = F.col("payload.messages")
    return chats.select(
        "custom_id",
        F.size(messages).cast("long").alias("n_messages"),
        messages[0]["role"].alias("first_role"),
        messages[0]["content"].alias("first_text"),
        messages[1]["role"].alias("second_role"),
        messages[1]["content"].alias("second_text"),
    )


def prompt_override(spark: SparkSession, folder: str) -> DataFrame:
    changed = render.override_prompt(_requests(spark, folder), "Be brief.")
    return changed.select("custom_id", F.col("body.model").alias("model"), F.col("body.instructions").alias("instructions"))


def chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = C.table(spark, folder, "conversations")

    def part(kind, text):
        return F.struct(F.lit(kind).alias("type"), text.alias("text"))

    spoken = F.array(part("input_text", F.col("text")), part("note", F.lit("x")), part("input_text", F.col("role")))
    silent = F.array(part("note", F.lit("y")))
    items = F.array(
        F.struct("role", spoken.alias("content")), F.struct(F.lit("user").alias("role"), silent.alias("content"))
    )
    instructions = F.when(F.col("turn") % 2 == 0, PROMPT).otherwise("")
    requests = turns.select(
        F.concat_ws(":", "conv_id", "turn").alias("custom_id"),
        F.struct(instructions.alias("instructions"), items.alias("input")).alias("body"),
    )
    messages = render.to_chat(requests, MODEL).select("custom_id", F.posexplode("payload.messages").alias("pos", "m"))
    return messages.select("custom_id", "pos", "m.role", "m.content")


def _broken_requests(spark: SparkSession, folder: str) -> DataFrame:
    requests = render.render_requests(
        C.corpus(spark, folder), F.lit("t"), MODEL, PROMPT, keep=["doc_id"]
    )
    return requests.select(
        C.by_rest(13, {1: ""}, F.col("custom_id")).alias("custom_id"),
        C.by_rest(17, {2: "GET", 3: "post"}, F.col("method")).alias("method"),
        C.by_rest(19, {4: "/v1/other"}, F.col("url")).alias("url"),
        F.col("body").withField("model", C.by_rest(23, {5: "", 6: "small-2"}, F.col("body.model"))).alias("body"),
    )


def request_violations(spark: SparkSession, folder: str) -> DataFrame:
    return render.request_violations(_broken_requests(spark, folder))


def request_summary(spark: SparkSession, folder: str) -> DataFrame:
    return render.request_summary(_broken_requests(spark, folder))


def duplicate_ids(spark: SparkSession, folder: str) -> DataFrame:
    return render.duplicate_ids(C.corpus(spark, folder).select(F.col("source").alias("custom_id")))


# Order and shards


def _sizes(spark: SparkSession, folder: str) -> DataFrame:
    return C.table(spark, folder, "documents").select(
        C.custom_id().alias("custom_id"), render.line_bytes("text").alias("size")
    )


def ordinals(spark: SparkSession, folder: str) -> DataFrame:
    numbered = ordering.with_seq(_sizes(spark, folder), ["custom_id"])
    return numbered.select("custom_id", "seq", ordering.round_robin("seq", 3).alias("slot"))


def shards_by_count(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.pack(_sizes(spark, folder), ["custom_id"], F.lit(1), 64, 1_000_000).select("custom_id", "shard")


def shards_by_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.pack(_sizes(spark, folder), ["custom_id"], F.col("size"), 40, 30_000).select("custom_id", "shard")


def review(spark: SparkSession, folder: str) -> DataFrame:
    packed = sharding.pack(_sizes(spark, folder), ["custom_id"], F.lit(1), 64, 1_000_000)
    return sharding.review_summary(packed, F.col("size"))


# Scoring


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    docs = C.corpus(spark, folder).drop("body")
    content = F.struct(C.answer().alias("content"))
    response = F.struct(
        content.alias("message"),
        C.by_rest(2, {0: "small-1"}, "small-2").alias("model"),
        C.by_rest(5, {0: F.lit(None).cast("long")}, F.col("n_chars")).alias("prompt_eval_count"),
        (F.col("n_chars") % 50).alias("eval_count"),
        *[F.col("doc_id").alias(n) for n in ("total_duration", "load_duration", "prompt_eval_duration", "eval_duration")],
    )
    failed = F.col("doc_id") % 12 == 6
    error = F.when(failed, F.struct(F.lit("Timeout").alias("code"), F.lit("late").alias("message")))
    scored = docs.select("doc_id", "custom_id", error.alias("error"), F.when(~failed, response).alias("response"))
    return inference.output_records(scored, keep=["doc_id"])


def responses(spark: SparkSession, folder: str) -> DataFrame:
    body = F.col("response.body")
    return _scored(spark, folder).select(
        "custom_id",
        F.col("error.code").alias("error_code"),
        F.col("response.status_code").alias("status_code"),
        body["output"][0]["content"][0]["text"].alias("text"),
        body["usage"]["input_tokens"].alias("input_tokens"),
        body["usage"]["output_tokens"].alias("output_tokens"),
        body["provider_meta"]["chat"]["model"].alias("model"),
    )


def usage(spark: SparkSession, folder: str) -> DataFrame:
    return inference.usage_totals(_scored(spark, folder))


def submissions(spark: SparkSession, folder: str) -> DataFrame:
    results = _scored(spark, folder).withColumn("batch", F.col("doc_id") % 5)
    totals = inference.submission_summary(results, ["batch"], F.sum(F.col("doc_id") % 10).cast("double"))
    return totals.withColumn("requests_per_second", F.round("requests_per_second", 6))


def scored_requests(spark: SparkSession, folder: str) -> DataFrame:
    failures = (ConnectionError,)

    def scorer(payload: dict, endpoint: str) -> dict:
        text = payload["messages"][-1]["content"]
        if len(text) % 11 == 0:
            raise ConnectionError("refused")
        return {"message": {"content": str(len(text))}, "model": payload["model"], "eval_count": 1}

    numbered = ordering.with_seq(_requests(spark, folder), ["custom_id"])
    chats = render.to_chat(numbered, MODEL, keep=["seq"], text_format=SPAM_CONTRACT.text_format())
    done = inference.run_inference(chats, scorer, ["a", "b", "a"], 2, transient=failures, backoff=0.0)
    return done.select(
        "seq",
        "custom_id",
        "endpoint",
        F.col("response.message.content").alias("content"),
        F.col("error.code").alias("error_code"),
        "attempts",
    )


# Answers


def output_texts(spark: SparkSession, folder: str) -> DataFrame:
    return validate.parse_outputs(C.records(spark, folder)).select("custom_id", "error", "raw_text", "malformed")


def _checked(spark: SparkSession, folder: str, contract=SPAM_CONTRACT) -> DataFrame:
    return validate.validate_outputs(validate.parse_outputs(C.records(spark, folder)), contract)


def statuses(spark: SparkSession, folder: str) -> DataFrame:
    return _checked(spark, folder).select("custom_id", "status", "message")


def validation_counts(spark: SparkSession, folder: str) -> DataFrame:
    return validate.validation_counts(_checked(spark, folder))


def free_form(spark: SparkSession, folder: str) -> DataFrame:
    return _checked(spark, folder, None).select("custom_id", "status")


def nested_contract(spark: SparkSession, folder: str) -> DataFrame:
    doc = F.col("doc_id").cast("string")
    tail = F.lit('"}],"reason":"r"}')

    def pii(flag, count):
        return F.concat(
            F.lit(f'{{"contains_pii":{flag},"sensitivity_level":"low","confidence":1,"pii_categories":[{{"category":"a",'),
            F.lit(f'"count":{count},"examples":["x"]}},{{"category":"b","count":'), doc, F.lit(',"gdpr_article":"'), tail,
        )

    answer = C.by_rest(
        10,
        {
            0: pii("true", "2"),
            1: pii('"yes"', '"3.0"'),
            2: pii("2", "1"),
            3: pii("false", "1.5"),
            4: pii("0", "-1"),
            5: F.replace(pii("1.0", "4"), F.lit('"x"'), F.lit("7")),
            6: F.replace(pii("true", "4"), F.lit('"category":"b",'), F.lit("")),
            7: F.replace(pii("true", "4"), F.lit('"examples"'), F.lit('"samples"')),
            8: F.lit("[1]"),
            9: F.replace(pii("true", "4"), F.lit('"confidence":1'), F.lit('"confidence":null')),
        },
    )
    docs = C.corpus(spark, folder)
    lines = docs.select("custom_id", answer.alias("raw_text"))
    lines = lines.withColumns({"error": F.lit(None).cast("string"), "malformed": F.lit(False)})
    return validate.validate_outputs(lines, PII_CONTRACT).select("custom_id", "status", "message")


WIDE_SCHEMA = {
    "title": "WideAnswer",
    "type": "object",
    "additionalProperties": False,
    "required": ["code", "share", "step", "name", "day", "tags", "mixed"],
    "properties": {
        "code": {"enum": [1, 2, 3], "type": "integer"},
        "share": {"type": "number", "exclusiveMinimum": 0, "exclusiveMaximum": 1},
        "step": {"type": "integer", "minimum": 0, "maximum": 100, "multipleOf": 5},
        "name": {"type": "string", "minLength": 2, "maxLength": 4, "pattern": "^[a-z]+$"},
        "day": {"type": "string", "format": "date"},
        "tags": {"type": "array", "items": {"type": "string"}, "minItems": 1, "maxItems": 2, "uniqueItems": True},
        "mixed": {"anyOf": [{"type": "integer", "minimum": 10}, {"type": "array", "items": {"type": "number"}}, {"type": "null"}]},
    },
}


def wide_contract(spark: SparkSession, folder: str) -> DataFrame:
    """Every rule of a schema, broken by one kind of answer each."""
    good = {"code": "2", "share": "0.5", "step": "15", "name": '"abc"', "day": '"2024-02-29"', "tags": '["a","b"]', "mixed": "12"}
    odd = [
        {}, {"code": "4"}, {"code": '"2"'}, {"share": "0"}, {"share": "1.0"}, {"step": "7"}, {"step": "-5"}, {"step": "105"},
        {"name": '"a"'}, {"name": '"abcde"'}, {"name": '"aB"'}, {"day": '"2024-13-01"'}, {"tags": "[]"}, {"tags": '["a","b","c"]'},
        {"tags": '["a","a"]'}, {"tags": "[1]"}, {"mixed": "9"}, {"mixed": '["x"]'}, {"mixed": "[1,2.5]"}, {"mixed": "null"},
    ]
    texts = ["{" + ",".join(f'"{k}":{v}' for k, v in {**good, **o}.items()) + "}" for o in odd]
    answer = F.element_at(F.array(*[F.lit(t) for t in texts]), (F.col("doc_id") % len(texts) + 1).cast("int"))
    lines = C.corpus(spark, folder).select("custom_id", answer.alias("raw_text"))
    lines = lines.withColumns({"error": F.lit(None).cast("string"), "malformed": F.lit(False)})
    return validate.validate_outputs(lines, contract_from_json_schema(WIDE_SCHEMA)).select("custom_id", "status")


PART_SCHEMA = {
    "$ref": "#/$defs/Part",
    "$defs": {
        "Part": {
            "type": "object",
            "properties": {
                "name": {"type": "string", "minLength": 1},
                "parts": {"type": "array", "items": {"$ref": "#/$defs/Part"}},
                "counts": {"type": "object", "additionalProperties": {"type": "integer"}},
                "size": {"oneOf": [{"type": "integer", "multipleOf": 2}, {"type": "integer", "multipleOf": 3}]},
                "code": {"allOf": [{"type": "string"}, {"pattern": "^x"}]},
            },
            "required": ["name"],
            "additionalProperties": False,
        }
    },
}
DEEP = 3


def recursive_contract(spark: SparkSession, folder: str) -> DataFrame:
    """Answers against a schema that refers to itself, with every form of composition broken once."""
    doc = F.col("doc_id").cast("string")

    def text(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    answer = C.by_rest(
        12,
        {
            0: text('{"name":"', doc, '"}'),
            1: text('{"name":"a","parts":[{"name":"', doc, '","parts":[{"name":"c"}]}]}'),
            2: text('{"name":"a","parts":[{"name":"', doc, '"},{"name":""}]}'),
            3: text('{"name":"a","counts":{"x":', doc, "}}"),
            4: text('{"name":"a","counts":{"x":', doc, ',"y":"many"}}'),
            5: text('{"name":"a","size":4}'),
            6: text('{"name":"a","size":6}'),
            7: text('{"name":"a","code":"x', doc, '"}'),
            8: text('{"name":"a","code":"', doc, '"}'),
            9: text('{"parts":[{}]}'),
            10: text('{"name":"a","parts":[' * DEEP, '{"name":"b","other":', doc, "}", "]}" * DEEP),
            11: text("[", doc, "]"),
        },
    )
    lines = C.corpus(spark, folder).select("custom_id", answer.alias("raw_text"))
    lines = lines.withColumns({"error": F.lit(None).cast("string"), "malformed": F.lit(False)})
    return validate.validate_outputs(lines, SchemaContract(PART_SCHEMA)).select("custom_id", "status", "message")


# Ground truth and evaluation


def _truth(spark: SparkSession, folder: str) -> DataFrame:
    return last_label_wins(C.truth_rows(spark, folder), F.col("line_no"))


def truth_labels(spark: SparkSession, folder: str) -> DataFrame:
    return _truth(spark, folder)


def truth_quoted(spark: SparkSession, folder: str) -> DataFrame:
    """Ground truth from CSV files whose quoted names hold line feeds, commas and quotes."""
    doc = F.col("doc_id").cast("string")
    name = C.by_rest(
        3, {0: F.concat(F.lit('"'), doc, F.lit('\nsecond ""line"""')), 1: F.concat(F.lit('"a, '), doc, F.lit('"')), 2: F.concat(F.lit('inch 5" '), doc)}
    )
    label = F.when(F.col("doc_id") % 2 == 0, F.lit("Spam")).otherwise(F.lit('"ham\n"'))
    target = f"{ensure_checkpoint_dir(spark)}/truth-{uuid.uuid4().hex}"
    C.table(spark, folder, "documents").select(F.concat(name, F.lit(","), label)).write.text(target)
    return read_truth_csv(spark, target, header=False)


def truth_prefix(spark: SparkSession, folder: str) -> DataFrame:
    docs = C.corpus(spark, folder).select("custom_id")
    return truth.join_prefix(docs, prefix_map(spark, C.PREFIXES))


def _predictions(spark: SparkSession, folder: str) -> DataFrame:
    valid = validate.valid_rows(_checked(spark, folder, None))
    prefixes = prefix_map(spark, C.PREFIXES)
    return job.prediction_rows(valid, SPAM_CONTRACT, _truth(spark, folder), prefixes)


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    return _predictions(spark, folder).select("custom_id", "ground_truth", "predicted", "confidence")


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.confusion_counts(_predictions(spark, folder))


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.label_set(_counts(spark, folder))


def _labels_and_counts(spark: SparkSession, folder: str):
    counts = durable(_counts(spark, folder))
    return [r.label for r in evaluate.label_set(counts).collect()], counts


def confusion(spark: SparkSession, folder: str) -> DataFrame:
    listed, counts = _labels_and_counts(spark, folder)
    return evaluate.dense_confusion(counts, listed)


def confusion_wide(spark: SparkSession, folder: str) -> DataFrame:
    listed, counts = _labels_and_counts(spark, folder)
    wide = reports.confusion_wide(counts, listed)
    # DuckDB does not tell column names that differ in case apart.
    return wide.toDF(*[f"{c}_" if c == "Pred: spam" else c for c in wide.columns])


def per_class(spark: SparkSession, folder: str) -> DataFrame:
    classes = evaluate.per_class(_counts(spark, folder))
    return classes.select("label", "tp", "fp", "fn", "support", six("precision"), six("recall"), six("f1"))


def summary(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.summary(evaluate.per_class(_counts(spark, folder))).select("metric", six("value"))


def summary_auc(spark: SparkSession, folder: str) -> DataFrame:
    """The summary of two classes with its AUC row."""
    rows = _labelled(spark, folder).withColumn("predicted", F.when(F.col("confidence") >= 0.5, "spam").otherwise("ham"))
    return evaluate.evaluate(rows, "spam").summary.select("metric", six("value"))


def raw_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return reports.prediction_table(_predictions(spark, folder), SPAM_CONTRACT)


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    docs = C.table(spark, folder, "documents").select("doc_id", "n_chars", C.custom_id().alias("custom_id"))
    return docs.join(C.table(spark, folder, "labels"), "doc_id").select(
        "custom_id",
        F.when(F.col("quality") == 0, "spam").otherwise("ham").alias("ground_truth"),
        C.score_text().cast("double").alias("confidence"),
    )


def _roc_steps(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.roc_steps(_labelled(spark, folder), "spam")


def roc(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.roc_points(_roc_steps(spark, folder))


def auc(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.auc(_roc_steps(spark, folder))


def result_columns(spark: SparkSession, folder: str) -> DataFrame:
    valid = durable(validate.valid_rows(_checked(spark, folder, None)).select("custom_id", "raw_text"))
    numbered = ordering.with_seq(valid, ["custom_id"])
    return reports.extra_columns(numbered, ["filename", "classification"], "seq")


def results(spark: SparkSession, folder: str) -> DataFrame:
    valid = validate.valid_rows(_checked(spark, folder, None))
    return reports.results_table(valid, reports.resolve_columns(valid, None))


def result_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Answer members without a column: all but the label and the first undeclared key."""
    valid = validate.valid_rows(_checked(spark, folder, None))
    named = Contract("Named", (Field("classification", "string"),), forbid_extra=False)
    return reports.result_cells(valid, reports.resolve_columns(valid, named, most=1))


def confusion_cells(spark: SparkSession, folder: str) -> DataFrame:
    return reports.confusion_cells(evaluate.evaluate(_predictions(spark, folder)))


# Run log


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return C.table(spark, folder, "events")


def stage_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = runlog.step_statistics(_events(spark, folder), "event_type", "value")
    return stats.select("stage", "count", F.round("total_ms", 3).alias("total_ms"), "min_ms", "max_ms", six("mean_ms"))


def histogram(spark: SparkSession, folder: str) -> DataFrame:
    counts = runlog.duration_histogram(_events(spark, folder), ["event_type"], F.col("value"), runlog.REQUEST_BUCKETS)
    return counts


def counters(spark: SparkSession, folder: str) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "failure").otherwise("success").alias("status")
    return runlog.outcome_counts(_events(spark, folder).select("user_id", status), ["user_id", "status"])


def _changes(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder).select("event_id", "ts", "user_id", "event_type")
    return runlog.status_changes(events, "user_id", "event_type", "ts", "event_id")


def status_changes(spark: SparkSession, folder: str) -> DataFrame:
    return _changes(spark, folder)


def state_age(spark: SparkSession, folder: str) -> DataFrame:
    now = F.lit("2025-01-01 00:00:00").cast("timestamp")
    ages = runlog.state_age(_changes(spark, folder), "user_id", "event_type", "ts", "event_id", now)
    return ages.select("user_id", "status", "since", F.round("state_elapsed_seconds", 3).alias("state_elapsed_seconds"))


def progress(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    counts = _events(spark, folder).groupBy("user_id").agg(
        (F.count("*") - F.count_if(kind == "view")).alias("planned"),
        F.count_if(kind.isin("purchase", "signup")).alias("completed"),
        F.count_if(kind == "error").alias("failed"),
        F.sum(F.when(kind == "error", F.col("value"))).alias("seconds"),
    )
    done = runlog.progress(counts, "planned", "completed", "failed", "seconds")
    return done.select(
        "user_id", "total_requests", "processed_requests", "remaining_requests",
        *[F.round(c, 4).alias(c) for c in ("percent_complete", "speed_items_per_sec", "eta_seconds")],
    )


# The whole way


def labelling_job(spark: SparkSession, folder: str) -> DataFrame:
    """Documents cleaned, rendered, scored by rule, checked, and compared with the labels."""
    cleaned = job.clean_documents(C.corpus(spark, folder), _two_passes()).documents
    requests = render.render_requests(
        cleaned, render.package_text(), MODEL, PROMPT, SPAM_CONTRACT.text_format(), keep=["doc_id", "n_chars"]
    )
    scored = requests.select(
        "custom_id",
        F.struct(F.struct(C.answer().alias("content")).alias("message"), F.col("body.model").alias("model")).alias("r"),
    )
    longs = ("prompt_eval_count", "eval_count", "total_duration", "load_duration", "prompt_eval_duration", "eval_duration")
    response = F.struct("r.message", "r.model", *[F.lit(None).cast("long").alias(n) for n in longs])
    scored = scored.select("custom_id", F.lit(None).cast("struct<code:string,message:string>").alias("error"),
                           response.alias("response"))
    checked = validate.validate_outputs(validate.records_as_outputs(inference.output_records(scored)), SPAM_CONTRACT)
    rows = job.prediction_rows(validate.valid_rows(checked), SPAM_CONTRACT, _truth(spark, folder))
    classes = evaluate.per_class(evaluate.confusion_counts(rows))
    return classes.select("label", "tp", "fp", "fn", "support", six("precision"), six("recall"), six("f1"))


QUERIES = {
    f.__name__: f
    for f in (
        can_read, all_suffixes, all_phrases, emails, filter_chain, drop_audit, filter_counts, two_pass_audit, two_pass_kept, trim,
        python_chain, python_filter, html_basic, clean_cells, tokens, fingerprints,
        package, package_attachments, render_lines, bare_parts, prompt_override, chat,
        request_violations, request_summary, duplicate_ids,
        ordinals, shards_by_count, shards_by_bytes, review,
        responses, usage, submissions, scored_requests,
        output_texts, statuses, validation_counts, free_form, nested_contract, wide_contract, recursive_contract,
        truth_labels, truth_quoted, truth_prefix, predictions, labels, confusion, confusion_wide, per_class, summary, summary_auc,
        raw_predictions, roc, auc, result_columns, results, result_cells, confusion_cells,
        stage_stats, histogram, counters, status_changes, state_age, progress,
        labelling_job,
    )
}
