from pyspark.sql import functions as F

from promptframe.operators import chain

MAILS = [
    ("long", {"Subject": "Hello"}, "A real message with plenty of text."),
    ("empty", {"Subject": "x"}, ""),
    ("null", None, None),
    ("short", {"Subject": "x"}, "\xa0 twelve chars \n"),
    ("auto", {"Subject": "Automatic Reply: out of office"}, "I am away until the end of the month."),
]


def mails(spark):
    return spark.createDataFrame(MAILS, "custom_id string, headers map<string,string>, body string")


def test_first_rejection_is_recorded(spark):
    filters = [chain.empty_body_filter(), chain.min_length_filter(), chain.auto_reply_filter()]
    marked = chain.mark_rejects(mails(spark), filters)
    dropped = {r.filename: (r.filter, r.reason) for r in chain.drop_audit(marked).collect()}
    assert dropped == {
        "empty": ("empty_body", "body is empty or too short (<10 chars)"),
        "null": ("empty_body", "body is empty or too short (<10 chars)"),
        "short": ("min_length", "body too short (12 < 20 chars)"),
        "auto": ("auto_reply", "auto-reply detected: 'out of office'"),
    }
    assert [r.custom_id for r in chain.kept(marked).collect()] == ["long"]
    counts = dict(chain.filter_counts(marked).collect())
    assert counts == {"(kept)": 1, "empty_body": 2, "min_length": 1, "auto_reply": 1}


def test_empty_chain_keeps_all(spark):
    assert chain.kept(chain.mark_rejects(mails(spark), [])).count() == len(MAILS)


def test_python_filter(spark):
    short = chain.python_filter("py", lambda body: (len(body or "") > 30, f"{len(body or '')} is short"), "body")
    audit = chain.drop_audit(chain.mark_rejects(mails(spark), [short]), "filter_1").collect()
    assert ("filter_1", "empty", "py", "0 is short") in [tuple(r) for r in audit]


def test_python_transforms_continue_after_a_failure(spark):
    def fail(row):
        raise ValueError("no")

    steps = [
        chain.RowTransform("upper", lambda r: {"body": r["body"].upper()}),
        chain.RowTransform("fail", fail),
        chain.RowTransform("prefix", lambda r: {"body": "PREFIX:" + r["body"]}),
    ]
    frame = spark.createDataFrame(
        [("a", "hello", 3, None, {"k": "v"}, [1, None])],
        "id string, body string, n long, m int, h map<string,string>, xs array<long>",
    )
    row = chain.run_transforms(frame, steps).head()
    assert row.body == "PREFIX:HELLO"
    assert [tuple(e) for e in row.transform_errors] == [("fail", "ValueError: no")]
    assert (row.n, row.m, row.h, row.xs) == (3, None, {"k": "v"}, [1, None])


def test_native_and_python_transforms_mix(spark):
    frame = spark.createDataFrame([("a \t b", "i")], "body string, id string")
    steps = [
        chain.RowTransform("x", lambda r: {"body": r["body"] + "  c"}),
        chain.trim_whitespace(),
        chain.RowTransform("y", lambda r: {"body": r["body"] + "!"}),
    ]
    assert chain.run_transforms(frame, steps).head().body == "a b c!"


def test_annotate_attachments(spark):
    frame = spark.createDataFrame([(1, (None,)), (2, (["f"],))], "id int, metadata struct<attachment_names:array<string>>")
    rows = chain.run_transforms(frame, [chain.annotate_attachments()]).orderBy("id").collect()
    assert [r.metadata.attachment_names for r in rows] == [[], ["f"]]


def test_costly_columns_are_computed_once(spark):
    marked = chain.mark_rejects(mails(spark), [chain.empty_body_filter()])
    plan = chain.kept(marked)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")


def test_python_filters_see_only_rows_that_are_kept(spark):
    def long_enough(body):
        return len(body) > 3, "short"  # would fail on a null body

    def no_x(body):
        assert len(body) > 3
        return "x" not in body, "has x"

    docs = spark.createDataFrame([("a", None), ("b", "abc"), ("c", "abcdx"), ("d", "abcd")], "custom_id string, body string")
    filters = [
        chain.Filter("none", F.col("body").isNull(), F.lit("no body")),
        chain.python_filter("long", long_enough, "body"),
        chain.python_filter("no_x", no_x, "body"),
        chain.Filter("last", F.col("custom_id") == "d", F.lit("d")),
    ]
    found = {r.filename: r.filter for r in chain.drop_audit(chain.mark_rejects(docs, filters)).collect()}
    assert found == {"a": "none", "b": "long", "c": "no_x", "d": "last"}
