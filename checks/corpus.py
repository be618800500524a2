"""The given tables seen as mail documents, answers and ground truth.

There is no mail table, so documents get names, headers, odd whitespace and
attachments by rules on ``doc_id``; ``checks.sql`` states the same rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promptframe.session import configure

PREFIXES = {"SRC0": "Spam", "src1": "ham", "Src2": "ham", "src0": "ham", "src3": "spam"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def by_rest(divisor: int, choices: dict[int, object], otherwise: object = None) -> Column:
    """A value chosen by ``doc_id % divisor``."""

    def value(v) -> Column:
        return v if isinstance(v, Column) else F.lit(v)

    out = value(otherwise)
    for rest, choice in choices.items():
        out = F.when(F.col("doc_id") % divisor == rest, value(choice)).otherwise(out)
    return out


# One text per column: building them from Column objects takes longer than running them.
_CUSTOM_ID = """concat(source, '__', lpad(cast(doc_id AS string), 8, '0'), CASE doc_id % 6 WHEN 0 THEN '.eml'
  WHEN 1 THEN '.txt' WHEN 2 THEN '.MSG' WHEN 3 THEN '' WHEN 4 THEN '.4d456dd9' ELSE '.Csv' END)"""
_HEADERS = """map_filter(map(
  'From', concat(source, '@example.org'),
  'To', CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'team@example.org' END,
  'Subject', concat(CASE WHEN doc_id % 10 = 0 THEN 'Automatic Reply: ' ELSE '' END, replace(substr(text, 1, 40), '\n', ' ')),
  'Date', CASE WHEN doc_id % 3 = 0 THEN concat('2024-01-', lpad(cast(doc_id % 28 + 1 AS string), 2, '0')) END,
  'Reply-To', CASE WHEN doc_id % 5 = 0 THEN 'noreply@example.org' END), (k, v) -> v IS NOT NULL)"""
_BODY = r"""CASE WHEN doc_id % 7 = 0
  THEN concat('\n\n\n\n  ', text, ' \t \n\n\n\n\n tail\t\tend \n') ELSE text END"""
_METADATA = """named_struct('attachment_names', CASE doc_id % 3
  WHEN 0 THEN array(concat('a_', doc_id, '.pdf'), 'scan.png') WHEN 1 THEN cast(array() AS array<string>) END)"""
_LABEL = "CASE WHEN n_chars % 3 = 0 THEN 'spam' ELSE 'ham' END"
_SCORE = "concat('0.', lpad(cast(n_chars % 97 AS string), 2, '0'))"


def _answer_text(label: str, confidence: str, tail: str = "") -> str:
    return f"""concat('{{"classification":', {label}, ',"confidence":', {confidence}, ',"reason":"r ', doc_id, '"{tail}}}')"""


_QUOTED_LABEL = f"""concat('"', {_LABEL}, '"')"""
_GOOD = _answer_text(_QUOTED_LABEL, _SCORE)
_ANSWER = rf"""CASE doc_id % 12
  WHEN 1 THEN {_answer_text(_QUOTED_LABEL, f"""concat('"', {_SCORE}, '"')""")}
  WHEN 2 THEN {_answer_text(_QUOTED_LABEL, _SCORE, ',"mood":"x"')}
  WHEN 3 THEN {_answer_text(_QUOTED_LABEL, "'1.5'")}
  WHEN 4 THEN concat({_GOOD}, '\n```')
  WHEN 5 THEN ''
  WHEN 7 THEN {_answer_text("'null'", _SCORE)}
  WHEN 8 THEN concat('{{"classification":', {_QUOTED_LABEL}, ',"confidence":', {_SCORE}, '}}')
  WHEN 9 THEN {_answer_text(_QUOTED_LABEL, "'true'")}
  WHEN 10 THEN {_answer_text(f"""concat('" ', initcap({_LABEL}), ' "')""", _SCORE)}
  ELSE {_GOOD} END"""
_PART = "named_struct('type', 'output_text', 'text', answer)"
_EMPTY = "named_struct('type', 'output_text', 'text', '')"
_OTHER = "named_struct('type', 'refusal', 'text', 'no')"
_RECORD = f"""named_struct(
  'custom_id', custom_id,
  'error', CASE WHEN doc_id % 12 = 6 THEN named_struct('code', 'Timeout', 'message', 'late') END,
  'response', CASE WHEN doc_id % 12 <> 6 THEN named_struct('status_code', 200, 'body', named_struct('output', array(
    named_struct('type', 'reasoning', 'content', array({_OTHER})),
    named_struct('type', 'message', 'content', CASE doc_id % 4 WHEN 1 THEN array({_EMPTY}, {_PART})
      WHEN 2 THEN array({_OTHER}, {_PART}) ELSE array({_PART}) END)))) END)"""


def custom_id() -> Column:
    return F.expr(_CUSTOM_ID)


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, n_chars, source, custom_id, headers, body, metadata``."""
    return table(spark, folder, "documents").selectExpr(
        "doc_id",
        "n_chars",
        "source",
        f"{_CUSTOM_ID} AS custom_id",
        f"{_HEADERS} AS headers",
        f"{_BODY} AS body",
        f"{_METADATA} AS metadata",
    )


def score_text() -> Column:
    return F.expr(_SCORE)


def answer() -> Column:
    """Answer text by rule; rests 0, 1, 9 and 11 of 12 meet the mail contract."""
    return F.expr(_ANSWER)


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Answer lines: ``doc_id, line``. Rest 6 of 12 is an error record; some texts follow an empty one."""
    docs = table(spark, folder, "documents").selectExpr("doc_id", f"{_CUSTOM_ID} AS custom_id", f"{_ANSWER} AS answer")
    return docs.selectExpr("doc_id", f"to_json({_RECORD}, map('ignoreNullFields', 'false')) AS line")


def truth_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Ground-truth rows ``filename, label, line_no``; toxic documents come twice."""
    labels = table(spark, folder, "labels")
    docs = table(spark, folder, "documents").select("doc_id", custom_id().alias("name"))
    twice = F.when(F.col("toxic") == 1, F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = labels.join(docs, "doc_id").withColumn("copy", F.explode(twice))
    by_quality = F.when(F.col("quality") == 0, " Spam").otherwise("HAM ")
    return rows.select(
        F.concat(F.lit(" "), "name").alias("filename"),
        F.when(F.col("copy") == 1, "spam").otherwise(by_quality).alias("label"),
        (F.col("doc_id") * 2 + F.col("copy")).alias("line_no"),
    )
