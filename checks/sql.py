"""SQL over the given tables with the results the check queries must have."""

from __future__ import annotations

_ID = """source || '__' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || CASE doc_id % 6 WHEN 0 THEN '.eml'
  WHEN 1 THEN '.txt' WHEN 2 THEN '.MSG' WHEN 3 THEN '' WHEN 4 THEN '.4d456dd9' ELSE '.Csv' END"""

_CORPUS = rf"""corpus AS (
  SELECT doc_id, n_chars, source, text, {_ID} AS custom_id,
    source || '@example.org' AS h_from,
    CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'team@example.org' END AS h_to,
    CASE WHEN doc_id % 10 = 0 THEN 'Automatic Reply: ' ELSE '' END
      || replace(substr(text, 1, 40), chr(10), ' ') AS h_subject,
    CASE WHEN doc_id % 3 = 0 THEN '2024-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') END AS h_date,
    CASE WHEN doc_id % 5 = 0 THEN 'noreply@example.org' END AS h_reply,
    CASE WHEN doc_id % 7 = 0 THEN E'\n\n\n\n  ' || text || E' \t \n\n\n\n\n tail\t\tend \n' ELSE text END AS body,
    CASE WHEN n_chars % 3 = 0 THEN 'spam' ELSE 'ham' END AS label,
    '0.' || lpad(CAST(n_chars % 97 AS VARCHAR), 2, '0') AS score
  FROM documents)"""


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _squeeze(x: str) -> str:
    return _strip(rf"regexp_replace(regexp_replace({x}, '\n{{3,}}', E'\n\n', 'g'), '[^\S\n]+', ' ', 'g')")


def _lines(body: str = "body") -> str:
    heads = [("From", "h_from"), ("To", "h_to"), ("Subject", "h_subject"), ("Date", "h_date"), ("Reply-To", "h_reply")]
    parts = [f"CASE WHEN {c} <> '' THEN '{n}: ' || {c} || chr(10) ELSE '' END" for n, c in heads]
    return " || ".join([*parts, "chr(10)", body])


_SHORT = f"length({_strip('body')})"
_AUTO = "contains(lower(h_subject), 'automatic reply')"
_REJECT = f"""marked AS (
  SELECT *, CASE WHEN {_SHORT} < 10 THEN 'empty_body' WHEN {_SHORT} < 20 THEN 'min_length'
      WHEN {_AUTO} THEN 'auto_reply' END AS filter,
    CASE WHEN {_SHORT} < 10 THEN 'body is empty or too short (<10 chars)'
      WHEN {_SHORT} < 20 THEN 'body too short (' || {_SHORT} || ' < 20 chars)'
      WHEN {_AUTO} THEN 'auto-reply detected: ''automatic reply''' END AS reason
  FROM corpus)"""

_SECOND = f"""second AS (
  SELECT *, {_SHORT} AS first_length, {_squeeze('body')} AS clean, length({_squeeze('body')}) AS clean_length FROM corpus),
passes AS (
  SELECT *, CASE WHEN first_length < 10 THEN 'filter_1' WHEN clean_length < 60 OR {_AUTO} THEN 'filter_2' END AS step,
    CASE WHEN first_length < 10 THEN 'empty_body' WHEN clean_length < 60 THEN 'min_length'
      WHEN {_AUTO} THEN 'auto_reply' END AS filter,
    CASE WHEN first_length < 10 THEN 'body is empty or too short (<10 chars)'
      WHEN clean_length < 60 THEN 'body too short (' || clean_length || ' < 60 chars)'
      WHEN {_AUTO} THEN 'auto-reply detected: ''automatic reply''' END AS reason
  FROM second)"""

_BASE = """'{"classification":"' || label || '","confidence":' || score || ',"reason":"r ' || doc_id || '"'"""
_ANSWERS = f"""answers AS (
  SELECT *, CASE doc_id % 12
    WHEN 1 THEN '{{"classification":"' || label || '","confidence":"' || score || '","reason":"r ' || doc_id || '"}}'
    WHEN 2 THEN {_BASE} || ',"mood":"x"}}'
    WHEN 3 THEN '{{"classification":"' || label || '","confidence":1.5,"reason":"r ' || doc_id || '"}}'
    WHEN 4 THEN {_BASE} || E'}}\\n```'
    WHEN 5 THEN ''
    WHEN 7 THEN '{{"classification":null,"confidence":' || score || ',"reason":"r ' || doc_id || '"}}'
    WHEN 8 THEN '{{"classification":"' || label || '","confidence":' || score || '}}'
    WHEN 9 THEN '{{"classification":"' || label || '","confidence":true,"reason":"r ' || doc_id || '"}}'
    WHEN 10 THEN '{{"classification":" ' || upper(label[1]) || label[2:] || ' ","confidence":' || score
      || ',"reason":"r ' || doc_id || '"}}'
    ELSE {_BASE} || '}}' END AS answer
  FROM corpus)"""

_STATUS = """CASE WHEN doc_id % 12 = 6 THEN 'skipped' WHEN doc_id % 12 IN (0, 1, 9, 11) THEN 'valid' ELSE 'invalid' END"""
_MESSAGE = """CASE doc_id % 12 WHEN 6 THEN 'Batch error: {"code":"Timeout","message":"late"}'
  WHEN 2 THEN 'Schema validation error: unknown keys: mood'
  WHEN 3 THEN 'Schema validation error: confidence: expected number >= 0.0 <= 1.0'
  WHEN 4 THEN 'JSON parse error' WHEN 5 THEN 'JSON parse error'
  WHEN 8 THEN 'Schema validation error: reason: missing'
  WHEN 7 THEN 'Schema validation error: classification: expected string in [''spam'', ''ham'']'
  WHEN 10 THEN 'Schema validation error: classification: expected string in [''spam'', ''ham'']' END"""

_TRUTH = f"""truth AS (
  SELECT {_ID} AS filename, CASE WHEN toxic = 1 OR quality = 0 THEN 'spam' ELSE 'ham' END AS label
  FROM labels JOIN documents USING (doc_id))"""
_PREFIX = "CASE source WHEN 'src0' THEN 'Spam' WHEN 'src1' THEN 'ham' WHEN 'src2' THEN 'ham' WHEN 'src3' THEN 'spam' END"
_PREDICTED = f"""predicted AS (
  SELECT doc_id, custom_id, coalesce(t.label, {_PREFIX}) AS ground_truth,
    CASE WHEN doc_id % 12 = 7 THEN 'none' ELSE c.label END AS predicted,
    CASE doc_id % 12 WHEN 3 THEN 1.5 WHEN 9 THEN 1.0 ELSE CAST(score AS DOUBLE) END AS confidence
  FROM corpus c LEFT JOIN truth t ON t.filename = c.custom_id
  WHERE doc_id % 12 NOT IN (4, 5, 6) AND coalesce(t.label, {_PREFIX}) IS NOT NULL)"""
_RATIOS = """
  coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
  coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1"""


def _classes(rows: str) -> str:
    return f"""names AS (SELECT ground_truth AS label FROM {rows} UNION SELECT predicted FROM {rows}),
sums AS (
  SELECT label, count_if(ground_truth = label AND predicted = label) AS tp,
    count_if(ground_truth <> label AND predicted = label) AS fp,
    count_if(ground_truth = label AND predicted <> label) AS fn
  FROM names CROSS JOIN {rows} GROUP BY label),
classes AS (SELECT *, tp + fn AS support, {_RATIOS} FROM sums)"""


_CLASS_ROWS = """SELECT label, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
  CAST(support AS BIGINT) AS support, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1
FROM classes"""

_EVAL = f"WITH {_CORPUS}, {_TRUTH}, {_PREDICTED}"

_SIZES = f"""sizes AS (
  SELECT {_ID} AS custom_id, CAST(strlen(text) + 1 AS BIGINT) AS size,
    row_number() OVER (ORDER BY {_ID}) - 1 AS seq FROM documents)"""

_ROC = f"""scored AS (
  SELECT {_ID} AS custom_id, CAST(quality = 0 AS INTEGER) AS pos,
    CAST('0.' || lpad(CAST(n_chars % 97 AS VARCHAR), 2, '0') AS DOUBLE) AS confidence
  FROM documents JOIN labels USING (doc_id)),
running AS (
  SELECT confidence, row_number() OVER w AS point, sum(pos) OVER w AS tp, sum(1 - pos) OVER w AS fp,
    sum(pos) OVER () AS p, sum(1 - pos) OVER () AS n
  FROM scored WINDOW w AS (ORDER BY confidence DESC, custom_id ROWS UNBOUNDED PRECEDING)),
points AS (
  SELECT 0 AS point, 0.0 AS fpr, 0.0 AS tpr, 1.0 AS threshold
  UNION ALL SELECT point, round(fp / n, 6), round(tp / p, 6), round(confidence, 6) FROM running WHERE p > 0 AND n > 0)"""

_AVERAGES = """sum(tp) / sum(support) AS accuracy, avg(precision) AS macro_precision, avg(recall) AS macro_recall,
          avg(f1) AS macro_f1, sum(precision * support) / sum(support) AS weighted_precision,
          sum(recall * support) / sum(support) AS weighted_recall, sum(f1 * support) / sum(support) AS weighted_f1,
          CAST(sum(support) AS DOUBLE) AS total_predictions"""

_CHANGES = """changes AS (
  SELECT event_id, ts, user_id, event_type FROM (
    SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
  WHERE before IS NULL OR before <> event_type)"""

_RESULT_KEYS = f"""valid_answers AS (
  SELECT *, row_number() OVER (ORDER BY custom_id) - 1 AS seq FROM corpus WHERE doc_id % 12 NOT IN (4, 5, 6)),
keyed AS (
  SELECT 'confidence' AS key, seq, 1 AS pos FROM valid_answers
  UNION ALL SELECT 'reason', seq, 2 FROM valid_answers WHERE doc_id % 12 <> 8
  UNION ALL SELECT 'mood', seq, 3 FROM valid_answers WHERE doc_id % 12 = 2)"""

_TEXT_SCORE = "rtrim(rtrim(score, '0'), '.')"
_CHAT = "'Classify the message.'"

ORACLES = {
    "all_suffixes": "SELECT doc_id, doc_id % 51 < 5 AS accepted FROM documents",
    "all_phrases": """SELECT CAST(doc_id AS VARCHAR) AS filename, 'auto_reply' AS filter, 'auto-reply detected: ''' ||
      ['out of office', 'automatic reply', 'auto-reply', 'autoreply', 'delivery status notification', 'undeliverable',
       'vacation reply'][doc_id % 8 + 1] || '''' AS reason FROM documents WHERE doc_id % 8 < 7""",
    "can_read": f"WITH {_CORPUS} SELECT custom_id, doc_id % 6 <> 5 AS accepted FROM corpus",
    "emails": """SELECT doc_id, source || '@example.org' AS sender, 'note' AS subject, text AS body,
      'text/plain' AS content_type, 1 AS num_parts FROM documents""",
    "filter_chain": f"WITH {_CORPUS}, {_REJECT} SELECT custom_id FROM marked WHERE filter IS NULL",
    "drop_audit": f"""WITH {_CORPUS}, {_REJECT}
      SELECT custom_id AS filename, filter, reason FROM marked WHERE filter IS NOT NULL""",
    "filter_counts": f"""WITH {_CORPUS}, {_REJECT}
      SELECT coalesce(filter, '(kept)') AS filter, count(*) AS n FROM marked GROUP BY 1""",
    "two_pass_audit": f"""WITH {_CORPUS}, {_SECOND}
      SELECT step, custom_id AS filename, filter, reason FROM passes WHERE step IS NOT NULL""",
    "two_pass_kept": f"WITH {_CORPUS}, {_SECOND} SELECT custom_id, clean AS body FROM passes WHERE step IS NULL",
    "trim": f"WITH {_CORPUS} SELECT custom_id, {_squeeze('body')} AS body FROM corpus",
    "python_chain": f"""WITH {_CORPUS} SELECT doc_id,
      upper(custom_id) || CASE WHEN doc_id % 9 = 0 THEN '' ELSE '!' END AS custom_id,
      CASE WHEN doc_id % 9 = 0 THEN 'refuse=ValueError: ninth' ELSE '' END AS errors FROM corpus""",
    "python_filter": f"""WITH {_CORPUS} SELECT custom_id AS filename, 'long' AS filter, 'only ' || n_chars AS reason
      FROM corpus WHERE n_chars < 200""",
    "html_basic": rf"""SELECT page_id,
      trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM pages""",
    "clean_cells": r"""SELECT doc_id,
      regexp_replace(text, '[^\t\n\r\x{20}-\x{D7FF}\x{E000}-\x{FFFD}]', '', 'g') || ' end' AS cell FROM documents""",
    "tokens": "SELECT doc_id, CAST(greatest(1, length(text) // 4) AS INTEGER) AS tokens FROM documents",
    "fingerprints": "SELECT doc_id, 'batch_' || substr(sha256(text), 1, 16) AS batch_id FROM documents",
    "package": f"WITH {_CORPUS} SELECT custom_id, {_lines()} AS text FROM corpus",
    "package_attachments": f"""WITH {_CORPUS} SELECT custom_id, {_lines()} || CASE WHEN doc_id % 3 = 0
      THEN E'\\n\\nAttachments:\\n  - a_' || doc_id || E'.pdf\\n  - scan.png' ELSE '' END AS text FROM corpus""",
    "bare_parts": """SELECT doc_id::VARCHAR AS custom_id, 2::BIGINT AS n_messages, 'user' AS first_role, 'first' AS first_text,
        'tool' AS second_role, coalesce(text, '') || chr(10) || 'part' || chr(10) || chr(10) || 'last' AS second_text FROM documents""",
    "render_lines": f"""WITH {_CORPUS} SELECT custom_id, 'POST' AS method, '/v1/responses' AS url, 'small-1' AS model,
      {_CHAT} AS instructions, 'user' AS role, {_lines()} AS text, 'json_schema' AS format_type, true AS strict
      FROM corpus""",
    "prompt_override": f"""WITH {_CORPUS}
      SELECT custom_id, 'small-1' AS model, 'Be brief.' AS instructions FROM corpus""",
    "chat": f"""WITH m AS (
        SELECT conv_id || ':' || turn AS custom_id, turn, role, text || chr(10) || role AS content FROM conversations)
      SELECT custom_id, 0 AS pos, 'system' AS role, {_CHAT} AS content FROM m WHERE turn % 2 = 0
      UNION ALL SELECT custom_id, CASE WHEN turn % 2 = 0 THEN 1 ELSE 0 END, role, content FROM m""",
    "request_violations": f"""WITH {_CORPUS} SELECT * FROM (
      SELECT CASE WHEN doc_id % 13 = 1 THEN '' ELSE custom_id END AS custom_id,
        CASE WHEN doc_id % 13 = 1 THEN 'missing custom_id' WHEN doc_id % 17 = 2 THEN 'method must be POST'
          WHEN doc_id % 19 = 4 THEN 'url must be /v1/responses' WHEN doc_id % 23 = 5 THEN 'missing body.model' END AS reason
      FROM corpus) WHERE reason IS NOT NULL""",
    "request_summary": """SELECT count(*) AS total_requests, CAST(count_if(doc_id % 13 = 1) AS BIGINT) AS missing_id,
      CAST(count_if(doc_id % 17 = 2) AS BIGINT) AS bad_method, CAST(count_if(doc_id % 19 = 4) AS BIGINT) AS bad_url,
      CAST(count_if(doc_id % 23 = 5) AS BIGINT) AS missing_model,
      CAST(max(CASE WHEN doc_id % 23 = 6 THEN 1 ELSE 0 END) + max(CASE WHEN doc_id % 23 NOT IN (5, 6) THEN 1 ELSE 0 END)
        AS BIGINT) AS models, 'small-1' AS model FROM documents""",
    "duplicate_ids": "SELECT source AS custom_id, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1",
    "ordinals": f"WITH {_SIZES} SELECT custom_id, seq, CAST(seq % 3 AS INTEGER) AS slot FROM sizes",
    "shards_by_count": f"WITH {_SIZES} SELECT custom_id, seq // 64 + 1 AS shard FROM sizes",
    "shards_by_bytes": f"""WITH RECURSIVE {_SIZES}, fold AS (
        SELECT custom_id, seq, 1 AS shard, 1 AS held, size AS filled FROM sizes WHERE seq = 0
        UNION ALL
        SELECT s.custom_id, s.seq, CASE WHEN is_full THEN shard + 1 ELSE shard END, CASE WHEN is_full THEN 1 ELSE held + 1 END,
          CASE WHEN is_full THEN size ELSE filled + size END
        FROM (SELECT s.*, f.shard, f.held, f.filled, f.held >= 40 OR f.filled + s.size > 30000 AS is_full
          FROM fold f JOIN sizes s ON s.seq = f.seq + 1) s)
      SELECT custom_id, CAST(shard AS BIGINT) AS shard FROM fold""",
    "review": f"""WITH {_SIZES} SELECT seq // 64 + 1 AS shard, count(*) AS requests, CAST(sum(size) AS BIGINT) AS bytes
      FROM sizes GROUP BY ROLLUP (seq // 64 + 1)""",
    "responses": f"""WITH {_CORPUS}, {_ANSWERS}, ok AS (SELECT *, doc_id % 12 <> 6 AS fine FROM answers)
      SELECT custom_id, CASE WHEN NOT fine THEN 'Timeout' END AS error_code, CASE WHEN fine THEN 200 END AS status_code,
        CASE WHEN fine THEN answer END AS text,
        CASE WHEN fine THEN CASE WHEN doc_id % 5 = 0 THEN 0 ELSE n_chars END END AS input_tokens,
        CASE WHEN fine THEN n_chars % 50 END AS output_tokens,
        CASE WHEN fine THEN CASE WHEN doc_id % 2 = 0 THEN 'small-1' ELSE 'small-2' END END AS model FROM ok""",
    "usage": """SELECT CASE WHEN doc_id % 2 = 0 THEN 'small-1' ELSE 'small-2' END AS model, count(*) AS requests,
      CAST(sum(CASE WHEN doc_id % 5 = 0 THEN 0 ELSE n_chars END) AS BIGINT) AS input_tokens,
      CAST(sum(n_chars % 50) AS BIGINT) AS output_tokens FROM documents WHERE doc_id % 12 <> 6 GROUP BY 1""",
    "submissions": """WITH b AS (
        SELECT doc_id % 5 AS batch, count(*) AS total_requests, CAST(count_if(doc_id % 12 <> 6) AS BIGINT) AS completed_requests,
          CAST(count_if(doc_id % 12 = 6) AS BIGINT) AS failed_requests, CAST(sum(doc_id % 10) AS DOUBLE) AS duration_seconds
        FROM documents GROUP BY 1)
      SELECT *, CASE WHEN failed_requests > 0 THEN 'completed_with_errors' ELSE 'completed' END AS status,
        round(completed_requests / nullif(duration_seconds, 0), 6) AS requests_per_second FROM b""",
    "scored_requests": f"""WITH {_CORPUS}, t AS (
        SELECT custom_id, length({_lines()}) AS size, row_number() OVER (ORDER BY custom_id) - 1 AS seq FROM corpus)
      SELECT seq, custom_id, CASE WHEN seq % 3 = 1 THEN 'b' ELSE 'a' END AS endpoint,
        CASE WHEN size % 11 <> 0 THEN CAST(size AS VARCHAR) END AS content,
        CASE WHEN size % 11 = 0 THEN 'ConnectionError' END AS error_code,
        CASE WHEN size % 11 = 0 THEN 3 ELSE 1 END AS attempts FROM t""",
    "output_texts": f"""WITH {_CORPUS}, {_ANSWERS} SELECT custom_id,
      CASE WHEN doc_id % 12 = 6 THEN '{{"code":"Timeout","message":"late"}}' END AS error,
      CASE WHEN doc_id % 12 <> 6 THEN answer END AS raw_text, false AS malformed FROM answers""",
    "statuses": f"WITH {_CORPUS} SELECT custom_id, {_STATUS} AS status, {_MESSAGE} AS message FROM corpus",
    "validation_counts": f"""SELECT coalesce(status, 'total') AS status, count(*) AS n
      FROM (SELECT {_STATUS} AS status FROM documents) GROUP BY ROLLUP (status)""",
    "free_form": f"""WITH {_CORPUS} SELECT custom_id, CASE WHEN doc_id % 12 = 6 THEN 'skipped'
      WHEN doc_id % 12 IN (4, 5) THEN 'invalid' ELSE 'valid' END AS status FROM corpus""",
    "nested_contract": f"""WITH {_CORPUS} SELECT custom_id,
      CASE WHEN doc_id % 10 IN (0, 1) THEN 'valid' ELSE 'invalid' END AS status,
      CASE WHEN doc_id % 10 = 2 THEN 'Schema validation error: contains_pii: expected boolean'
        WHEN doc_id % 10 BETWEEN 3 AND 7 THEN 'Schema validation error: pii_categories: expected array'
        WHEN doc_id % 10 = 8 THEN 'Schema validation error: answer: not an object'
        WHEN doc_id % 10 = 9 THEN 'Schema validation error: confidence: expected number >= 0.0 <= 1.0' END AS message
      FROM corpus""",
    "wide_contract": f"""WITH {_CORPUS} SELECT custom_id,
      CASE WHEN doc_id % 20 IN (0, 18, 19) THEN 'valid' ELSE 'invalid' END AS status FROM corpus""",
    "recursive_contract": f"""WITH {_CORPUS}, told AS (SELECT custom_id, CASE doc_id % 12
        WHEN 2 THEN 'parts[1].name: expected string minLength 1'
        WHEN 4 THEN 'counts.y: expected integer'
        WHEN 6 THEN 'size: expected exactly one of the options'
        WHEN 8 THEN 'code: expected value pattern ^x'
        WHEN 9 THEN 'name: missing; parts[0].name: missing'
        WHEN 10 THEN repeat('parts[0].', 3) || 'other: expected nothing here'
        WHEN 11 THEN 'answer: expected object' END AS wrong FROM corpus)
      SELECT custom_id, CASE WHEN wrong IS NULL THEN 'valid' ELSE 'invalid' END AS status,
        'Schema validation error: ' || wrong AS message FROM told""",
    "truth_labels": f"WITH {_TRUTH} SELECT filename, label FROM truth",
    "truth_quoted": """SELECT CASE doc_id % 3 WHEN 0 THEN doc_id || chr(10) || 'second "line"' WHEN 1 THEN 'a, ' || doc_id
        ELSE 'inch 5" ' || doc_id END AS filename, CASE WHEN doc_id % 2 = 0 THEN 'spam' ELSE 'ham' END AS label FROM documents""",
    "truth_prefix": f"WITH {_CORPUS} SELECT custom_id, {_PREFIX} AS by_prefix FROM corpus",
    "predictions": f"{_EVAL} SELECT custom_id, ground_truth, predicted, confidence FROM predicted",
    "labels": f"{_EVAL} SELECT ground_truth AS label FROM predicted UNION SELECT predicted FROM predicted",
    "confusion": f"""{_EVAL}, names AS (SELECT ground_truth AS label FROM predicted UNION SELECT predicted FROM predicted)
      SELECT g.label AS ground_truth, p.label AS predicted, count(r.custom_id) AS n
      FROM names g CROSS JOIN names p LEFT JOIN predicted r ON r.ground_truth = g.label AND r.predicted = p.label
      GROUP BY 1, 2""",
    "confusion_wide": f"""{_EVAL}, names AS (SELECT ground_truth AS label FROM predicted UNION SELECT predicted FROM predicted)
      SELECT 'True: ' || g.label AS truth, coalesce(count_if(r.predicted = 'Spam'), 0) AS "Pred: Spam", coalesce(count_if(r.predicted = 'ham'), 0) AS "Pred: ham",
        coalesce(count_if(r.predicted = 'none'), 0) AS "Pred: none", coalesce(count_if(r.predicted = 'spam'), 0) AS "Pred: spam_"
      FROM names g LEFT JOIN predicted r ON r.ground_truth = g.label GROUP BY g.label""",
    "per_class": f"{_EVAL}, {_classes('predicted')} {_CLASS_ROWS}",
    "summary": f"""{_EVAL}, {_classes('predicted')}, s AS (
        SELECT {_AVERAGES} FROM classes)
      SELECT metric, round(value, 6) AS value FROM (UNPIVOT s ON COLUMNS(*) INTO NAME metric VALUE value)""",
    "summary_auc": f"""WITH {_ROC}, fit AS (
        SELECT CASE WHEN pos = 1 THEN 'spam' ELSE 'ham' END AS ground_truth,
          CASE WHEN confidence >= 0.5 THEN 'spam' ELSE 'ham' END AS predicted FROM scored),
      {_classes('fit')}, area AS (SELECT sum((fpr - f) * (tpr + t) / 2) AS auc FROM (
        SELECT *, lag(fpr) OVER (ORDER BY point) AS f, lag(tpr) OVER (ORDER BY point) AS t FROM points)),
      s AS (SELECT {_AVERAGES}, any_value(auc) AS auc FROM classes, area)
      SELECT metric, round(value, 6) AS value FROM (UNPIVOT s ON COLUMNS(*) INTO NAME metric VALUE value)""",
    "raw_predictions": f"""{_EVAL} SELECT custom_id AS filename, ground_truth, predicted, confidence,
      ground_truth = predicted AS correct, CASE WHEN doc_id % 12 <> 8 THEN 'r ' || doc_id END AS reason,
      CAST(NULL AS VARCHAR) AS indicators, CAST(NULL AS VARCHAR) AS suspicious_urls,
      CAST(NULL AS VARCHAR) AS sender_analysis FROM predicted""",
    "roc": f"WITH {_ROC} SELECT point, fpr, tpr, threshold FROM points",
    "auc": f"""WITH {_ROC} SELECT round(sum((fpr - f) * (tpr + t) / 2), 6) AS auc FROM (
      SELECT *, lag(fpr) OVER (ORDER BY point) AS f, lag(tpr) OVER (ORDER BY point) AS t FROM points)""",
    "result_columns": f"""WITH {_CORPUS}, {_RESULT_KEYS}
      SELECT key, min(seq) AS seq, arg_min(pos, seq) AS pos FROM keyed GROUP BY key""",
    "results": f"""WITH {_CORPUS} SELECT custom_id AS filename,
      CASE doc_id % 12 WHEN 7 THEN NULL WHEN 10 THEN ' ' || upper(label[1]) || label[2:] || ' ' ELSE label END AS classification,
      CASE doc_id % 12 WHEN 1 THEN score WHEN 3 THEN '1.5' WHEN 9 THEN 'true' ELSE {_TEXT_SCORE} END AS confidence,
      CASE WHEN doc_id % 12 <> 8 THEN 'r ' || doc_id END AS reason, CASE WHEN doc_id % 12 = 2 THEN 'x' END AS mood
      FROM corpus WHERE doc_id % 12 NOT IN (4, 5, 6)""",
    "result_cells": f"""WITH {_CORPUS}
      SELECT custom_id AS filename, 'reason' AS key, 'r ' || doc_id AS cell FROM corpus WHERE doc_id % 12 NOT IN (4, 5, 6, 8)
      UNION ALL SELECT custom_id, 'mood', 'x' FROM corpus WHERE doc_id % 12 = 2""",
    "confusion_cells": f"""{_EVAL}, names AS (SELECT ground_truth AS label FROM predicted UNION SELECT predicted FROM predicted),
      places AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS place FROM names)
      SELECT g.place AS row, p.place AS "column", ground_truth, predicted, count(*) AS n
      FROM predicted r JOIN places g ON r.ground_truth = g.label JOIN places p ON r.predicted = p.label GROUP BY ALL""",
    "stage_stats": """SELECT event_type AS stage, count(value) AS count, round(sum(value), 3) AS total_ms,
      min(value) AS min_ms, max(value) AS max_ms, round(avg(value), 6) AS mean_ms FROM events GROUP BY 1""",
    "histogram": """SELECT event_type, CAST(b AS DOUBLE) AS le, CAST(count_if(value <= b) AS BIGINT) AS n
      FROM events CROSS JOIN (VALUES (0.5::DOUBLE), (1), (2), (5), (10), (30), (60), (120), (300), ('inf')) t(b) GROUP BY 1, 2""",
    "counters": """SELECT user_id, CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS status,
      count(*) AS n FROM events GROUP BY 1, 2""",
    "status_changes": f"WITH {_CHANGES} SELECT event_id, ts, user_id, event_type FROM changes",
    "state_age": f"""WITH {_CHANGES} SELECT user_id, arg_max(event_type, (ts, event_id)) AS status, max(ts) AS since,
      round(epoch(TIMESTAMP '2025-01-01') - epoch(max(ts)), 3) AS state_elapsed_seconds FROM changes GROUP BY user_id""",
    "progress": """WITH c AS (
        SELECT user_id, count(*) - count_if(event_type = 'view') AS planned,
          count_if(event_type IN ('purchase', 'signup', 'error')) AS done,
          coalesce(sum(CASE WHEN event_type = 'error' THEN value END), 0) AS seconds FROM events GROUP BY 1)
      SELECT user_id, CAST(greatest(planned, done) AS BIGINT) AS total_requests, CAST(done AS BIGINT) AS processed_requests,
        CAST(greatest(0, planned - done) AS BIGINT) AS remaining_requests,
        round(coalesce(done / nullif(greatest(planned, done), 0) * 100.0, 0.0), 4) AS percent_complete,
        CASE WHEN seconds > 0 AND done > 0 THEN round(done / seconds, 4) END AS speed_items_per_sec,
        CASE WHEN seconds > 0 AND done > 0 AND planned > done
          THEN round((planned - done) / (done / seconds), 4) END AS eta_seconds FROM c""",
    "labelling_job": f"""WITH {_CORPUS}, {_SECOND}, {_TRUTH}, fit AS (
        SELECT p.custom_id, t.label AS ground_truth, p.label AS predicted
        FROM passes p JOIN truth t ON t.filename = p.custom_id
        WHERE p.step IS NULL AND p.doc_id % 12 IN (0, 1, 6, 9, 11)),
      {_classes('fit')} {_CLASS_ROWS}""",
}
