import json
import random

import pytest
from pyspark.sql import functions as F

from promptframe.functions.answers import parse_whole
from promptframe.operators import evaluate as E
from promptframe.operators import reports, truth
from promptframe.operators.contract import SPAM_CONTRACT
from promptframe.sources.truth import prefix_map


def rows(spark, items):
    full = [(f"{i:06}", t, p, c) for i, (t, p, c) in enumerate(items)]
    return spark.createDataFrame(full, "custom_id string, ground_truth string, predicted string, confidence double")


def pairs(spark, *items):
    return rows(spark, [(t, p, None) for t, p in items])


def values(result):
    return {r.metric: r.value for r in result.summary.collect()}


def test_published_run(spark):
    """The confusion counts and the ratios published with them."""
    cells = [("ham", "ham", 210), ("ham", "spam", 60), ("spam", "ham", 4), ("spam", "spam", 177)]
    result = E.evaluate(pairs(spark, *[(t, p) for t, p, n in cells for _ in range(n)]))
    report = reports.evaluation_dict(result)
    assert report["accuracy"] == 0.8581 and report["total_predictions"] == 451
    assert [report[f"macro_{m}"] for m in ("f1", "precision", "recall")] == [0.8573, 0.8641, 0.8778]
    assert [report[f"weighted_{m}"] for m in ("precision", "recall", "f1")] == [0.8872, 0.8581, 0.8594]
    ham, spam = report["per_class"]
    assert [ham[m] for m in ("precision", "recall", "f1", "support")] == [0.9813, 0.7778, 0.8678, 270]
    assert [spam[m] for m in ("precision", "recall", "f1", "support")] == [0.7468, 0.9779, 0.8469, 181]
    assert report["confusion_matrix"] == {"labels": ["ham", "spam"], "matrix": [[210, 60], [4, 177]]}


def test_small_cases(spark):
    right = values(E.evaluate(pairs(spark, ("a", "a"), ("b", "b"), ("a", "a"), ("b", "b"))))
    assert right["accuracy"] == right["macro_f1"] == 1.0
    assert values(E.evaluate(pairs(spark, ("a", "b"), ("b", "a"))))["accuracy"] == 0.0
    counts = E.confusion_counts(pairs(spark, ("spam", "spam"), ("spam", "spam"), ("spam", "ham"), ("ham", "ham")))
    spam = E.per_class(counts).where("label = 'spam'").head()
    assert (spam.tp, spam.fn, spam.recall) == (2, 1, 2 / 3)
    none = E.evaluate(rows(spark, []))
    assert none.labels.count() == 0 and values(none)["accuracy"] == 0.0 and none.roc is None
    only_predicted = E.per_class(E.confusion_counts(pairs(spark, ("a", "z")))).where("label = 'z'").head()
    assert (only_predicted.precision, only_predicted.recall, only_predicted.f1) == (0.0, 0.0, 0.0)


def test_confusion_tables(spark):
    result = E.evaluate(pairs(spark, ("b", "a"), ("Spam", "spam"), ("b", "a")))
    assert [r.label for r in result.labels.collect()] == ["Spam", "a", "b", "spam"]
    listed = [r.label for r in result.labels.collect()]
    assert E.dense_confusion(result.counts, listed).count() == 16
    wide = reports.confusion_wide(result.counts, [r.label for r in result.labels.collect()])
    assert wide.columns == ["truth", "Pred: Spam", "Pred: a", "Pred: b", "Pred: spam"]
    table = {r[0]: tuple(r[1:]) for r in wide.collect()}
    assert table["True: b"] == (0, 2, 0, 0) and table["True: Spam"] == (0, 0, 0, 1)
    many = E.evaluate(pairs(spark, *[(f"t{i}", f"p{i % 7}") for i in range(1005)]))
    assert many.labels.count() == 1012 and many.counts.count() == 1005
    assert len(reports.evaluation_dict(many)["per_class"]) == 1012
    assert reports.evaluation_dict(many, ["t1", "p1"])["confusion_matrix"]["matrix"] == [[0, 1], [0, 0]]


def sequential_roc(items, positive):
    """The rule in plain Python: one point per scored row, ties in input order."""
    scored = sorted(((c, t == positive) for t, _, c in items if c is not None), key=lambda x: -x[0])
    pos = sum(p for _, p in scored)
    neg = len(scored) - pos
    if not pos or not neg:
        return [], 0.0
    points, tp, fp = [(0.0, 0.0, 1.0)], 0, 0
    for confidence, is_pos in scored:
        tp, fp = tp + is_pos, fp + (not is_pos)
        points.append((round(fp / neg, 6), round(tp / pos, 6), round(confidence, 6)))
    area = sum((b[0] - a[0]) * (b[1] + a[1]) / 2 for a, b in zip(points, points[1:]))
    return points, round(area, 6)


@pytest.mark.parametrize("digits", [1, 2, 9])
def test_roc_equals_the_sequential_rule(spark, digits):
    rng = random.Random(digits)
    items = [
        (rng.choice(["spam", "ham", "ham"]), "spam", None if rng.random() < 0.1 else round(rng.random(), digits))
        for _ in range(1280)
    ]
    steps = E.roc_steps(rows(spark, items).repartition(6), "spam", ranges=7)
    points, area = sequential_roc(items, "spam")
    got = E.roc_points(steps).orderBy("point").collect()
    assert [(r.fpr, r.tpr, r.threshold) for r in got] == points
    assert E.auc(steps).head().auc == pytest.approx(area, abs=1e-6)


def test_roc_edge_cases(spark):
    equal = [("spam", "spam", 0.5), ("ham", "spam", 0.5), ("spam", "ham", 0.5)]
    result = E.evaluate(rows(spark, equal), "spam")
    points, area = sequential_roc(equal, "spam")
    assert result.roc.count() == len(points) and result.auc == area and values(result)["auc"] == area
    one_class = rows(spark, [("spam", "ham", 0.5), ("spam", "spam", 0.4)])
    assert E.evaluate(one_class, "spam").roc is None
    assert E.roc_points(E.roc_steps(one_class, "spam")).count() == 0
    assert E.auc(E.roc_steps(one_class, "spam")).head().auc == 0.0
    three = rows(spark, [("a", "b", 0.5), ("c", "a", 0.4)])
    assert E.evaluate(three, "a").roc is None
    assert E.evaluate(rows(spark, equal)).roc is None


def test_auc_of_known_curves(spark):
    def area(*items):
        return E.auc(E.roc_steps(rows(spark, [(t, "x", c) for t, c in items]), "p")).head().auc

    assert area(("p", 0.9), ("n", 0.1)) == 1.0
    assert area(("n", 0.9), ("p", 0.1)) == 0.0
    assert area(("p", 0.9), ("n", 0.8), ("n", 0.2), ("p", 0.1)) == 0.5


def test_labels_and_confidences(spark):
    texts = ['{"label":" SPAM\\u00a0","confidence":"0.9"}', '{"label":null,"confidence":"0.9f"}', '{"label":true,"confidence":1}', "{}"]
    valid = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "custom_id string, raw_text string")
    got = truth.predictions(valid.withColumn("data", parse_whole("raw_text"))).orderBy("custom_id").collect()
    assert [(r.predicted, r.confidence) for r in got] == [("spam", 0.9), ("none", None), ("true", 1.0), ("", None)]


def test_truth_resolution(spark):
    ids = ["a.eml", "SPAM__1", " ham __x__2", "unknown.eml", "spam_3", "empty__4"]
    predicted = spark.createDataFrame([(i,) for i in ids], "custom_id string")
    known = spark.createDataFrame([("a.eml", "ham"), ("empty__4", "")], "filename string, label string")
    prefixes = prefix_map(spark, {"Spam": "SPAM", "spam": "second", "ham": "ham", "empty": "no"})
    found = {r.custom_id: r.ground_truth for r in truth.resolve_truth(predicted, known, prefixes).collect()}
    assert found == {"a.eml": "ham", "SPAM__1": "SPAM", " ham __x__2": "ham", "empty__4": ""}
    assert truth.resolve_truth(predicted, None, prefixes).count() == 3
    assert truth.resolve_truth(predicted, known).count() == 2
    assert truth.resolve_truth(predicted).count() == 0


def answers(spark):
    texts = ['{"z":1,"classification":"spam","list":["é",1]}', '{"classification":"h\\u0007am","b":true,"filename":"own"}']
    valid = spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "custom_id string, raw_text string")
    return valid.withColumn("data", parse_whole("raw_text"))


def test_result_columns_and_cells(spark):
    valid = answers(spark)
    columns = reports.resolve_columns(valid)
    assert columns == ["filename", "z", "classification", "list", "b"]
    got = reports.results_table(valid, columns).orderBy("filename").collect()
    assert [tuple(r) for r in got] == [("f0", "1", "spam", '["é",1]', None), ("f1", None, "ham", None, "true")]
    assert reports.resolve_columns(valid, SPAM_CONTRACT) == ["filename", *SPAM_CONTRACT.names]


def test_columns_are_bounded_and_cells_hold_the_rest(spark):
    valid = answers(spark)
    columns = reports.resolve_columns(valid, most=2)
    assert columns == ["filename", "z", "classification"]
    cells = sorted(map(tuple, reports.result_cells(valid, columns).collect()))
    assert cells == [("f0", "list", '["é",1]'), ("f1", "b", "true")]
    many = spark.range(500).select(F.col("id").cast("string").alias("custom_id"), F.format_string('{"k%d":%d}', "id", "id").alias("raw_text"))
    many = many.withColumn("data", parse_whole("raw_text"))
    columns = reports.resolve_columns(many)
    assert len(columns) == 1 + reports.MAX_COLUMNS
    wide, long = reports.results_table(many, columns), reports.result_cells(many, columns)
    filled = sum(v is not None for r in wide.collect() for v in r[1:])
    assert filled == reports.MAX_COLUMNS and long.count() == 500 - filled


def test_confusion_of_very_many_labels(spark, tmp_path):
    n = 5000
    label = lambda c: F.concat(F.lit("l"), F.lpad(c.cast("string"), 6, "0"))
    truth_of = spark.range(3 * n).select(label(F.col("id") % n).alias("ground_truth"), label((F.col("id") * 7) % n).alias("predicted"))
    rows = truth_of.withColumns({"custom_id": F.lit("x"), "confidence": F.lit(0.5)})
    result = E.evaluate(rows)
    saved = reports.evaluation_dict(result)
    assert saved["total_predictions"] == 3 * n and saved["confusion_matrix"]["labels"] == [] and saved["per_class"] == []
    two = reports.evaluation_dict(result, ["l000000", "l000007"])
    assert two["confusion_matrix"]["matrix"] == [[3, 0], [0, 0]] and len(two["per_class"]) == 2
    reports.write_confusion_cells(result, str(tmp_path / "cells"))
    cells = spark.read.option("header", True).option("inferSchema", True).csv(str(tmp_path / "cells"))
    assert cells.agg(F.sum("n")).head()[0] == 3 * n
    wrong = cells.where((label(F.col("row")) != F.col("ground_truth")) | (label(F.col("column")) != F.col("predicted")))
    assert wrong.count() == 0


def test_prediction_table_and_files(spark, tmp_path):
    frame = answers(spark).withColumns({"ground_truth": F.lit("spam"), "predicted": F.lit("spam"), "confidence": F.lit(0.5)})
    table = reports.prediction_table(frame, SPAM_CONTRACT)
    assert table.columns == [
        "filename", "ground_truth", "predicted", "confidence", "correct", "reason", "indicators", "suspicious_urls",
        "sender_analysis",
    ]
    assert table.head().correct is True
    for form in ("csv", "json", "parquet"):
        reports.write_table(table, str(tmp_path / form), form)
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    result = E.evaluate(pairs(spark, ("a", "a"), ("b", "a")))
    reports.write_evaluation_json(result, str(tmp_path / "e.json"))
    assert json.loads((tmp_path / "e.json").read_text())["accuracy"] == 0.5


def test_rows_that_share_an_id_are_split_in_the_join(spark):
    """A third of all rows has one id: the partition that holds it is split while the job runs."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
        predicted = spark.range(0, 60_000, 1, 12).select(hot.alias("custom_id"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        known = predicted.select(F.col("custom_id").alias("filename"), F.lit("ham").alias("label"))
        known = known.groupBy("filename").agg(F.max("label").alias("label"))
        joined = truth.join_truth(predicted, known)
        assert len(joined.where("by_id = 'ham'").collect()) == 60_000
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
