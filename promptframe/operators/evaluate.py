"""Confusion counts, class metrics, ROC and AUC."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptframe.functions.numbers import ratio, round_exact
from promptframe.operators.ordering import running_sums
from promptframe.session import durable


def confusion_counts(rows: DataFrame) -> DataFrame:
    """``ground_truth, predicted, n`` for the pairs that occur.

    The one step that sees the rows: counted before the shuffle, so a frequent
    pair does not gather. What follows works on label pairs.
    """
    return rows.groupBy("ground_truth", "predicted").agg(F.count("*").alias("n"))


def label_set(counts: DataFrame) -> DataFrame:
    """``label``: truth and predicted labels, in code point order."""
    both = F.explode(F.array("ground_truth", "predicted")).alias("label")
    return counts.select(both).distinct().orderBy("label")


def dense_confusion(counts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """``ground_truth, predicted, n`` with a row for every pair of the given labels."""
    listed = F.array(*[F.lit(x) for x in labels]).cast("array<string>")
    zero = counts.sparkSession.createDataFrame([(x,) for x in labels], "ground_truth string")
    grid = zero.select("ground_truth", F.explode(listed).alias("predicted"), F.lit(0).cast("long").alias("n"))
    return grid.unionByName(counts).groupBy("ground_truth", "predicted").agg(F.sum("n").alias("n"))


def per_class(counts: DataFrame) -> DataFrame:
    """``label, tp, fp, fn, support, precision, recall, f1`` per label; 0.0 on zero denominators."""
    same = F.col("ground_truth") == F.col("predicted")
    zero = F.lit(0).cast("long")

    def part(label: str, tp: Column, fp: Column, fn: Column) -> Column:
        return F.struct(F.col(label).alias("label"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))

    n = F.col("n")
    as_truth = part("ground_truth", F.when(same, n).otherwise(zero), zero, F.when(same, zero).otherwise(n))
    as_predicted = part("predicted", zero, F.when(same, zero).otherwise(n), zero)
    parts = counts.select(F.explode(F.array(as_truth, as_predicted)).alias("p")).select("p.*")
    sums = parts.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    scored = sums.withColumns(
        {"support": tp + fn, "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn)}
    )
    p, r = F.col("precision"), F.col("recall")
    return scored.withColumn("f1", ratio(2 * p * r, p + r))


SUMMARY_METRICS = [
    "accuracy",
    "macro_precision",
    "macro_recall",
    "macro_f1",
    "weighted_precision",
    "weighted_recall",
    "weighted_f1",
]


def summary(classes: DataFrame, auc_value: float | None = None) -> DataFrame:
    """``metric, value``: accuracy, macro and weighted averages, total, AUC if given."""
    support = F.coalesce(F.sum("support"), F.lit(0))
    aggregates = [ratio(F.sum("tp"), support).alias("accuracy")]
    for m in ("precision", "recall", "f1"):
        aggregates.append(F.coalesce(F.avg(m), F.lit(0.0)).alias(f"macro_{m}"))
        aggregates.append(ratio(F.sum(F.col(m) * F.col("support")), support).alias(f"weighted_{m}"))
    one = classes.agg(*aggregates, support.cast("double").alias("total_predictions"))
    names = [*SUMMARY_METRICS, "total_predictions"]
    pairs = [F.struct(F.lit(n).alias("metric"), F.coalesce(F.col(n), F.lit(0.0)).alias("value")) for n in names]
    if auc_value is not None:
        pairs.append(F.struct(F.lit("auc").alias("metric"), F.lit(auc_value).alias("value")))
    return one.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def roc_steps(
    rows: DataFrame,
    positive: str,
    order: Sequence[Column | str] = ("custom_id",),
    ranges: int | None = None,
) -> DataFrame:
    """Running counts behind the ROC: one row per scored prediction, best confidence first.

    Equal confidences stay in the given order and yield a point each. Empty
    unless both classes occur.
    """
    is_positive = (F.col("ground_truth") == positive).cast("long")
    names = {f"_o{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(order)}
    scored = rows.where(F.col("confidence").isNotNull()).select(
        "confidence", is_positive.alias("_p"), (1 - is_positive).alias("_q"), *[c.alias(n) for n, c in names.items()]
    )
    # These few columns are read several times; what they come from is read once.
    scored = durable(scored)
    totals = scored.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_p", "_q")]).head()
    running = running_sums(
        scored.where(F.lit(totals["_p"] > 0 and totals["_q"] > 0)),
        [-F.col("confidence"), *names],
        ranges,
        tp=F.col("_p"),
        fp=F.col("_q"),
    )
    positives, negatives = F.lit(max(1, totals["_p"])), F.lit(max(1, totals["_q"]))

    def point(count: Column, total: Column) -> Column:
        return round_exact(count / total, 6)

    tp, fp = F.col("tp"), F.col("fp")
    return running.select(
        "confidence",
        "tp",
        "fp",
        point(fp, negatives).alias("fpr"),
        point(tp, positives).alias("tpr"),
        # The point before is the row's own count without its own part.
        point(fp - F.col("_q"), negatives).alias("fpr_before"),
        point(tp - F.col("_p"), positives).alias("tpr_before"),
    )


def roc_points(steps: DataFrame) -> DataFrame:
    """``point, fpr, tpr, threshold``: the origin, then a point per step; empty if there is no step."""
    number = (F.col("tp") + F.col("fp")).alias("point")
    own = F.struct(number, "fpr", "tpr", round_exact(F.col("confidence"), 6).alias("threshold"))
    zero, one = F.lit(0.0), F.lit(1.0)
    start = F.struct(F.lit(0).cast("long").alias("point"), zero.alias("fpr"), zero.alias("tpr"), one.alias("threshold"))
    # The first step brings the origin along, so the steps are worked out once.
    both = F.when(F.col("tp") + F.col("fp") == 1, F.array(start, own)).otherwise(F.array(own))
    return steps.select(F.inline(both))


def auc(steps: DataFrame) -> DataFrame:
    """``auc``: trapezoids over the rounded points, to six digits; 0.0 without points."""
    area = (F.col("fpr") - F.col("fpr_before")) * ((F.col("tpr") + F.col("tpr_before")) / 2)
    return steps.agg(round_exact(F.coalesce(F.sum(area), F.lit(0.0)), 6).alias("auc"))


@dataclass(frozen=True)
class Evaluation:
    """The frames of an evaluation, in long form however many labels there are.

    ``counts`` has the label pairs that occur; ``dense_confusion`` and the wide
    table take the labels to list.
    """

    predictions: DataFrame
    counts: DataFrame
    per_class: DataFrame
    summary: DataFrame
    labels: DataFrame
    roc: DataFrame | None
    auc: float | None


def evaluate(
    rows: DataFrame,
    positive: str | None = None,
    order: Sequence[Column | str] = ("custom_id",),
) -> Evaluation:
    """Evaluate ``custom_id, ground_truth, predicted, confidence`` rows.

    The rows are read once for the label pairs, which are kept; ROC and AUC
    follow only for a named positive class and exactly two labels.
    """
    counts = durable(confusion_counts(rows))
    labels = label_set(counts)
    classes = per_class(counts)
    curve, area = None, None
    if positive and len(labels.take(3)) == 2:
        steps = durable(roc_steps(rows, positive, order))
        if steps.take(1):
            curve, area = roc_points(steps), auc(steps).head().auc
    return Evaluation(rows, counts, classes, summary(classes, area), labels, curve, area)
