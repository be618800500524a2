"""Result, prediction and evaluation tables in their export form."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptframe.functions.answers import cell_text, kind, member
from promptframe.functions.text import clean_xml
from promptframe.operators.contract import Contract
from promptframe.operators.evaluate import Evaluation, dense_confusion
from promptframe.operators.ordering import with_seq
from promptframe.session import durable
from promptframe.sources.storage import write_text

# Keys of answers that get a column of their own without being declared.
MAX_COLUMNS = 200
# Labels up to which an evaluation without named labels has its matrix in the JSON file.
MAX_LABELS = 1000

# Contract fields that the prediction columns already cover.
COVERED_FIELDS = ["label", "classification", "confidence", "certainty"]


def cell(value: Column) -> Column:
    """Export text of a variant: text cleaned, lists and objects as JSON, null empty."""
    return F.when(kind(value) == "STRING", clean_xml(cell_text(value))).otherwise(cell_text(value))


def extra_columns(valid: DataFrame, known: Sequence[str], seq: str) -> DataFrame:
    """``key, seq, pos``: unknown answer keys with the place of their first appearance."""
    keys = valid.select(F.col(seq).alias("seq"), F.posexplode(F.json_object_keys("raw_text")).alias("pos", "key"))
    fresh = keys.where(~F.col("key").isin([*known])) if known else keys
    first = fresh.groupBy("key").agg(F.min(F.struct("seq", F.col("pos").cast("long").alias("pos"))).alias("first"))
    return first.select("key", "first.seq", "first.pos")


def resolve_columns(
    valid: DataFrame, contract: Contract | None = None, order: Sequence[str] = ("custom_id",), most: int = MAX_COLUMNS
) -> list[str]:
    """Column names: filename, contract fields, then other keys by first appearance.

    Where the contract forbids other keys there are none to look for. Of other
    keys the ``most`` that appear first get a column, which is all that comes to
    the driver; ``result_cells`` holds the rest.
    """
    known = list(dict.fromkeys(["filename", *(contract.names if contract else [])]))
    if contract and contract.forbid_extra:
        return known
    # Numbering reads its input several times, so the checks behind it are cut off.
    numbered = with_seq(durable(valid.select(*order, "raw_text")), list(order), "_seq")
    found = extra_columns(numbered, known, "_seq").orderBy("seq", "pos", "key").limit(most).collect()
    return known + [r.key for r in found]


def results_table(valid: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One text column per name; ``filename`` is always the row's own id."""
    cells = [cell(member(F.col("data"), c)).alias(c) for c in columns if c != "filename"]
    return valid.select(clean_xml("custom_id").alias("filename"), *cells)


def result_cells(valid: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``filename, key, cell``: a row for each member of an answer that has no column in ``columns``.

    With ``results_table`` of the same columns it holds all members, however
    many different keys there are.
    """
    members = F.explode(F.map_entries(F.try_variant_get("data", "$", "map<string,variant>"))).alias("m")
    each = valid.select(clean_xml("custom_id").alias("filename"), members)
    rest = each.where(~F.col("m.key").isin([*columns])) if columns else each
    return rest.select("filename", F.col("m.key").alias("key"), cell(F.col("m.value")).alias("cell"))


def prediction_table(rows: DataFrame, contract: Contract | None = None) -> DataFrame:
    """Prediction columns, ``correct``, and the remaining contract fields."""
    extra = [n for n in (contract.names if contract else []) if n not in COVERED_FIELDS]
    return rows.select(
        F.col("custom_id").alias("filename"),
        "ground_truth",
        "predicted",
        "confidence",
        (F.col("ground_truth") == F.col("predicted")).alias("correct"),
        *[cell(member(F.col("data"), c)).alias(c) for c in extra],
    )


def confusion_wide(counts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """A ``Pred:`` column per label and a ``True:`` row per label."""
    # Sums rather than a pivot: labels that differ only in case stay apart.
    cells = [F.sum(F.when(F.col("predicted") == x, F.col("n"))).alias(f"Pred: {x}") for x in labels]
    truth = F.concat(F.lit("True: "), F.col("ground_truth")).alias("truth")
    return dense_confusion(counts, labels).groupBy(truth).agg(*cells)


def confusion_cells(result: Evaluation) -> DataFrame:
    """``row, column, ground_truth, predicted, n`` of the pairs that occur; places are those of the labels in order.

    The matrix of any number of labels: labels are numbered by ranges, and
    both numbers come to the pairs by joins.
    """
    places = durable(with_seq(result.labels, ["label"], "place"))
    of_truth = places.select(F.col("label").alias("ground_truth"), F.col("place").alias("row"))
    of_predicted = places.select(F.col("label").alias("predicted"), F.col("place").alias("column"))
    placed = result.counts.join(of_truth, "ground_truth").join(of_predicted, "predicted")
    return placed.select("row", "column", "ground_truth", "predicted", "n")


def write_confusion_cells(result: Evaluation, folder: str) -> None:
    """The cells as CSV files in the order of rows and columns, written by the executors."""
    write_table(confusion_cells(result).orderBy("row", "column"), folder)


def evaluation_dict(result: Evaluation, labels: Sequence[str] | None = None) -> dict:
    """The evaluation as plain data, ratios to four digits.

    Lists the given labels, else all of them up to ``MAX_LABELS``. Beyond that
    it has neither classes nor a matrix: those are in the tables of
    ``per_class`` and ``confusion_cells``, which no driver has to hold.
    """
    if labels is None:
        labels = [r.label for r in result.labels.limit(MAX_LABELS + 1).collect()]
        if len(labels) > MAX_LABELS:
            labels = []
    labels = list(labels)
    values = {r.metric: r.value for r in result.summary.collect()}
    listed = F.broadcast(result.counts.sparkSession.createDataFrame([(x,) for x in labels], "label string"))
    among = result.counts.join(listed, F.col("ground_truth") == F.col("label"), "left_semi")
    among = among.join(listed, F.col("predicted") == F.col("label"), "left_semi")
    cells = {(r.ground_truth, r.predicted): r.n for r in among.collect()}
    classes = sorted(result.per_class.join(listed, "label", "left_semi").collect(), key=lambda r: r.label)
    total = int(values.pop("total_predictions"))
    out = {name: round(value, 4) for name, value in values.items()}
    out["per_class"] = [
        {
            "label": r.label,
            **{m: round(r[m], 4) for m in ("precision", "recall", "f1")},
            **{m: r[m] for m in ("support", "tp", "fp", "fn")},
        }
        for r in classes
    ]
    out["confusion_matrix"] = {
        "labels": labels,
        "matrix": [[cells.get((t, p), 0) for p in labels] for t in labels],
    }
    out["total_predictions"] = total
    return out


def write_evaluation_json(result: Evaluation, path: str, labels: Sequence[str] | None = None) -> None:
    """One JSON file, on any storage that Spark reaches."""
    write_text(result.counts.sparkSession, path, json.dumps(evaluation_dict(result, labels), indent=2) + "\n")


def write_table(df: DataFrame, folder: str, form: str = "csv") -> None:
    """Write a report table as csv (with header), json or parquet."""
    writer = df.write.mode("overwrite")
    (writer.option("header", True).option("escape", '"') if form == "csv" else writer).format(form).save(folder)
