"""CSV with line feeds in quotes, split and unsplit."""

import random

import pytest
from pyspark.sql import functions as F

from promptframe.sources import quoted
from promptframe.sources.truth import last_label_wins, read_truth_csv


def unsplit(spark, path):
    """The engine's own reader of whole files."""
    cells = spark.read.schema("filename string, label string").option("multiLine", True).option("escape", '"').csv(path)
    order = F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id())
    kept = cells.where(F.col("filename").isNotNull())
    return sorted(tuple(r) for r in last_label_wins(kept, order).collect())


def some_text(rnd, n):
    def cell(k):
        kind = rnd.randrange(6)
        if kind == 0:
            return f'"name {k}\nsecond, ""line""\n\nlast"'
        if kind == 1:
            return f'"a ""quoted"" {k}"'
        if kind == 2:
            return f'"comma, {k}"'
        if kind == 3:
            return f'inch 5" {k}'
        return f"plain {k}"

    return "".join(f"{cell(k)},{rnd.choice(['spam', 'ham', '\"two\nlines\"', '\"x\"\"\"'])}\n" for k in range(n))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_split_reading_equals_unsplit(spark, tmp_path, seed):
    rnd = random.Random(seed)
    folder = tmp_path / "truth"
    folder.mkdir()
    for k in range(3):
        (folder / f"{k}.csv").write_text(some_text(rnd, 400))
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 12
        got = sorted(tuple(r) for r in read_truth_csv(spark, str(folder), header=False).collect())
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert got == unsplit(spark, str(folder)) and any("\n" in name for name, _ in got)


def test_header_and_open_end(spark, tmp_path):
    (tmp_path / "t.csv").write_text('filename,label\n"a\nb",Spam\n\nc,ham\n"never closed,x\ny,z\n')
    got = sorted(tuple(r) for r in read_truth_csv(spark, str(tmp_path / "t.csv")).collect())
    assert got == [("a\nb", "spam"), ("c", "ham")]


def test_states_of_lines(spark):
    lines = ['a,b', '"a', 'b",c', '"x,""y', '"",', 'z",1', 'q 5",2', '"a",b,"c', 'd","e', 'f",g']
    frame = spark.createDataFrame(list(enumerate(lines)), "n int, value string").withColumn("file", F.lit("f"))
    for ranges in (1, 3, 7):
        found = quoted.joined_records(frame, F.struct("n"), ranges)
        got = [r.value for r in sorted(found.collect(), key=lambda r: r._order.n)]
        assert got == ["a,b", '"a\nb",c', '"x,""y\n"",\nz",1', 'q 5",2', '"a",b,"c\nd","e\nf",g']
