"""Small text files on any storage that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of one file, or None where there is none."""
    place, files = _place(spark, path)
    if not files.exists(place) or not files.getFileStatus(place).isFile():
        return None
    return spark.read.text(str(path), wholetext=True).head()[0] if files.getFileStatus(place).getLen() else ""


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one file; its folder is made, an old file replaced."""
    place, files = _place(spark, path)
    stream = files.create(place, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def hidden_names(spark: SparkSession, folder: str) -> list[str]:
    """The files directly in ``folder`` that Spark's scans leave out, by their first character."""
    place, files = _place(spark, folder)
    names = (s.getPath().getName() for s in files.listStatus(place) if s.isFile())
    return sorted(n for n in names if n.startswith(("_", ".")))


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _place(spark, path)
    return files.exists(place)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names directly in ``folder``, sorted; none where there is no such folder."""
    place, files = _place(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def make_folder(spark: SparkSession, folder: str) -> None:
    place, files = _place(spark, folder)
    files.mkdirs(place)


def move(spark: SparkSession, old: str, new: str) -> None:
    place, files = _place(spark, old)
    if not files.rename(place, _place(spark, new)[0]):
        raise OSError(f"cannot move {old} to {new}")
