"""Documents from a folder: names are judged before contents are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promptframe.functions.text import suffix

# Suffixes of mail files, and suffixes that are never mail.
MAIL_SUFFIXES = [".eml", ".txt", ".msg"]
OTHER_SUFFIXES = [
    ".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tiff", ".webp", ".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx",
    ".zip", ".gz", ".tar", ".bz2", ".7z", ".rar", ".mp3", ".mp4", ".avi", ".mov", ".wav", ".exe", ".dll", ".so", ".dylib",
    ".py", ".js", ".ts", ".css", ".html", ".json", ".xml", ".csv", ".toml", ".yaml", ".yml", ".ini", ".cfg", ".conf",
    ".md", ".rst", ".log",
]


def accepts_mail_name(name: Column | str) -> Column:
    """True for mail suffixes and for names with no known foreign suffix."""
    return F.when(suffix(name).isin(MAIL_SUFFIXES), True).otherwise(~suffix(name).isin(OTHER_SUFFIXES))


def file_name(path: Column | str) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def list_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``custom_id, path, length`` of the files directly in ``folder``.

    The content column is not selected, so no file is opened. Spark leaves out
    names that start with ``_`` or ``.``; ``storage.hidden_names`` lists them.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder)
    return files.select(file_name("path").alias("custom_id"), "path", "length")


def read_documents(spark: SparkSession, folder: str, accepts=accepts_mail_name) -> DataFrame:
    """``custom_id, path, length, content`` of the accepted files.

    The name test is put on the scan's file metadata, so refused files are
    dropped while the scan is planned and never opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder)
    # The metadata name is percent-encoded.
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    kept = files.where(accepts(name))
    return kept.select(file_name("path").alias("custom_id"), "path", "length", "content")
