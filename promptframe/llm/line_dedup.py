"""Remove lines that other documents hold too.

A line's key is the line without white space at its ends, A-Z lower-cased.
Keys of at least ``min_chars`` code points that at least ``min_documents``
documents hold lose all their lines except in the smallest document id that
holds them. All other lines stay, in order, joined by a line feed.

Keys travel as two 64-bit hashes with the smallest and largest id and are
combined before the shuffle, so a line that a third of all documents share is
one row a task. Text is split once for the keys and once for the result, and
only the places of dropped lines are gathered by document.

Null text is one empty line and stays null. A null id is one document, after
all others. Rows that repeat an id are one document when holders are counted;
each row is cut by itself. An empty table gives an empty table. Other columns
pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptframe.llm.words import BLANKS, lower_ascii
from promptframe.scratch import Scratch

MIN_CHARS, MIN_DOCUMENTS = 10, 2


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _row_id(doc_id: str, text: str) -> Column:
    """Names a row; rows that agree in it are cut alike."""
    return F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.xxhash64(text).alias("text"))


def keyed_lines(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """``row, pos, h1, h2`` of every line that is long enough."""
    lines = docs.select(_row_id(doc_id, text).alias("row"), F.posexplode(split_lines(F.col(text))).alias("pos", "line"))
    keys = lines.select("row", "pos", line_key(F.col("line")).alias("key")).filter(F.char_length("key") >= min_chars)
    return keys.select("row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))


def repeated_keys(lines: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``h1, h2, keeper`` of the keys that enough documents hold."""
    holder = F.struct("row.none", "row.id")
    found = lines.groupBy("h1", "h2")
    if min_documents == 2:
        keys = found.agg(F.min(holder).alias("keeper"), F.max(holder).alias("last"))
        return keys.filter(F.col("keeper") != F.col("last")).drop("last")
    once = lines.groupBy("h1", "h2", holder.alias("holder")).agg(F.lit(1).alias("one"))
    keys = once.groupBy("h1", "h2").agg(F.min("holder").alias("keeper"), F.count("*").alias("holders"))
    return keys.filter(F.col("holders") >= min_documents).drop("holders")


def kept_text(lines: Column, drops: Column) -> Column:
    """The lines between the sorted places ``drops``, each run of them taken whole; null if none is left."""
    ends = F.concat(drops, F.array(F.size(lines)))
    starts = F.concat(F.array(F.lit(0)), F.transform(drops, lambda p: p + 1))
    runs = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda r: F.slice(lines, r["a"] + 1, r["b"] - r["a"]))
    kept = F.flatten(runs)
    return F.when(F.size(kept) > 0, F.array_join(kept, "\n"))


def dedup_lines(
    scratch: Scratch,
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    store_lines: bool = True,
) -> DataFrame:
    """``doc`` (the row as it was), ``n_lines``, ``n_dropped`` and ``kept``.

    ``kept`` is null where the text was null or every line went. Without
    ``store_lines`` lines are keyed twice instead of written once.
    """
    lines = keyed_lines(docs, doc_id, text, min_chars)
    if store_lines:
        lines = scratch.store(lines, "lines")
    # Stored, so that both sides of the join are plain shuffles and a common line can be split.
    keys = scratch.store(repeated_keys(lines, min_documents), "keys")
    drops = (
        lines.join(keys, ["h1", "h2"])
        .filter(F.struct("row.none", "row.id") != F.col("keeper"))
        .groupBy("row")
        .agg(F.sort_array(F.collect_set("pos")).alias("drops"))
        .select(F.col("row.none").alias("d_none"), F.col("row.id").alias("d_id"), F.col("row.text").alias("d_text"), "drops")
    )
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), _row_id(doc_id, text).alias("row"))
    same = (
        (F.col("row.none") == F.col("d_none"))
        & F.col("row.id").eqNullSafe(F.col("d_id"))
        & (F.col("row.text") == F.col("d_text"))
    )
    body = F.col("doc")[text]
    cut = kept_text(split_lines(body), F.col("drops"))
    breaks = F.char_length(body) - F.char_length(F.replace(body, F.lit("\n"), F.lit("")))
    return whole.join(drops, same, "left").select(
        "doc",
        (F.coalesce(breaks, F.lit(0)) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("drops").isNull(), body).otherwise(cut).alias("kept"),
    )
