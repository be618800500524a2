"""Column expressions that several of these operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The white space and the words of every operator here.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_count(text: Column) -> Column:
    """Words of ``text``; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    only_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def held_out(doc_id: Column) -> Column:
    """Whether a row belongs to the fifth that no model learns from; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def beside(packed: DataFrame, column: str, **more: str) -> StructType:
    """The schema of ``column`` of ``packed`` and further columns."""
    out = StructType([packed.schema[column]])
    for name, kind in more.items():
        out.add(name, kind)
    return out
