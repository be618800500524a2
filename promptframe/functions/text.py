"""String columns with Unicode-aware whitespace, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Unicode counts as whitespace, with the four
# separators U+001C..U+001F, which regex engines leave out.
_SPACE_CODES = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
_SPACE_CODES += [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_SPACES = "".join(map(chr, _SPACE_CODES))
_SPACE = r"\s\x1c-\x1f"
_INNER_SPACE = rf"(?U)[{_SPACE}&&[^\n]]+"
_ANY_SPACE = rf"(?U)[{_SPACE}]+"
# Fixed value: characters XML 1.0 allows, up to U+FFFD.
_NOT_XML = r"[^\t\n\r\x{20}-\x{D7FF}\x{E000}-\x{FFFD}]"


def strip(col: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.trim(col, F.lit(_SPACES))


def squeeze_whitespace(col: Column | str) -> Column:
    """At most one blank line in a row, single spaces, no outer whitespace."""
    col = F.col(col) if isinstance(col, str) else col
    # The byte search is far cheaper than the pattern, and most texts have no such run.
    lines = F.when(col.contains("\n\n\n"), F.regexp_replace(col, r"\n{3,}", "\n\n")).otherwise(col)
    return strip(F.regexp_replace(lines, _INNER_SPACE, " "))


def html_to_text_basic(col: Column | str) -> Column:
    """Replace tags by spaces and squeeze; text inside scripts stays."""
    return strip(F.regexp_replace(F.regexp_replace(col, r"<[^>]+>", " "), _ANY_SPACE, " "))


def clean_xml(col: Column | str) -> Column:
    """Drop characters that spreadsheets and XML 1.0 refuse."""
    return F.regexp_replace(col, _NOT_XML, "")


def token_estimate(col: Column | str) -> Column:
    """About four characters per token, at least one."""
    return F.greatest(F.lit(1), F.floor(F.length(col) / 4).cast("int"))


def suffix(name: Column | str) -> Column:
    """Lower-cased last suffix of a file name with its dot, else ``""``."""
    return F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1))


def json_quote(col: Column | str) -> Column:
    """A string column as a JSON string literal."""
    boxed = F.to_json(F.array(F.col(col) if isinstance(col, str) else col))
    return boxed.substr(F.lit(2), F.length(boxed) - 2)


def fingerprint(col: Column | str, prefix: str = "", digits: int = 16) -> Column:
    """Id derived from content: prefix plus leading hex digits of SHA-256."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(col, 256), 1, digits))
