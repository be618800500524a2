"""HTML to text by element tree, for pages where tag stripping is too crude."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_SKIPPED = ("script", "style", "head")


class _TextNodes(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[str] = []
        self.skipping: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "body":
            self.skipping.clear()
        elif tag in _SKIPPED:
            self.skipping.append(tag)

    def handle_endtag(self, tag):
        if tag in self.skipping:
            while self.skipping.pop() != tag:
                pass

    def handle_data(self, data):
        if not self.skipping:
            self.nodes.append(data)


def tree_text(page: str) -> str:
    """Text nodes outside script, style and head, one per line."""
    parser = _TextNodes()
    parser.feed(page)
    parser.close()
    return "\n".join(parser.nodes).strip()


def html_to_text_tree(col: Column | str) -> Column:
    @F.pandas_udf("string")
    def convert(pages: pd.Series) -> pd.Series:
        return pages.map(tree_text, na_action="ignore")

    return convert(col)
