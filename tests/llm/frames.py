"""Small odd tables and plain versions of the operators."""

from __future__ import annotations

import re
from collections import Counter

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "doc int, row string, size string, hash double, line string, kept int, words int, spans int, node int, start int, `a b.c` int"
)
CLASHING = [1, "r", "s", 0.5, "l", 7, 8, 9, 10, 11, 12]

PROSE = (
    "The river ran low in the late summer and the boats lay on the mud near the old bridge. Nobody in the town could remember a year "
    "with so little rain, and the millers complained to anyone who would listen. Still the market opened every morning at seven, the "
    "bakers sold their bread before nine, and the children swam where the water was deep enough to hide a stone. In the evening the "
    "light came slowly over the hills and settled on the roofs like dust."
)
OTHER = (
    "Several engineers met at the harbour to discuss whether a second lighthouse would pay for itself within ten winters. Their reports "
    "disagreed about nearly everything except the cost of lamp oil, which had doubled since spring. After a long argument they walked "
    "along the pier, counted passing ships until dusk, and agreed only that another meeting was needed before anything could be signed "
    "or built, ideally somewhere warmer."
)

TEXTS = [
    (1, PROSE + "\nA shared closing line of the house\nshort", "en", "a"),
    (2, PROSE + "\n  A SHARED closing line of the house\t\nshort", "en", "a"),
    (3, OTHER + "\nA shared closing line of the house", "en", "b"),
    (4, OTHER.replace("harbour", "port"), "en", None),
    (5, None, "en", "b"),
    (6, "", None, "a"),
    (7, " \t\n\x0b ", "en", "c"),
    (8, "word", "fr", "c"),
    (9, "é", "fr", None),
    (10, "ab " * 4000, "en", "a"),
    (11, "x" * 30_000, "de", "é"),
    (12, "12345 !!! 678", "en", "é"),
    (13, "spam $$$ " * 100, "en", "a"),
    (14, "mail joe.doe@example.org or +1 (555) 010-2345 from 10.0.0.1\ncard 4111 1111 1111 1111", "en", "b"),
    (None, PROSE, "en", "a"),
    (None, None, None, None),
    (1, PROSE + "\nA shared closing line of the house\nshort", "en", "a"),
    (3, "another text under an id that is taken already\n\n", "en", "z"),
]


def docs(spark, texts=TEXTS):
    rows = [(i, t, lang, source, None if t is None else len(t), *CLASHING) for i, t, lang, source in texts]
    return spark.createDataFrame(rows, SCHEMA)


def plain(spark, texts):
    """Ids and texts alone."""
    return spark.createDataFrame([(i, t) for i, t in texts], "doc_id long, text string")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def base_measures(text):
    found = words(text)
    windows = Counter(tuple(found[i : i + 3]) for i in range(len(found) - 2))
    covered = {i + k for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for k in range(3)}
    seen, same = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            same += line in seen
            seen.add(line)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), same, len(covered)


def shingle_set(text, width):
    found = words(lower(text or ""))
    if len(found) < width:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + width]) for i in range(len(found) - width + 1)}


def components(sets, percent):
    """The smallest index that each index of ``sets`` reaches by links."""
    lead = list(range(len(sets)))

    def top(x):
        while lead[x] != x:
            x = lead[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and top(i) != top(j):
                a, b = sorted((top(i), top(j)))
                lead[b] = a
    return [top(i) for i in range(len(sets))]
