"""License texts and mentions by ordered signature rules.

A rule is a regular expression over words with one keyword in angle brackets,
a label, a priority and a weight. Keywords gate the work twice: texts without
any keyword are not split, and a rule is tried only at places of its keyword,
on the ``REACH`` words before and after it. Every place of every rule is a
detection, an interval of words.

Detections that overlap are resolved by priority and containment: one that lies
within a detection of stronger priority goes, as does one within a longer
detection of its own priority; of equal intervals of one priority the first
label stays. Detections of phrases that the caller fixes (priority 0) always
stay. All detections of a text are resolved in one sorted pass.

Rules are made from names of licenses and forms of speech: a declaration by tag,
a grant, a title, a bare name; sentences of the license texts stand beside them.

A-Z are lower-cased; words are runs of digits, letters and all beyond ASCII.
Null text is empty. Rows that repeat an id and text are scanned alike. Null ids
are ids like any other. A text of any length is scanned whole. An empty table
gives an empty table. Other columns pass through, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from promptframe.functions.frames import compute_once
from promptframe.llm.words import lower_ascii
from promptframe.scratch import Scratch

# The gaps between words, before and after lower-casing.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Words before and after a keyword that a rule may see; no rule is longer.
REACH = 24
MAX_RULES = 5000

# Priorities, strongest first.
FIXED, TEXT, TAG, GRANT, TITLE, NAME = range(6)


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    priority: int
    weight: float

    @property
    def keyword(self) -> str:
        return re.search("<([^>]+)>", self.pattern).group(1)


# Phrases whose places are counted.
PHRASES = [
    Rule("mit", "under the <mit> license", FIXED, 1.0),
    Rule("apache-2", "<apache> license version 2", FIXED, 1.0),
    Rule("cc-by-nc", "<cc> by nc", FIXED, 1.0),
]

# Names by label; each is how a license is written out, its keyword in angle brackets.
_V = "(?:version |v )?"
NAMES = {
    "mit": ["<mit>(?: x11)?", "<expat>"],
    "apache-1.1": [f"<apache>(?: software)?(?: license| licence)? {_V}1 1"],
    "apache-2": [f"<apache>(?: software)?(?: license| licence)? {_V}2(?: 0)?", "<apache2>"],
    "bsd-2-clause": ["<bsd> 2 clause", "2 clause <bsd>", "simplified <bsd>", "<freebsd>"],
    "bsd-3-clause": ["<bsd> 3 clause", "3 clause <bsd>", "(?:new|modified|revised) <bsd>"],
    "bsd-4-clause": ["<bsd> 4 clause", "4 clause <bsd>", "original <bsd>"],
    "gpl-1": [f"<gpl> {_V}1(?: 0)?", f"gnu <general> public licen[cs]e {_V}1"],
    "gpl-2": [f"<gpl> {_V}2(?: 0)?", "<gplv2>", f"gnu <general> public licen[cs]e {_V}2"],
    "gpl-3": [f"<gpl> {_V}3(?: 0)?", "<gplv3>", f"gnu <general> public licen[cs]e {_V}3"],
    "gpl": ["gnu <gpl>", "gnu <general> public"],
    "lgpl-2": [f"<lgpl> {_V}2(?: 0)?", f"gnu <library> general public licen[cs]e {_V}2"],
    "lgpl-2.1": [f"<lgpl> {_V}2 1", f"gnu <lesser> general public licen[cs]e {_V}2 1"],
    "lgpl-3": [f"<lgpl> {_V}3(?: 0)?", "<lgplv3>", f"gnu <lesser> general public licen[cs]e {_V}3"],
    "agpl-3": [f"<agpl> {_V}3(?: 0)?", "<agplv3>", f"gnu <affero> general public licen[cs]e {_V}3"],
    "mpl-1.1": [f"<mpl> {_V}1 1", f"<mozilla> public licen[cs]e {_V}1 1"],
    "mpl-2": [f"<mpl> {_V}2(?: 0)?", f"<mozilla> public licen[cs]e {_V}2(?: 0)?"],
    "epl-1": [f"<epl> {_V}1(?: 0)?", f"<eclipse> public licen[cs]e {_V}1(?: 0)?"],
    "epl-2": [f"<epl> {_V}2(?: 0)?", f"<eclipse> public licen[cs]e {_V}2(?: 0)?"],
    "eupl": ["<eupl>", "<european> union public"],
    "cddl": ["<cddl>", "common development and <distribution>"],
    "cc0": ["<cc0>", "creative <commons> zero"],
    "cc-by": ["<cc> by", "creative <commons> attribution"],
    "cc-by-sa": ["<cc> by sa", "creative <commons> attribution share ?alike"],
    "cc-by-nd": ["<cc> by nd", "creative <commons> attribution no ?deriv[a-z]*"],
    "cc-by-nc": ["<cc> by nc", "creative <commons> attribution non ?commercial"],
    "cc-by-nc-sa": ["<cc> by nc sa", "creative <commons> attribution non ?commercial share ?alike"],
    "cc-by-nc-nd": ["<cc> by nc nd", "creative <commons> attribution non ?commercial no ?deriv[a-z]*"],
    "isc": ["<isc>"],
    "zlib": ["<zlib>(?: libpng)?"],
    "boost": ["<boost> software", "<bsl> 1 0"],
    "unlicense": ["<unlicense>"],
    "wtfpl": ["<wtfpl>"],
    "artistic-1": [f"<artistic>(?: licen[cs]e)? {_V}1(?: 0)?"],
    "artistic-2": [f"<artistic>(?: licen[cs]e)? {_V}2(?: 0)?"],
    "psf": ["<python> software foundation", "<psf>"],
    "ofl": ["sil <open> font", "<ofl>"],
    "odbl": ["<odbl>", "open <database>"],
    "ms-pl": ["<microsoft> public"],
    "ms-rl": ["<microsoft> reciprocal"],
    "postgresql": ["<postgresql>"],
    "php": ["<php>(?: 3 01)?"],
    "ncsa": ["<ncsa>", "university of illinois <ncsa>(?: open source)?"],
}

# How a name is used: before and after it, priority, weight. The last is a name of one word or more alone.
FORMS = [
    ("spdx licen[cs]e identifier ", "(?: or later| only)?", TAG, 0.99),
    ("licen[cs]e ", "(?: or later| only)?", TAG, 0.8),
    ("(?:licen[cs]ed|released|distributed|published|available|provided|made available) under (?:the )?(?:terms of )?(?:the )?", "(?: licen[cs]e)?", GRANT, 0.95),
    ("(?:subject to|governed by|covered by|according to|see) (?:the )?(?:terms of )?(?:the )?", "(?: licen[cs]e)?", GRANT, 0.85),
    ("(?:the )?", " licen[cs]e", TITLE, 0.7),
]
# Names that are no usual words count without any form.
PLAIN_NAMES = {
    "apache-2", "gpl-2", "gpl-3", "lgpl-2.1", "lgpl-3", "agpl-3", "mpl-2", "epl-2", "cc0", "cc-by", "cc-by-sa", "cc-by-nd", "cc-by-nc",
    "cc-by-nc-sa", "cc-by-nc-nd", "wtfpl", "unlicense", "bsd-2-clause", "bsd-3-clause",
}

# Sentences of license texts.
SENTENCES = [
    Rule("mit", "permission is hereby <granted> free of charge to any person obtaining a copy of this software", TEXT, 1.0),
    Rule("boost", "permission is hereby <granted> free of charge to any person or organization obtaining a copy of the software", TEXT, 1.0),
    Rule("isc", "permission to use copy modify and or <distribute> this software for any purpose with or without fee is hereby granted", TEXT, 1.0),
    Rule("zlib", "this software is provided as is without any express or <implied> warranty in no event will the authors", TEXT, 1.0),
    Rule("bsd", "<redistribution> and use in source and binary forms with or without modification are permitted", TEXT, 0.9),
    Rule("bsd-3-clause", "neither the name of .{1,80} may be used to <endorse> or promote products derived", TEXT, 1.0),
    Rule("bsd-4-clause", "all advertising materials mentioning features or use of this software must <display>", TEXT, 1.0),
    Rule("gpl-2", "<gnu> general public license .{0,60}either version 2 of the license or", TEXT, 1.0),
    Rule("gpl-3", "<gnu> general public license .{0,60}either version 3 of the license or", TEXT, 1.0),
    Rule("unlicense", "this is free and <unencumbered> software released into the public domain", TEXT, 1.0),
    Rule("wtfpl", "do what the <fuck> you want to public license", TEXT, 1.0),
    Rule("public-domain", "(?:placed|released|dedicated) (?:in|into|to) the <public> domain", GRANT, 0.8),
    Rule("cc0", "waives? all copyright and related or <neighboring> rights", TEXT, 0.9),
    Rule("proprietary", "all rights <reserved>", NAME, 0.4),
    Rule("proprietary", "(?:strictly )?confidential and <proprietary>", TITLE, 0.7),
    Rule("proprietary", "may not be <reproduced> (?:distributed )?(?:or transmitted )?in any form", TITLE, 0.6),
]


def default_rules() -> list[Rule]:
    """Names in all their forms, beside the sentences: some hundreds, in order of priority."""
    rules = list(SENTENCES)
    for label, names in NAMES.items():
        for name in names:
            rules += [Rule(label, before + name + after, priority, weight) for before, after, priority, weight in FORMS]
            if label in PLAIN_NAMES:
                rules.append(Rule(label, name, NAME, 0.5))
    return sorted(rules, key=lambda r: (r.priority, r.label, r.pattern))


def rule_frame(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """``keyword, label, priority, weight, pattern``: a table of the size of the caller's list."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules are more than the {MAX_RULES} that are sent to every task")
    rows = [(r.keyword, r.label, r.priority, r.weight, rf"(?:^| )({r.pattern})(?: |$)") for r in rules]
    return spark.createDataFrame(rows, "keyword string, label string, priority int, weight double, pattern string")


def row_key(doc_id: str, text: str) -> Column:
    return F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.xxhash64(text).alias("text"))


def keyword_places(docs: DataFrame, doc_id: str, text: str, keywords: list[str]) -> DataFrame:
    """``row, place, keyword, window``: each keyword with the words around it, itself in angle brackets."""
    lowered = compute_once(docs.select(row_key(doc_id, text).alias("row"), F.col(text).alias("body")), low=F.lower("body"))
    gate = F.lit(False)
    for stem in gates(keywords):
        gate = gate | F.contains("low", F.lit(stem))
    words = F.split(F.trim(F.regexp_replace(lower_ascii(F.col("body")), GAP, " ")), " ")
    split = compute_once(lowered.filter(gate).select("row", "body"), words=words).select("row", "words")

    def at(word: Column, i: Column) -> Column:
        before = F.slice("words", F.greatest(i - REACH + 1, F.lit(1)), F.least(i, F.lit(REACH)))
        after = F.slice("words", i + 2, F.lit(REACH))
        window = F.array_join(F.concat(before, F.array(F.concat(F.lit("<"), word, F.lit(">"))), after), " ")
        return F.when(word.isin(keywords), F.struct(i.alias("place"), word.alias("keyword"), window.alias("window")))

    found = F.filter(F.transform("words", at), lambda x: x.isNotNull())
    return split.select("row", F.inline(found))


def gates(keywords: list[str]) -> list[str]:
    """The keywords that hold no other keyword."""
    return [k for k in sorted(set(keywords)) if not any(o != k and o in k for o in keywords)]


def detections(places: DataFrame, rules: DataFrame) -> DataFrame:
    """``row, start, end, label, priority, weight`` of every rule that holds at a place; ends are inclusive."""
    hit = places.join(F.broadcast(rules), "keyword").withColumn("hit", F.call_function("regexp_extract", F.col("window"), F.col("pattern"), F.lit(1)))
    blanks = lambda c: F.char_length(c) - F.char_length(F.replace(c, F.lit(" "), F.lit("")))
    start = F.col("place") - blanks(F.substring_index("hit", "<", 1))
    found = hit.filter("hit <> ''").withColumn("start", start.cast("long"))
    found = found.select("row", "start", (F.col("start") + blanks(F.col("hit"))).alias("end"), "label", "priority", "weight")
    # Rules of one label that hold in the same words are one detection, as are rows that repeat.
    return found.groupBy("row", "start", "end", "label", "priority").agg(F.max("weight").alias("weight"))


def resolve(found: DataFrame) -> DataFrame:
    """``found`` without detections inside stronger ones, or inside longer ones of their own priority."""
    # Whatever contains a detection starts no later and, from the same start, ends no earlier.
    earlier = (
        Window.partitionBy("row").orderBy("start", F.desc("end"), "priority", "label").rowsBetween(Window.unboundedPreceding, -1)
    )
    reach = [F.max(F.when(F.col("priority") <= p, F.col("end"))).over(earlier).alias(f"_reach{p}") for p in range(NAME + 1)]
    marked = found.select("*", *reach)
    covered = F.element_at(F.array(*[F.col(f"_reach{p}") for p in range(NAME + 1)]), F.col("priority") + 1) >= F.col("end")
    return marked.filter((F.col("priority") == FIXED) | ~F.coalesce(covered, F.lit(False))).select(*found.columns)


def scan(
    scratch: Scratch,
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    rules: list[Rule] | None = None,
    phrases: list[Rule] = PHRASES,
    keep_text: bool = True,
) -> DataFrame:
    """``doc`` (the row as it was) and what was found in it.

    ``n_words``; of the fixed phrases ``n_base, first_word, last_word`` and
    ``base_labels``; ``labels`` of all that stays; ``score``, the probability
    that at least one of the labels is right.
    """
    rules = [*phrases, *(default_rules() if rules is None else rules)]
    found = detections(keyword_places(docs, doc_id, text, sorted({r.keyword for r in rules})), rule_frame(docs.sparkSession, rules))
    kept = resolve(scratch.store(found, "detections"))
    fixed = F.col("priority") == FIXED
    by_label = kept.groupBy("row", "label").agg(
        F.max("weight").alias("weight"),
        F.count(F.when(fixed, 1)).alias("n"),
        F.min(F.when(fixed, F.col("start"))).alias("first"),
        F.max(F.when(fixed, F.col("start"))).alias("last"),
    )
    # Labels of a row are at most those of the rules.
    listed = lambda c: F.array_join(F.sort_array(F.collect_list(c)), ",")
    weights = F.sort_array(F.collect_list("weight"))
    by_row = by_label.groupBy("row").agg(
        F.sum("n").alias("n_base"),
        F.min("first").alias("first_word"),
        F.max("last").alias("last_word"),
        listed(F.when(F.col("n") > 0, F.col("label"))).alias("base_labels"),
        listed(F.col("label")).alias("labels"),
        (1 - F.aggregate(weights, F.lit(1.0), lambda left, w: left * (1 - w))).alias("score"),
    )
    # Stored, so that both sides of the join are plain shuffles and rows that repeat very often can be split.
    by_row = scratch.store(by_row.select(*[F.col(f"row.{c}").alias(f"_{c}") for c in ("none", "id", "text")], *by_row.columns[1:]), "rows")
    columns = [c for c in docs.columns if keep_text or c != text]
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"),
        row_key(doc_id, text).alias("row"),
        F.coalesce(F.regexp_count(text, F.lit(RAW_WORD)), F.lit(0)).cast("long").alias("n_words"),
    )
    same = (F.col("row.none") == F.col("_none")) & F.col("row.id").eqNullSafe(F.col("_id")) & (F.col("row.text") == F.col("_text"))
    return whole.join(by_row, same, "left").select(
        "doc",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("base_labels", "labels")],
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
