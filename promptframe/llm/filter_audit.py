"""Audit how filters interact: what each one removes in every order, and its Shapley share.

Each filter is a failure condition. A document's failures are a mask of bits,
one a filter; documents are counted by part and mask, so a part is at most
``2 ** n`` counts, whatever its size. A coalition removes the documents that
fail any of its filters. Removals of all coalitions are tabulated from the
counts, and everything else comes from that table:

- a step of an order removes what its filter and those before remove together,
  less what those before remove alone;
- the Shapley share of a filter solves a least-squares problem: additive shares
  are fitted to the removals of all coalitions, weighted by the Shapley kernel,
  and have to sum to what all filters remove. Its normal equations have the same
  matrix for every part, which is inverted once in rationals; a part's right-hand
  side are whole numbers, so shares are exact. They are given times ``n!``,
  which is the sum of the filter's removals over all orders.

Copies: a document fails the filter ``copy`` if a smaller id has the same text
anywhere in the table. Texts travel as 128-bit hashes; the smallest id of each is
combined before the shuffle and only hashes that several ids hold are joined.

Null text is empty; a null id comes after all others and has no labels. Rows that
repeat an id are documents of their own and no copies of each other. Labels that
repeat an id count as marked if any row marks it. Null parts are the empty string.
An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction
from itertools import combinations, permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptframe.llm.words import BLANKS, word_count
from promptframe.scratch import Scratch

# The failure conditions of the contract, in order of their letters.
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT, SYMBOLS = 200, 50, 2, "[#$%&*|]"
LETTERS = "ABCDE"
MAX_FILTERS = 6
EXACT = "decimal(38,0)"


def failure_mask(text: Column) -> Column:
    """Bits 0 to 3: too few words, too few different words, too many capitals, a symbol."""
    body = F.coalesce(text, F.lit(""))
    words = word_count(text)
    # Blanks at the ends give an empty string, which is no word.
    distinct = F.size(F.array_remove(F.array_distinct(F.split(body, f"[{BLANKS}]+", -1)), ""))
    capitals = F.char_length(body) - F.char_length(F.regexp_replace(body, "[A-Z]+", ""))
    failures = [
        words < MIN_WORDS,
        100 * distinct < MIN_DISTINCT_PERCENT * words,
        100 * capitals > MAX_UPPER_PERCENT * F.char_length(body),
        body.rlike(SYMBOLS),
    ]
    return sum((F.when(failed, 1 << bit).otherwise(0) for bit, failed in enumerate(failures[1:], 1)), F.when(failures[0], 1).otherwise(0))


def mark_copies(scratch: Scratch, rows: DataFrame, bit: int) -> DataFrame:
    """``rows`` (``none, id, h1, h2, mask, ...``, stored) with ``bit`` in the masks of copies of a smaller id."""
    holder = F.struct("none", "id")
    ids = rows.groupBy("h1", "h2").agg(F.min(holder).alias("first"), F.max(holder).alias("last"))
    repeated = ids.filter(F.col("first") != F.col("last")).select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "first")
    # Stored, so that both sides of the join are plain shuffles and a text with very many copies can be split.
    repeated = scratch.store(repeated, "repeated")
    joined = rows.join(repeated, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")), "left")
    copy = F.when(F.col("first").isNotNull() & (holder != F.col("first")), 1 << bit).otherwise(0)
    return joined.withColumn("mask", F.col("mask") + copy).select(*rows.columns)


def shapley_rows(n: int) -> tuple[list[list[int]], int]:
    """Whole coefficients by filter and coalition, and what they are divided by, for shares times ``n!``.

    Minimise ``sum k(S) * (v(S) - sum(x[i] for i in S)) ** 2`` over all coalitions
    but the empty and the full one, with ``sum(x) = v(full)``.
    """
    full = (1 << n) - 1
    if n == 1:
        return [[0, 1]], 1
    members = [[i for i in range(n) if s >> i & 1] for s in range(full + 1)]
    kernel = [
        Fraction(n - 1, math.comb(n, len(m)) * len(m) * (n - len(m))) if 0 < len(m) < n else Fraction(0) for m in members
    ]
    # Normal equations with a multiplier for the sum, beside their right-hand sides as linear forms of the removals.
    system = []
    for i in range(n):
        left = [sum((kernel[s] for s in range(full) if s >> i & s >> j & 1), Fraction(0)) for j in range(n)] + [Fraction(1)]
        system.append(left + [kernel[s] if s >> i & 1 else Fraction(0) for s in range(full)] + [Fraction(0)])
    system.append([Fraction(1)] * n + [Fraction(0)] * (1 + full) + [Fraction(1)])
    for at in range(n + 1):
        pivot = next(r for r in range(at, n + 1) if system[r][at])
        system[at], system[pivot] = system[pivot], system[at]
        system[at] = [x / system[at][at] for x in system[at]]
        for r in range(n + 1):
            if r != at and system[r][at]:
                system[r] = [x - system[r][at] * y for x, y in zip(system[r], system[at])]
    scaled = [[x * math.factorial(n) for x in row[n + 1 :]] for row in system[:n]]
    common = math.lcm(*[x.denominator for row in scaled for x in row])
    return [[int(x * common) for x in row] for row in scaled], common


def coalition_table(masked: DataFrame, part: str, measures: Sequence[str], n: int) -> DataFrame:
    """``part``, ``total`` and, by measure, an array of what each coalition removes.

    ``masked``: ``part, mask`` and whole-number measures, already counted or not.
    """
    counts = masked.groupBy(part, "mask").agg(*[F.sum(m).cast("long").alias(m) for m in measures])
    cells = F.collect_list(F.struct("mask", *measures))  # at most 2 ** n of a part
    tables = counts.groupBy(part).agg(F.sum(measures[0]).cast("long").alias("total"), cells.alias("cells"))

    def removed(measure: str) -> Column:
        def by(coalition: Column) -> Column:
            hit = lambda total, c: total + F.when(c["mask"].bitwiseAND(coalition) != 0, c[measure]).otherwise(0)
            return F.aggregate("cells", F.lit(0).cast("long"), hit)

        return F.transform(F.sequence(F.lit(0), F.lit((1 << n) - 1)), by)

    return tables.select(part, "total", *[removed(m).alias(m) for m in measures], "cells")


def order_steps(tables: DataFrame, part: str, letters: str) -> DataFrame:
    """A row per part, order of filters and step, from ``coalition_table``."""
    n = len(letters)
    if n > MAX_FILTERS:
        raise ValueError(f"{n} filters have too many orders to list")
    steps = []
    for order in permutations(range(n)):
        name, before = "".join(letters[i] for i in order), 0
        for step, i in enumerate(order, 1):
            steps.append((name, step, i, 1 << i, before, before | 1 << i))
            before |= 1 << i
    made = [
        F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), *[F.lit(x).alias(c) for c, x in zip(("_f", "_own", "_before", "_after"), row)])
        for o, s, *row in steps
    ]
    coefficients, common = shapley_rows(n)
    exact = F.transform("failing", lambda v: v.cast(EXACT))
    shares = [
        (sum((exact[s] * F.lit(c) for s, c in enumerate(row) if c), F.lit(0).cast(EXACT)) / F.lit(common)).cast("long") for row in coefficients
    ]

    def alone(bit: int) -> Column:
        add = lambda total, c: total + F.when(c["mask"] == bit, c["failing"]).otherwise(0)
        return F.aggregate("cells", F.lit(0).cast("long"), add)

    only = F.array(*[alone(1 << i) for i in range(n)])
    ready = tables.select(part, "total", "failing", "good", "toxic", only.alias("_alone"), F.array(*shares).alias("_shares"))
    at = lambda column, place: F.col(column)[F.col(place)]
    gained = lambda column: at(column, "_after") - at(column, "_before")
    return ready.select("*", F.inline(F.array(*made))).select(
        part,
        "filter_order",
        "step",
        (F.col("total") - at("failing", "_after")).alias("kept"),
        gained("failing").alias("removed"),
        (at("failing", "_own") - gained("failing")).alias("redundant"),
        at("_alone", "_f").alias("unique_fails"),
        gained("good").alias("good_lost"),
        gained("toxic").alias("toxic_lost"),
        at("_shares", "_f").alias("shapley"),
    )


def audit(
    scratch: Scratch,
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "source",
) -> DataFrame:
    """The five filters on ``docs``: a row per part, order and step."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).isNull().alias("none"),
        F.col(doc_id).alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.xxhash64(body).alias("h1"),
        F.xxhash64(F.lit(7), body).alias("h2"),
        failure_mask(F.col(text)).alias("mask"),
    )
    rows = mark_copies(scratch, scratch.store(rows, "rows"), bit=len(LETTERS) - 1)
    marks = labels.groupBy(F.col("doc_id").alias("l_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    # Rows that agree are one from here on: a common id is a few rows for every task before it.
    counted = rows.groupBy("none", "id", "part", "mask").agg(F.count("*").alias("n"))
    counted = scratch.store(counted, "counted")
    unmarked = counted.filter("none").select("part", "mask", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    marked = counted.filter("NOT none").join(scratch.store(marks, "marks"), F.col("id") == F.col("l_id"), "left")
    marked = marked.select("part", "mask", "n", *[F.coalesce(m, F.lit(0)).alias(m) for m in ("good", "toxic")])
    masked = marked.unionByName(unmarked).select(
        "part", "mask", F.col("n").alias("failing"), *[(F.col("n") * F.col(m)).alias(m) for m in ("good", "toxic")]
    )
    tables = coalition_table(masked, "part", ["failing", "good", "toxic"], len(LETTERS))
    return order_steps(scratch.store(tables, "tables"), "part", LETTERS)
