"""Quality rules as weak supervision.

Each rule looks at one measure of a text and votes good, bad, or abstains. No
rule rejects by itself: expectation-maximisation over the votes of all
documents estimates how often each rule is right on good and on bad documents
and how common good ones are, without labels, and the posterior probability of
good decides. What the estimation needs of the corpus is the count of each
combination of votes, at most ``3 ** rules`` rows however many documents there
are, and the posterior goes back to the documents by that combination.

A text with fewer than 50 words, or more than half of whose words lie in
repeated 3-word windows, fails whatever the votes.

Null and empty texts have no words and fail. Null ids pass through. Rows that
repeat an id are measured each for itself. An empty table gives an empty table.
Other columns pass through, whatever their names. One text is in memory at a
time, with numbers for its words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptframe.llm.words import beside
from promptframe.scratch import Scratch

# Fixed values of the base measures.
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 50, 50, 3

GOOD, BAD, ABSTAIN = 1, 2, 0
# Votes: the measure; good from, good to; bad below, bad above (None: never).
RULES = {
    "word_length": (3.0, 9.0, 2.5, 12.0),
    "symbols_per_word": (0.0, 0.02, None, 0.1),
    "repeated_share": (0.0, 0.1, None, 0.35),
    "same_line_share": (0.0, 0.05, None, 0.3),
    "distinct_share": (0.3, 1.0, 0.15, None),
    "upper_share": (0.0, 0.2, None, 0.4),
    "punctuation_share": (0.0, 0.06, None, 0.08),
    "digit_share": (0.0, 0.1, None, 0.25),
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

_UPPER, _PUNCTUATION, _DIGITS = (
    bytes(range(65, 91)),
    bytes(x for x in range(33, 127) if not chr(x).isalnum()),
    bytes(range(48, 58)),
)
_WORD_BITS = 21


def repeated_words(numbers: np.ndarray) -> int:
    """Words in 3-word windows that the text holds twice or more; ``numbers`` are equal where words are."""
    n = len(numbers) - WINDOW + 1
    if n < 2:
        return 0
    if numbers.max() >= 1 << _WORD_BITS:
        numbers = np.unique(numbers, return_inverse=True)[1]
    if numbers.max() >= 1 << _WORD_BITS:
        pairs = np.unique((numbers[:-1].astype(np.int64) << 32) | numbers[1:], return_inverse=True)[1]
        windows = (pairs[:-1].astype(np.int64) << 32) | numbers[2:]
    else:
        windows = (numbers[:-2] << (2 * _WORD_BITS)) | (numbers[1:-1] << _WORD_BITS) | numbers[2:]
    order = np.argsort(windows, kind="stable")
    ordered = windows[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(numbers), bool)
    for k in range(WINDOW):
        covered[k : k + n] |= twice
    return int(covered.sum())


def new_numbers() -> dict[bytes, int]:
    """Gives every new word the next number."""
    return defaultdict(count().__next__)


def measure(text: str, numbers: dict[bytes, int]) -> tuple[list[int], list[float]]:
    """The base measures, and the measures of :data:`RULES`."""
    data = text.encode()
    words = data.split()  # splits at the six blanks and at no others
    n = len(words)
    if not n:
        return [0, 0, 0, 0, 0], [0.0] * len(RULES)
    chars = len(text) - (len(data) - len(data.translate(None, BLANKS)))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    same_lines = len(lines) - len(set(lines))
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, n)
    repeated = repeated_words(ids)
    size = len(data)
    share = [size - len(data.translate(None, x)) for x in (_UPPER, _PUNCTUATION, _DIGITS)]
    return [n, chars, symbols, same_lines, repeated], [
        chars / n,
        symbols / n,
        repeated / n,
        same_lines / len(lines),
        len(np.unique(ids)) / n,
        share[0] / chars,
        share[1] / chars,
        share[2] / chars,
    ]


def votes(measures: np.ndarray) -> np.ndarray:
    """The votes of all rules as one number in base 3; a row per text."""
    code = np.zeros(len(measures), np.int64)
    for k, (low, high, below, above) in enumerate(RULES.values()):
        x = measures[:, k]
        bad = np.zeros(len(x), bool)
        if below is not None:
            bad |= x < below
        if above is not None:
            bad |= x > above
        good = (x >= low) & (x <= high) & ~bad
        code += 3**k * np.where(good, GOOD, np.where(bad, BAD, ABSTAIN))
    return code


def measured(docs: DataFrame, text: str, keep_text: bool) -> DataFrame:
    """``docs`` as ``doc``, with the base measures and ``votes``."""
    kept = [c for c in docs.columns if keep_text or c != text]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), F.col(text).alias("body"))
    schema = beside(packed, "doc", **{m: "long" for m in [*MEASURES, "votes"]})

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = new_numbers()
        for batch in batches:
            base, rates = [], []
            for one in batch.column(1):
                if len(numbers) > 1_000_000:
                    numbers = new_numbers()
                b, r = measure(one.as_py() or "", numbers)
                base.append(b)
                rates.append(r)
            base = np.array(base, np.int64).reshape(-1, len(MEASURES))
            code = votes(np.array(rates, float).reshape(-1, len(RULES)))
            columns = [batch.column(0), *[pa.array(base[:, k]) for k in range(len(MEASURES))], pa.array(code)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", *MEASURES, "votes"])

    return packed.mapInArrow(rows, schema)


def estimate(codes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """The probability of good for each combination of votes.

    Expectation-maximisation of a mixture of good and bad documents in which
    the rules that do not abstain vote independently. A bad document breaks
    some rules and keeps others, so a vote for bad says much more than one for
    good: it starts where good documents get 3 votes in 100 for bad and bad
    ones 40. A rule never counts as wrong on more than a tenth of the good
    documents. Counts are smoothed, so a rule that never votes does no harm.
    """
    cast = np.stack([codes // 3**k % 3 for k in range(len(RULES))], axis=1)
    good, bad = (cast == GOOD).astype(float), (cast == BAD).astype(float)
    right_good = np.full(len(RULES), 0.97)  # of the votes on good documents, those for good
    right_bad = np.full(len(RULES), 0.4)  # of the votes on bad documents, those for bad
    prior = 0.7
    for _ in range(rounds):
        log_good = np.log(prior) + good @ np.log(right_good) + bad @ np.log(1 - right_good)
        log_bad = np.log(1 - prior) + good @ np.log(1 - right_bad) + bad @ np.log(right_bad)
        posterior = 1 / (1 + np.exp(np.clip(log_bad - log_good, -500, 500)))
        w, v = counts * posterior, counts * (1 - posterior)
        before = right_good, right_bad, prior
        right_good = np.clip((w @ good + 9.7) / (w @ (good + bad) + 10), 0.9, 0.999)
        right_bad = np.clip((v @ bad + 4) / (v @ (good + bad) + 10), 0.05, 0.999)
        prior = float(np.clip((w.sum() + 7) / (counts.sum() + 10), 0.01, 0.99))
        if max(np.abs(right_good - before[0]).max(), np.abs(right_bad - before[1]).max(), abs(prior - before[2])) < 1e-9:
            break
    return posterior


def judge(scratch: Scratch, docs: DataFrame, text: str = "text", least: float = 0.5, keep_text: bool = True) -> DataFrame:
    """``doc`` (the row as it was), the base measures, ``base_failed``, ``probability`` of good and ``kept``.

    With their texts, rows are measured twice, for the counts and for the
    result, so that texts are not written in between.
    """
    rows = measured(docs, text, keep_text)
    if not keep_text:
        rows = scratch.store(rows, "measured")
    counted = measured(docs.select(text), text, False) if keep_text else rows
    found = counted.groupBy("votes").count().collect()  # at most 3 ** rules
    codes, counts = np.array([r["votes"] for r in found], np.int64), np.array([r["count"] for r in found], float)
    probability = estimate(codes, counts) if found else []
    known = docs.sparkSession.createDataFrame(
        [(int(c), float(p)) for c, p in zip(codes, probability)], "votes long, probability double"
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    out = rows.join(F.broadcast(known), "votes").withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= least))
