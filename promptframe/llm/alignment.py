"""Align the tokens of two tokenizers over the same bytes.

A text's two token sequences are cut into groups at the byte offsets where a
token of each ends. The cuts are found by divide and conquer: an interval of
tokens looks for a common end near its middle, by bisecting the other side's
ends for those of the middle token, then of the tokens 1, 2-3, 4-7 ... places
from it; a cut splits the interval in two, and an interval without a cut is a
leaf, a group. All intervals of many texts take a step side by side, so there
are about as many steps as the logarithm of the longest text.

The last tokens of a group end together and are a link. Links are counted by
pair of ids over all texts: each text brings its different pairs with their
counts. What a text needs of the corpus (how common its pairs are, and whether
they are the best of their second id) comes back by a join on the pair. The
commonest pairs, at most ``BROADCAST_PAIRS``, are broadcast; the others, if any,
are joined by shuffle, where no pair is common.

Texts that are null, empty, or not given back byte for byte by both tokenizers
have no tokens. Null ids pass through, rows that repeat an id or text are texts
of their own, an empty table gives an empty table, and other columns pass
through, whatever their names. Texts are encoded whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from promptframe.llm.packing import Encoder
from promptframe.scratch import Scratch

# Bytes of text that are aligned side by side.
BATCH_BYTES = 1 << 20
# Pairs that are sent to every task, at some 50 bytes each.
BROADCAST_PAIRS = 500_000
# A pair is one number: the first id above, the second below.
SECOND = 32


class PieceEncoder:
    """Ids of a ``sentencepiece`` model, which puts a space before the text."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.model.get_piece_size()
        self.token_bytes = {}
        for i in range(size):
            piece = self.model.id_to_piece(i)
            self.token_bytes[i] = bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Vocabulary:
    """Bytes of ids, their lengths, and their digits before each separator."""

    # None, within a side of a group, after the first side, after the group.
    SEPARATORS = ("", ",", "|", ";")

    def __init__(self, token_bytes: dict[int, bytes]):
        size = max(token_bytes) + 1
        self.bytes = [token_bytes.get(i, b"") for i in range(size)]
        self.lengths = np.array([len(x) for x in self.bytes], np.int64)
        self.digits = np.array([f"{i}{s}" for s in self.SEPARATORS for i in range(size)], object)
        self.size = size

    def gives(self, ids: list[int], whole: bytes) -> bool:
        return b"".join(map(self.bytes.__getitem__, ids)) == whole


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, texts_a: np.ndarray, texts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of each side that end a group, in order.

    ``ends_*``: ascending byte offsets at which tokens end, of many texts one
    after the other. ``texts_*``: how many tokens the texts end with, where both
    sides have the same offset.
    """
    # Intervals (a0, a1, b0, b1) hold tokens a0 .. a1 - 1 and b0 .. b1 - 1 and end together.
    a1, b1 = texts_a.astype(np.int64), texts_b.astype(np.int64)
    work = np.stack([np.concatenate([[0], a1[:-1]]), a1, np.concatenate([[0], b1[:-1]]), b1])
    last_a, last_b = [], []
    while work.shape[1]:
        found_a, found_b = _near_middle(ends_a, ends_b, work)
        leaf = found_a < 0
        last_a.append(work[1, leaf] - 1)
        last_b.append(work[3, leaf] - 1)
        parted, cut_a, cut_b = work[:, ~leaf], found_a[~leaf] + 1, found_b[~leaf] + 1
        left = np.stack([parted[0], cut_a, parted[2], cut_b])
        right = np.stack([cut_a, parted[1], cut_b, parted[3]])
        # Halves stay side by side, so bisects run over the ends in order.
        work = np.stack([left, right], axis=2).reshape(4, -1)
    return np.sort(np.concatenate(last_a)), np.sort(np.concatenate(last_b))


def _near_middle(ends_a: np.ndarray, ends_b: np.ndarray, work: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each interval, the tokens of a common end before its own end, near the middle; -1 where there is none."""
    first, stop, first_b, stop_b = work[0], work[1] - 1, work[2], work[3] - 1  # the last tokens end together anyway
    middle = (first + stop) // 2
    found_a, found_b = np.full(work.shape[1], -1), np.full(work.shape[1], -1)
    open_ = np.flatnonzero((stop > first) & (stop_b > first_b))
    near = 0
    while len(open_):
        far = max(1, 2 * near)  # distances near .. far - 1
        spread = np.arange(near, far)
        spread = np.concatenate([spread, -spread]) if near else spread
        tried = middle[open_, None] + spread
        inside = (tried >= first[open_, None]) & (tried < stop[open_, None])
        row, column = np.nonzero(inside)
        token = tried[row, column]
        other = np.searchsorted(ends_b, ends_a[token])
        hit = (ends_b[np.minimum(other, len(ends_b) - 1)] == ends_a[token]) & (other >= first_b[open_[row]]) & (other < stop_b[open_[row]])
        at, token, other = open_[row[hit]], token[hit], other[hit]
        found_a[at], found_b[at] = token, other
        left = found_a[open_] < 0
        open_ = open_[left & ((middle[open_] - far >= first[open_]) | (middle[open_] + far < stop[open_]))]
        near = far
    return found_a, found_b


def _spans(counts: np.ndarray) -> np.ndarray:
    """Starts of consecutive runs of ``counts`` elements, and their end."""
    return np.concatenate([[0], np.cumsum(counts)])


def align_tokens(ids_a: list[list[int]], ids_b: list[list[int]], voc_a: Vocabulary, voc_b: Vocabulary) -> list[tuple]:
    """``n_groups, pairs, times, digits`` of each text; both sides of a text give the same bytes, at least one."""
    flat_a, flat_b = np.array(list(chain(*ids_a)), np.int64), np.array(list(chain(*ids_b)), np.int64)
    texts_a, texts_b = _spans(np.array([len(x) for x in ids_a])), _spans(np.array([len(x) for x in ids_b]))
    ends_a, ends_b = np.cumsum(voc_a.lengths[flat_a]), np.cumsum(voc_b.lengths[flat_b])
    last_a, last_b = shared_cuts(ends_a, ends_b, texts_a[1:], texts_b[1:])
    pairs = flat_a[last_a] << SECOND | flat_b[last_b]
    groups = np.concatenate([[0], np.searchsorted(last_a, texts_a[1:])])
    # Digits: the first side's tokens of a group, then the second's.
    kind_a, kind_b = np.ones(len(flat_a), np.int64), np.ones(len(flat_b), np.int64)
    kind_a[last_a], kind_b[last_b] = 2, 3
    kind_b[texts_b[1:] - 1] = 0
    before_a = np.concatenate([[0], last_b + 1])[np.searchsorted(last_a, np.arange(len(flat_a)))]
    before_b = (last_a + 1)[np.searchsorted(last_b, np.arange(len(flat_b)))]
    parts = np.empty(len(flat_a) + len(flat_b), object)
    parts[np.arange(len(flat_a)) + before_a] = voc_a.digits[kind_a * voc_a.size + flat_a]
    parts[np.arange(len(flat_b)) + before_b] = voc_b.digits[kind_b * voc_b.size + flat_b]
    out = []
    for t in range(len(ids_a)):
        own, times = np.unique(pairs[groups[t] : groups[t + 1]], return_counts=True)
        written = "".join(parts[texts_a[t] + texts_b[t] : texts_a[t + 1] + texts_b[t + 1]])
        out.append((int(groups[t + 1] - groups[t]), own, times, written))
    return out


def _lists(rows) -> pa.ListArray:
    ends = _spans(np.array([len(x) for x in rows], np.int64)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.array([], np.int64), *rows]).astype(np.int64)))


def token_links(docs: DataFrame, text: str, json_path: str, model_path: str, keep_text: bool) -> DataFrame:
    """``doc, n_a, n_b, n_groups, groups_sha256, pairs, times`` of each row."""
    context = docs.sparkSession.sparkContext
    with open(json_path, encoding="utf-8") as file:
        json_file = context.broadcast(file.read())
    with open(model_path, "rb") as file:
        model_file = context.broadcast(file.read())
    columns = [c for c in docs.columns if keep_text or c != text]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), F.col(text).alias("body"))
    schema = StructType([packed.schema["doc"]])
    for name, kind in [("n_a", "long"), ("n_b", "long"), ("n_groups", "long"), ("groups_sha256", "string")]:
        schema.add(name, kind)
    schema.add("pairs", ArrayType(LongType())).add("times", ArrayType(LongType()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = Encoder(json_file.value, literal=True)
        second = PieceEncoder(model_file.value)
        voc_a, voc_b = Vocabulary(first.token_bytes), Vocabulary(second.token_bytes)

        def links(texts: list[str]) -> list[tuple]:
            ids_a, ids_b = [first.ids(" " + x) for x in texts], second.ids(texts)
            whole = [(" " + x).encode() for x in texts]
            same = [i for i, w in enumerate(whole) if voc_a.gives(ids_a[i], w) and voc_b.gives(ids_b[i], w)]
            out = [(0, 0, 0, "", [], [])] * len(texts)
            found = align_tokens([ids_a[i] for i in same], [ids_b[i] for i in same], voc_a, voc_b) if same else []
            for i, (groups, pairs, times, written) in zip(same, found):
                out[i] = (len(ids_a[i]), len(ids_b[i]), groups, hashlib.sha256(written.encode()).hexdigest(), pairs, times)
            return out

        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows = [(0, 0, 0, "", [], [])] * len(texts)
            some, size = [], 0
            for i, x in enumerate(texts):
                if x:
                    some.append(i)
                    size += len(x)
                if some and (size >= BATCH_BYTES or i + 1 == len(texts)):
                    for k, row in zip(some, links([texts[k] for k in some])):
                        rows[k] = row
                    some, size = [], 0
            n_a, n_b, groups, digests, pairs, times = zip(*rows) if rows else [()] * 6
            lists = [_lists(c) for c in (pairs, times)]
            numbers = [pa.array(c, pa.int64()) for c in (n_a, n_b, groups)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, pa.array(digests, pa.string()), *lists], names=schema.names)

    return packed.mapInArrow(encode, schema)


def pair_counts(links: DataFrame) -> DataFrame:
    """``pair, count, is_best`` over all texts; best is the highest count of the pair's second id, ties included."""
    each = links.select(F.inline(F.arrays_zip("pairs", "times")))
    counts = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count"))
    second = F.col("pair").bitwiseAND((1 << SECOND) - 1)
    counts = counts.withColumn("second", second)
    # A row per id of the second vocabulary at most.
    best = counts.groupBy(F.col("second").alias("_second")).agg(F.max("count").alias("_most"))
    return counts.join(best, F.col("second") == F.col("_second")).select("pair", "count", (F.col("count") == F.col("_most")).alias("is_best"))


def commonest(counts: DataFrame, most: int) -> int | None:
    """The least power of two that at most ``most`` pairs' counts reach; None if all pairs are as few."""
    sizes = counts.groupBy(F.floor(F.log2(F.col("count"))).cast("int").alias("bits")).count().collect()  # 64 rows at most
    if sum(r["count"] for r in sizes) <= most:
        return None
    return 1 << next(b for b in range(65) if sum(r["count"] for r in sizes if r["bits"] >= b) <= most)


def align(
    scratch: Scratch,
    docs: DataFrame,
    json_path: str,
    model_path: str,
    text: str = "text",
    keep_text: bool = True,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """``doc`` (the row as it was), ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``n_best``: links whose pair is the commonest of its second id.
    ``count_sum``: how often the links' pairs are linked anywhere, summed.
    """
    found = token_links(docs, text, json_path, model_path, keep_text).withColumn("row", F.monotonically_increasing_id())
    found = scratch.store(found, "links")
    counts = scratch.store(pair_counts(found), "counts")
    each = found.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")

    def sums(some: DataFrame) -> DataFrame:
        joined = each.join(some, "pair")
        best = F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("best")
        return joined.groupBy("row").agg(best, F.sum(F.col("times") * F.col("count")).alias("total"))

    least = commonest(counts, broadcast_pairs)
    if least is None:
        totals = sums(F.broadcast(counts))
    else:
        common, rare = counts.filter(F.col("count") >= least), counts.filter(F.col("count") < least)
        both = sums(F.broadcast(common)).unionByName(sums(rare.hint("merge")))
        totals = both.groupBy("row").agg(F.sum("best").alias("best"), F.sum("total").alias("total"))
    totals = scratch.store(totals.withColumnRenamed("row", "_row"), "totals")
    return found.join(totals, F.col("row") == F.col("_row"), "left").select(
        "doc",
        "n_a",
        "n_b",
        "n_groups",
        F.aggregate("times", F.lit(0).cast("long"), lambda total, x: total + x).alias("n_links"),
        F.coalesce("best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("total", F.lit(0)).cast("long").alias("count_sum"),
        "groups_sha256",
    )
