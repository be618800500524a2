"""Pack tokenized documents into sequences of a fixed capacity, best fit on counts.

A document is its token ids and one closing id. Only documents above the
capacity are cut, into pieces of the capacity; the first piece may be shorter.
What is planned is the histogram of piece lengths, at most ``capacity`` counts:
from the longest length down, pieces go to the open sequences with the least
room that still fits, as many at a time as there are sequences of that room, so
the plan grows with the capacity and not with the documents. Pieces then take
the planned places by joining on their rank within their length. The rank is
the place within a hashed share of the length's pieces and the pieces in the
shares before, so no task sees all pieces of a common length.

Null text is an empty text: the closing id alone. Null ids are ids like any
other here. Rows that repeat an id are packed each for itself. An empty table
gives an empty table. Extra columns are not read.
"""

from __future__ import annotations

import array
import bisect
import json
import re
import zlib
from collections.abc import Iterator
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from promptframe.scratch import Scratch

CAPACITY, CLOSING = 2048, 0
# Pieces in one share of a length, about.
SHARE_ROWS = 100_000


class Encoder:
    """Token ids of texts, as packed unsigned 32-bit numbers.

    The vocabulary and the special tokens are those of a byte-level BPE file of
    ``tokenizers``. Plain text is encoded by ``tiktoken`` with that vocabulary,
    which gives the same ids in a quarter of the time; a text that holds the
    string of a special token, or a run of white space that is too long for
    that library's pattern matcher, is encoded by ``tokenizers`` itself.
    With ``literal`` the strings of special tokens are plain text.
    """

    # Longer runs of white space may exhaust the stack of the quick pattern.
    LONG_BLANKS = re.compile(r"\s{10000}")

    # Fixed value: how byte-level BPE splits text before merging.
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, tokenizer_json: str, literal: bool = False):
        import tiktoken

        self.source, self.literal = tokenizer_json, literal
        spec = json.loads(tokenizer_json)
        self.special = [x["content"] for x in spec["added_tokens"]]
        # Printable Latin-1 stands for its own byte, the other bytes for 256 onwards.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [x for x in range(256) if x not in printable]
        byte_of = {chr(x): x for x in printable} | {chr(256 + k): x for k, x in enumerate(others)}
        vocabulary = ((token, rank) for token, rank in spec["model"]["vocab"].items() if token not in self.special)
        ranks = {bytes(byte_of[c] for c in token): rank for token, rank in vocabulary}
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self.plain = tiktoken.Encoding("plain", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(self.source)
        made.encode_special_tokens = self.literal
        return made

    def ids(self, text: str) -> list[int]:
        if (not self.literal and any(x in text for x in self.special)) or self.LONG_BLANKS.search(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.plain.encode_ordinary(text)

    def encode(self, text: str) -> bytes:
        return array.array("I", self.ids(text)).tobytes()


def cut(length: int, capacity: int) -> Iterator[tuple[int, int]]:
    """Start and length of the pieces; what the capacity does not divide comes first."""
    first = (length - 1) % capacity + 1
    yield 0, first
    for start in range(first, length, capacity):
        yield start, capacity


def pieces(docs: DataFrame, doc_id: str, text: str, tokenizer_path: str, capacity: int, with_ids: bool) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, on request, ``ids`` as little-endian bytes."""
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer_json = docs.sparkSession.sparkContext.broadcast(file.read())
    closing = array.array("I", [CLOSING]).tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    if with_ids:
        names, types, schema = [*names, "ids"], [*types, pa.binary()], schema + ", ids binary"

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_json.value)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            # Some rows at a time: their tokens are in memory at once.
            for at in range(0, len(ids), 256):
                rows = []
                for one, body in zip(ids[at : at + 256], texts[at : at + 256]):
                    packed = encoder.encode(body or "") + closing
                    for piece, (start, length) in enumerate(cut(len(packed) // 4, capacity)):
                        own = packed[4 * start : 4 * (start + length)]
                        rows.append((one, piece, start, length, zlib.crc32(own), own)[: len(names)])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(split, schema)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """``length, first rank, ranks, first sequence, offset`` of every planned run of places."""
    runs, sequences = [], 0
    rooms: list[int] = []  # the rooms with open sequences, ascending
    open_by_room: dict[int, list[tuple[int, int]]] = {}  # room: first sequence and count

    def reopen(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in open_by_room:
                bisect.insort(rooms, room)
                open_by_room[room] = []
            open_by_room[room].append((first, count))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, count = open_by_room[room].pop()
                if not open_by_room[room]:
                    rooms.pop(at)
                    del open_by_room[room]
                taken = min(left, count)
                reopen(room, first + taken, count - taken)
                runs.append((length, rank, taken, first, capacity - room))
                reopen(room - length, first, taken)
                rank, left = rank + taken, left - taken
                continue
            # No room: open as many sequences as hold all that is left, each filled with this length.
            fit = capacity // length
            full = left // fit
            for k in range(fit if full else 0):
                runs.append((length, rank, full, sequences, k * length))
                rank, left = rank + full, left - full
            reopen(capacity - fit * length, sequences, full)
            sequences += full
            for k in range(left):
                runs.append((length, rank + k, 1, sequences, k * length))
            if left:
                reopen(capacity - left * length, sequences, 1)
                sequences, left = sequences + 1, 0
    return runs


def pack(scratch: Scratch, found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``found`` (pieces, stored) with ``sequence_id`` and ``offset``."""
    histogram = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}
    shares = max(8, -(-sum(histogram.values()) // SHARE_ROWS))
    runs = found.sparkSession.createDataFrame(
        plan(histogram, capacity), "p_length long, p_rank long, p_ranks long, p_sequence long, p_offset long"
    )
    shared = found.withColumn("share", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shares)))
    counts = shared.groupBy("length", "share").count()
    earlier = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "share", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "share").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = shared.withColumn("within", F.row_number().over(within) - 1).join(before, ["length", "share"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("within"))
    place = (F.col("length") == F.col("p_length")) & F.col("rank").between(F.col("p_rank"), F.col("p_rank") + F.col("p_ranks") - 1)
    return ranked.join(F.broadcast(runs), place).select(
        *found.columns,
        (F.col("p_sequence") + F.col("rank") - F.col("p_rank")).alias("sequence_id"),
        F.col("p_offset").alias("offset"),
    )


def pack_documents(
    scratch: Scratch,
    docs: DataFrame,
    tokenizer_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece with its sequence and its place there."""
    found = scratch.store(pieces(docs, doc_id, text, tokenizer_path, capacity, with_ids), "pieces")
    return pack(scratch, found, capacity)
