"""Remove long byte strings that start more than once.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else, in the same or another document, is removed; overlaps count.

Dealing the work out: the smallest hashed ``ANCHOR``-gram in a window of
``length`` bytes, the leftmost one on ties, depends on the window's bytes alone,
so equal windows share their anchor and its place. The windows of a document
fall into runs with one anchor each, and a run's bytes are its fragment. Only
anchors that occur again matter. A fragment that occurs again as a whole, with
the same run of windows, is removed as a whole. What is left are groups of
different fragments with one anchor, where repeats begin and end.

In a group the repeated windows are found on the suffix array of its fragments:
breadth-first backward extension on the Burrows-Wheeler transform yields the
common prefixes of neighbouring suffixes by increasing length; an interval is
extended only if it bounds a suffix pair not seen before, and it stops at
``length``, so pairs never reached share at least that many bytes. Many small
groups go into one transform of about ``CHUNK`` bytes. Anchors with more than
``GROUP`` different fragments, as of a passage that a third of all documents
hold, would make one task's group too large, and no split by the bytes around the
anchor bounds it, as what differs may lie at the windows' ends. Their windows are
counted one by one by a 128-bit rolling hash, combined before the shuffle, with
the same result.

Null text is empty. Rows that repeat an id and text are documents that repeat
each other. Null ids are ids like any other. Texts shorter than ``length`` stay
whole. An empty table gives an empty table. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from promptframe.scratch import Scratch

LENGTH, ANCHOR = 200, 64
# Different fragments of a group that one task takes; bytes of one transform.
GROUP, CHUNK = 4096, 1 << 20
# Windows of a text that are hashed at once.
STEP = 1 << 15

_BASE, _BASE2 = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_WORD = 1 << 64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Rolling:
    """Hashes of all strings of one length in up to ``size`` bytes, by running sums."""

    def __init__(self, base: int, size: int):
        one = np.ones(1, np.uint64)
        self.size = size
        self.table = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(base)) | np.uint64(1)
        self.up = np.cumprod(np.concatenate([one, np.full(size, base, np.uint64)]), dtype=np.uint64)
        self.down = np.cumprod(np.concatenate([one, np.full(size, pow(base, -1, _WORD), np.uint64)]), dtype=np.uint64)

    def sums(self, part: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.table[part] * self.up[: len(part)], dtype=np.uint64)])

    def hashes(self, part: np.ndarray, k: int) -> np.ndarray:
        sums = self.sums(part)
        return _mixed((sums[k:] - sums[:-k]) * self.down[: len(part) - k + 1])

    def between(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the strings from ``start`` to ``end``."""
        return _mixed((sums[end] - sums[start]) * self.down[start])


def leftmost_least(hashes: np.ndarray, width: int) -> np.ndarray:
    """The place of the least of each ``width`` hashes side by side, by their upper 48 bits, the leftmost on ties.

    Least values of one, two, four ... hashes, each from two of the step before; places are in the lower bits.
    """
    least = (hashes & np.uint64(0xFFFF_FFFF_FFFF_0000)) | np.arange(len(hashes), dtype=np.uint64)
    known = 1
    while known < width:
        step = min(known, width - known)
        least = np.minimum(least[:-step], least[step:])
        known += step
    return (least & np.uint64(0xFFFF)).astype(np.int64)


class Windows:
    """Runs of windows with a common anchor."""

    def __init__(self, length: int, anchor: int):
        self.length, self.anchor = length, anchor
        self.rolling, self.content = Rolling(_BASE, STEP + length), Rolling(_BASE2, STEP + length)

    def runs(self, data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """First and last start of each run, its anchor's hash, and a hash of its fragment and the anchor's place in it."""
        k, length = self.anchor, self.length
        for at in range(0, len(data) - length + 1, STEP):
            part = np.frombuffer(data, np.uint8)[at : at + STEP + length - 1]
            hashes = self.rolling.hashes(part, k)
            place = leftmost_least(hashes, length - k + 1)
            first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            last = np.concatenate([first[1:], [len(place)]]) - 1
            form = ((place[first] - first) * (2 * length) + last - first).astype(np.uint64)
            whole = self.content.between(self.content.sums(part), first, last + length)
            yield first + at, last + at, hashes[place[first]].view(np.int64), _mixed(whole + form).view(np.int64)


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of ``symbols`` (below 512) in the order of their first ``depth`` symbols or more, by doubling."""
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(7, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(7):
        key = (key << 9) | padded[k : k + n]
    known = 7
    while True:
        # Ties share what was read so far, so their order does not matter.
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if known >= depth or rank[order[-1]] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[: max(0, n - known)] = rank[known:] + 1
        key = rank * (n + 1) + after
        known *= 2


def long_prefixes(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order, and for each place whether the suffix shares ``depth`` symbols with the one before it.

    Symbol 0 ends a fragment; strings may end with it but are not extended over it.
    """
    n = len(symbols)
    order = suffix_order(symbols, depth)
    transform = np.where(order > 0, symbols[order - 1], 0)
    by_symbol = np.argsort(transform.astype(np.uint16), kind="stable")
    back = np.empty(n, np.int64)  # the place of the suffix that is one symbol longer
    back[by_symbol] = np.arange(n)
    same = transform[by_symbol[1:]] == transform[by_symbol[:-1]]
    before, after = np.full(n, -1), np.full(n, n)  # the nearest places with the same symbol
    before[by_symbol[1:][same]] = by_symbol[:-1][same]
    after[by_symbol[:-1][same]] = by_symbol[1:][same]
    open_ = np.ones(n + 1, bool)  # the pair of places before and at the bound shares more than was seen so far
    open_[0] = open_[n] = False
    low, high = np.array([0]), np.array([n])
    for known in range(depth):
        size = high - low
        owner = np.repeat(np.arange(len(low)), size)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + low[owner]
        if known:
            some = transform[place] > 0
            owner, place = owner[some], place[some]
        # The longer strings' intervals are disjoint, so sorted firsts and lasts belong together.
        begin = np.sort(back[place[before[place] < low[owner]]])
        end = np.sort(back[place[after[place] >= high[owner]]]) + 1
        new = open_[end]
        low, high = begin[new], end[new]
        open_[high] = False
        if not len(low):
            break
    return order, open_[:n]


def repeated_starts(fragments: list[bytes], length: int) -> list[np.ndarray]:
    """For each fragment, which of its windows occur more than once in any of them."""
    ends = np.cumsum([len(x) + 1 for x in fragments])
    symbols = np.frombuffer(b"\0".join(fragments) + b"\0", np.uint8).astype(np.int64) + 1
    symbols[ends - 1] = 0
    order, shared = long_prefixes(symbols, length)
    again = np.zeros(len(symbols), bool)
    again[order] = shared | np.concatenate([shared[1:], [False]])
    begins = ends - [len(x) + 1 for x in fragments]
    return [again[b : b + len(x) - length + 1] for b, x in zip(begins.tolist(), fragments)]


def spans_of(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], starts.astype(np.int8), [0]])))
    return edges[::2], edges[1::2] - 1


def _doc(doc_id: str, text: str) -> Column:
    body = F.coalesce(F.col(text), F.lit(""))
    return F.struct(F.col(doc_id).cast("string").alias("id"), F.xxhash64(body).alias("text"))


def _packed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``own_id, doc, packed``: texts compressed for the shuffle."""
    plain = docs.select(F.col(doc_id).alias("own_id"), _doc(doc_id, text).alias("doc"), F.col(text).alias("body"))
    kind = plain.schema["own_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [packer.compress((x.as_py() or "").encode()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["own_id", "doc", "packed"])

    return plain.mapInArrow(pack, f"own_id {kind}, doc struct<id:string,text:bigint>, packed binary")


def fragments(docs: DataFrame, doc_id: str, text: str, length: int, anchor: int) -> DataFrame:
    """``doc, anchor, content, first, last`` of every run of windows."""
    plain = docs.select(_doc(doc_id, text).alias("doc"), F.col(text).alias("body")).filter(F.octet_length("body") >= length)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(length, anchor)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                owner, columns = [], [[], [], [], []]
                for row, one in enumerate(part.column(1)):
                    data = one.as_py().encode()
                    for first, last, hashes, content in windows.runs(data):
                        owner.append(np.full(len(first), row))
                        for column, values in zip(columns, (hashes, content, first, last)):
                            column.append(values)
                if owner:
                    docs_of = part.column(0).take(pa.array(np.concatenate(owner)))
                    found = [pa.array(np.concatenate(c)) for c in columns]
                    yield pa.RecordBatch.from_arrays([docs_of, *found], names=["doc", "anchor", "content", "first", "last"])

    return plain.mapInArrow(find, "doc struct<id:string,text:bigint>, anchor long, content long, first long, last long")


def _extracted(wanted: DataFrame, packed: DataFrame, length: int) -> DataFrame:
    """``wanted`` with the ``bytes`` of its fragments."""
    lists = wanted.groupBy(F.col("doc").alias("w_doc")).agg(F.collect_list(F.struct("anchor", "first", "last", "single", "many")).alias("wanted"))
    joined = packed.join(lists, F.col("doc") == F.col("w_doc")).select("doc", "packed", "wanted")
    names = ["doc", "anchor", "first", "last", "single", "many", "bytes"]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                lists = part.column(2)
                owner = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
                rows = lists.flatten()
                columns = [rows.field(k) for k in range(5)]
                data = [unpacker.decompress(x.as_py()) for x in part.column(1)]
                places = zip(owner.tolist(), columns[1].to_pylist(), columns[2].to_pylist())
                found = pa.array([data[o][a : b + length] for o, a, b in places], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)), *columns, found], names=names)

    kind = "doc struct<id:string,text:bigint>, anchor long, first long, last long, single boolean, many boolean, bytes binary"
    return joined.mapInArrow(extract, kind)


def _spans_by_transform(some: DataFrame, length: int) -> DataFrame:
    """``doc, start, end`` of the repeats within each anchor's fragments, which lie together in order of anchor."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(rows: list[tuple]) -> pa.RecordBatch:
            out = []
            for (doc, _, first, single, data), starts in zip(rows, repeated_starts([r[4] for r in rows], length)):
                if single:
                    for a, b in zip(*spans_of(starts)):
                        out.append((doc, first + int(a), first + int(b) + length))
            docs, starts, ends = zip(*out) if out else ((), (), ())
            kind = pa.struct([("id", pa.string()), ("text", pa.int64())])
            columns = [pa.array(docs, kind), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["doc", "start", "end"])

        rows, size, last = [], 0, None
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("doc", "anchor", "first", "single", "bytes")]):
                if size >= CHUNK and row[1] != last:
                    yield solved(rows)
                    rows, size = [], 0
                rows.append(row)
                size, last = size + len(row[4]), row[1]
        if rows:
            yield solved(rows)

    return some.mapInArrow(find, "doc struct<id:string,text:bigint>, start long, end long")


def _windows_of(fragments: list[bytes], length: int, rolling: list[Rolling]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of every window of the fragments, each of at least ``length`` bytes: the fragment, the place in it, two hashes."""
    owners, places, hashes, at = [], [], [[] for _ in rolling], 0
    while at < len(fragments):
        stop, size = at, 0
        while stop < len(fragments) and (stop == at or size + len(fragments[stop]) <= rolling[0].size):
            size += len(fragments[stop])
            stop += 1
        sizes = np.array([len(x) for x in fragments[at:stop]])
        owner = np.repeat(np.arange(at, stop), sizes)
        place = np.arange(size) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        whole = place + length <= np.repeat(sizes, sizes)
        owners.append(owner[whole])
        places.append(place[whole])
        data = np.frombuffer(b"".join(fragments[at:stop]), np.uint8)
        for found, one in zip(hashes, rolling):
            found.append(one.hashes(data, length)[whole[: size - length + 1]].view(np.int64))
        at = stop
    return np.concatenate(owners), np.concatenate(places), [np.concatenate(h) for h in hashes]


def _spans_by_count(scratch: Scratch, some: DataFrame, length: int) -> DataFrame:
    """The same by counting windows, for anchors with many fragments."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A fragment is less than two windows long.
        rolling = [Rolling(base, max(STEP, 2 * length)) for base in (_BASE, _BASE2)]
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                owner, place, keys = _windows_of(part.column("bytes").to_pylist(), length, rolling)
                start = part.column("first").to_numpy()[owner] + place
                taken = [part.column(c).take(pa.array(owner)) for c in ("doc", "single")]
                columns = [*taken, pa.array(start), *[pa.array(k) for k in keys]]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "single", "start", "h1", "h2"])

    each = some.mapInArrow(windows, "doc struct<id:string,text:bigint>, single boolean, start long, h1 long, h2 long")
    # Stored, as it is read twice, and so that a window with very many places can be split.
    each = scratch.store(each, "windows")
    again = scratch.store(each.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1").select("h1", "h2"), "windows_again")
    found = each.filter("single").join(again, ["h1", "h2"], "left_semi").select("doc", "start")
    # Starts that follow each other are one span.
    run = F.col("start") - F.dense_rank().over(Window.partitionBy("doc").orderBy("start"))
    spans = found.withColumn("run", run).groupBy("doc", "run").agg(F.min("start").alias("start"), F.max("start").alias("last"))
    return spans.select("doc", "start", (F.col("last") + length).alias("end"))


def repeated_spans(scratch: Scratch, docs: DataFrame, doc_id: str, text: str, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """``s_doc, spans``: places to remove, as ``start, end`` in any order and overlapping, by document that has any."""
    runs = scratch.store(fragments(docs, doc_id, text, length, anchor), "runs")
    # What enters a join by plain shuffles on both sides can be split where an anchor is common, so it is stored.
    shared = scratch.store(runs.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "shared")
    again = scratch.store(runs.join(shared, "anchor"), "again")
    scratch.drop("runs", "shared")
    scratch.settle()
    one = F.min(F.struct("doc", "first", "last"))
    different = scratch.store(again.groupBy("anchor", "content").agg(F.count("*").alias("n"), one.alias("one")), "different")
    groups = scratch.store(different.groupBy("anchor").agg(F.count("*").alias("size")).filter("size > 1"), "groups")
    wanted = different.join(groups, "anchor").select(
        "one.doc", "anchor", "one.first", "one.last", (F.col("n") == 1).alias("single"), (F.col("size") > GROUP).alias("many")
    )
    cut = scratch.store(_extracted(wanted, _packed(docs, doc_id, text), length), "cut")
    together = cut.filter("NOT many").repartition("anchor").sortWithinPartitions("anchor")
    parts = _spans_by_transform(together, length).unionByName(_spans_by_count(scratch, cut.filter("many"), length))
    whole = again.join(different.filter("n > 1").select("anchor", "content"), ["anchor", "content"], "left_semi")
    whole = whole.select("doc", F.col("first").alias("start"), (F.col("last") + length).alias("end"))
    spans = whole.unionByName(parts).groupBy("doc").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    spans = scratch.store(spans.select(F.col("doc").alias("s_doc"), "spans"), "spans")
    scratch.drop("again", "different", "groups", "cut", "windows", "windows_again")
    return spans


def remove_repeats(
    scratch: Scratch,
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    anchor: int = ANCHOR,
    with_kept: bool = True,
) -> DataFrame:
    """``own_id, n_bytes, n_removed, n_spans, kept_sha256`` and, on request, the ``kept`` bytes."""
    spans = repeated_spans(scratch, docs, doc_id, text, length, anchor)
    joined = _packed(docs, doc_id, text).join(spans, F.col("doc") == F.col("s_doc"), "left").select("own_id", "packed", "spans")
    names = ["own_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 6 if with_kept else 5]
    kind = f"own_id {joined.schema['own_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    types = [pa.int64()] * 3 + [pa.string(), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for packed, found in zip(part.column(1).to_pylist(), part.column(2)):
                    data = unpacker.decompress(packed)
                    kept, end, runs, removed = [], 0, 0, 0
                    for a, b in sorted((s["start"], s["end"]) for s in found.as_py() or []):
                        if a > end or not runs:
                            kept.append(data[end:a])
                            runs += 1
                            removed += b - a
                        elif b > end:
                            removed += b - end
                        end = max(end, b)
                    left = b"".join([*kept, data[end:]])
                    rows.append((len(data), removed, runs, hashlib.sha256(left).hexdigest(), left))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns[: len(names) - 1]], names=names)

    return joined.mapInArrow(cut, kind + (", kept binary" if with_kept else ""))
