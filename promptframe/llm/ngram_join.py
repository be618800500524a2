"""Documents whose sets of word n-grams overlap, and the groups they form.

Two documents link when ``100 * |A and B| >= percent * |A or B|`` for their sets
of distinct ``width``-word shingles (a shorter text is one shingle). Documents
with one set are one class, and classes are joined.

Candidates. Sets are dealt into bands by size. Sets that link and of which the
larger one is in a band differ in at most ``H`` elements, ``H`` from the band's
largest size. The universe of shingles is cut by hash into segments; the cost
of errors is shared out over them: a segment may count for one, then the two
sets must agree on it, or for two, then they may differ in one element, which
deleting any one element from either side finds. With ``H + 1`` counted in all,
some segment must match. How many segments count for two is what costs least
for the band: more of them mean fewer and larger segments, with fewer chance
matches, but a signature for every deletion. Bands without such segments have
some segments to spare, so that empty ones need not be looked at. A set is also indexed in the
bands above where a partner can be close enough.

Groups. Of the classes that share a signature, those whose sizes and parity
sketches allow a link are connected, by fewer rows than there are classes; a
sketch differs in at most as many bits as its set in elements, so no link is
lost, and classes that meet by chance stay apart. The connected classes are then
compared exactly, by products of 0/1 matrices over the shingles they share.
Signatures and groups above a size are cut into blocks, and each pair of blocks
is a task of its own. A task returns only links that connect something new in
it, which leaves the components as they are. Links between different texts are
thus never lost, and no pair list is made.

Null and empty texts, and texts without words, are linked with nothing. Rows
that repeat an id are documents of one id. A null id is no smallest id; a
component of null ids only has a null id. An empty table gives an empty table.
Extra columns pass through :func:`groups`, whatever their names. Whole texts are
read; shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptframe.llm.components import connected
from promptframe.llm.words import word_count
from promptframe.scratch import Scratch

WIDTH, PERCENT = 5, 80
# Classes of a group, and shingles of them, that one side of a task's comparison takes; classes of a signature likewise.
BLOCK, BLOCK_TOKENS, BUCKET = 512, 500_000, 2048
# Signatures are joined in so many shares, one after the other.
SHARES = 2
# What it costs to tell by their sketches that two sets met by chance, in signatures.
MEETING = 0.05
# 64-bit words of the longest sketches.
SKETCH_WORDS = 64
# A band's largest size is this many times its smallest.
BAND = 1.25
# Words whose hashes a task remembers.
REMEMBERED = 200_000
# Shingles of one product.
COLUMNS = 4096

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def shingles(text: str | None, hashes: WordHashes, width: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z, and the six blanks
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    one = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(words) - width + 1
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = _mixed(out + one[k : k + n] + _A)
    return np.unique(out)


def bound(low: int) -> int:
    return max(low + 1, int(low * BAND))


def bands(largest: int) -> list[tuple[int, int]]:
    """First and last size of every band up to ``largest``, and of the one after."""
    out, low = [], 1
    while low <= largest or len(out) < 2 or out[-1][0] <= largest:
        out.append((low, bound(low) - 1))
        low = bound(low)
    return out


def allocation(first: int, last: int, sets: int, percent: int) -> tuple[int, int, int]:
    """Segments of a band, how many of them count for two errors, and how many a set may leave empty.

    With ``spare`` more segments than errors need, more than ``spare`` segments
    agree. A set with no more than that many empty segments need not be found
    by them, so it has no signatures of nothing, which all sets would share.
    """
    errors = errors_of(2 * last, percent)
    held = first / (errors + 1)
    empty = (errors + 1) * math.exp(-held)
    spare = math.ceil(empty + 3 * math.sqrt(empty)) if errors else 0
    best, chosen = math.inf, None
    twos = 0
    while 2 * twos <= errors + 1:
        ones = errors + 1 - 2 * twos + (0 if twos else spare)
        held = first / (ones + twos)
        signatures = sets * (ones + twos * (1 + held))
        # Without segments for two errors, sets of which too many are empty are one in a thousand.
        met = ones * math.exp(-2 * held) * (1 if twos else 1e-3) + twos * ((1 + held) * math.exp(-held)) ** 2
        cost = signatures + MEETING * sets * sets / 2 * met
        if cost < best:
            best, chosen = cost, (ones + twos, twos, 0 if twos else spare)
        twos = twos * 2 or 1
    return chosen


def errors_of(sizes, percent: int):
    """In how many elements two sets of so many together may differ."""
    return sizes * (100 - percent) // (100 + percent)


def sketch_bits(last: int) -> int:
    """Bits of a band's sketches, enough to tell unlike sets of its sizes apart."""
    return 64 * min(SKETCH_WORDS, max(2, -(-last // 64)))


def sketch(tokens: np.ndarray, bits: int) -> bytes:
    """The parity of the elements on each bit. Sets differ in at least as many elements as their sketches in bits."""
    odd = np.bincount((_mixed(tokens ^ _B) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def parts(tokens: np.ndarray, limits: list[tuple[int, int]], plan: list[tuple[int, int, int]], percent: int) -> list[tuple[int, bytes, np.ndarray]]:
    """Band, sketch and signatures of a set, in its band and in those above where a partner can be close."""
    size = len(tokens)
    own = next(k for k, (_, last) in enumerate(limits) if size <= last)
    out = []
    for band in range(own, len(limits)):
        if band > own and 100 * size < percent * limits[band][0]:
            break
        segments, twos, spare = plan[band]
        place = (_mixed(tokens ^ _A) % np.uint64(segments)).astype(np.int64)
        value = _mixed(tokens + _C)
        order = np.argsort(place, kind="stable")
        place, value = place[order], value[order]
        filled = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        sums = np.zeros(segments, np.uint64)
        sums[place[filled]] = np.add.reduceat(value, filled)
        names = _mixed(np.arange(segments, dtype=np.uint64) + np.uint64(band << 32) + _B)
        found = [(sums + names)[place[filled]] if segments - len(filled) <= spare else sums + names]
        if twos:
            deleted = place < twos
            found.append(sums[place[deleted]] - value[deleted] + names[place[deleted]])
        out.append((band, sketch(tokens, sketch_bits(limits[band][1])), np.unique(_mixed(np.concatenate(found)))))
    return out


def _class_key(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, as two signed numbers."""
    whole = xxhash.xxh3_128_digest(tokens.tobytes())
    return tuple(np.frombuffer(whole, np.int64).tolist())


def _doc(doc_id: str, text: str) -> Column:
    return F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text"))


_PARTS = "array<struct<band:int,sketch:binary,signatures:array<bigint>>>"


def sized(docs: DataFrame, doc_id: str, text: str, width: int, percent: int) -> DataFrame:
    """``doc, size, c1, c2, parts`` of every row."""
    # How many sets a band may have, from word counts: a text has at most one shingle a word.
    band = F.floor(F.log(F.greatest(word_count(F.col(text)), F.lit(1))) / math.log(BAND)).cast("int")
    counts = {r["band"]: r["count"] for r in docs.groupBy(band.alias("band")).count().collect()}
    largest = int(BAND ** (max(counts, default=0) + 1)) + 1
    limits = bands(largest)
    at = [int(math.log(first) / math.log(BAND)) for first, _ in limits]
    plan = [allocation(first, last, max(1, counts.get(k, 0) + counts.get(k + 1, 0)), percent) for (first, last), k in zip(limits, at)]
    plain = docs.select(_doc(doc_id, text).alias("doc"), F.col(text).alias("body"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                sizes, keys, found, counts = [], [], [], []
                for one in part.column(1):
                    tokens = shingles(one.as_py(), hashes, width)
                    own = parts(tokens, limits, plan, percent) if len(tokens) else []
                    sizes.append(len(tokens))
                    keys.append(_class_key(tokens))
                    counts.append(len(own))
                    found += own
                numbers = [x[2].view(np.int64) for x in found]
                inner = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum([len(x) for x in numbers])]), pa.int32()),
                    pa.array(np.concatenate(numbers) if numbers else np.zeros(0, np.int64)),
                )
                fields = [pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.binary()), inner]
                each = pa.StructArray.from_arrays(fields, ["band", "sketch", "signatures"])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), each)
                c1, c2 = (pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), c1, c2, lists], names=["doc", "size", "c1", "c2", "parts"])

    kind = plain.schema["doc"].dataType.simpleString()
    return plain.mapInArrow(rows, f"doc {kind}, size long, c1 long, c2 long, parts {_PARTS}")


def alike(sketches: list[bytes], sizes: list[int], percent: int, left: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs whose sizes and sketches allow a link.

    Pairs are of one of the first ``left`` with one of the others, or, where
    ``left`` is all, of any two. Pairs that are connected already are not
    looked at, so a group of copies takes time in proportion to its size.
    """
    n = len(sketches)
    bits = np.frombuffer(b"".join(sketches), np.uint64).reshape(n, -1)
    size = np.array(sizes, np.int64)
    lead = np.arange(n)  # of the component; kept flat
    out = []
    for x in range(left if left < n else n - 1):
        later = np.arange(left if left < n else x + 1, n)
        later = later[lead[later] != lead[x]]
        if not len(later):
            continue
        a, b = np.minimum(size[later], size[x]), np.maximum(size[later], size[x])
        differ = np.bitwise_count(bits[later] ^ bits[x]).sum(axis=1, dtype=np.int64)
        for y in later[(100 * a >= percent * b) & (differ <= errors_of(a + b, percent))].tolist():
            if lead[x] != lead[y]:
                out.append((x, y))
                lead[lead == lead[y]] = lead[x]
    return out


def _tiled(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows with ``block`` of ``blocks`` of their group, once for every pair ``i, j`` of blocks they are in, side by side in tasks."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    kept = [c for c in df.columns if c not in ("block", "blocks")]
    tiles = df.select(*kept, "block", other).select(
        *kept,
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        (F.col("block") <= F.col("other")).alias("left"),
    )
    return tiles.repartition(*key, "i", "j").sortWithinPartitions(*key, "i", "j")


def _by_tile(solved, keys: list[str], columns: list[str]):
    """A step over batches of :func:`_tiled` rows that gives each tile's rows to ``solved(key, rows)``, which returns links."""
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, key, rows = [], None, []

        def batch_of(found):
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], schema=kind)

        for batch in batches:
            own = zip(*[batch.column(c).to_pylist() for c in keys])
            for now, row in zip(own, zip(*[batch.column(c).to_pylist() for c in columns])):
                if now != key:
                    if len(rows) > 1:
                        found += solved(key, rows)
                    key, rows = now, []
                rows.append(row)
            if found:
                yield batch_of(found)
                found = []
        if len(rows) > 1:
            found = solved(key, rows)
        if found:
            yield batch_of(found)

    return run


def candidates(scratch: Scratch, classes: DataFrame, percent: int) -> DataFrame:
    """``a, b``: a forest, for every signature, of the classes that share it and may link.

    Signatures are taken in ``SHARES`` hashed shares, one after the other, so
    that only one share's shuffles are on disk at a time.
    """
    found = [_candidates_of(scratch, classes, percent, share) for share in range(SHARES)]
    return reduce(DataFrame.unionByName, found)


def _candidates_of(scratch: Scratch, classes: DataFrame, percent: int, share: int) -> DataFrame:
    each = classes.select("node", F.inline("parts")).select("node", "band", F.explode("signatures").alias("s"))
    each = each.filter(F.pmod(F.xxhash64("s"), F.lit(SHARES)) == share)
    shared = each.groupBy("s").agg(F.count("*").alias("n")).filter("n > 1")
    # Stored, so that both sides of the join are plain shuffles and a common signature can be split.
    shared = scratch.store(shared, "shared")
    scratch.settle()
    members = scratch.store(each.join(shared, "s").select("s", "node", "band", "n"), "members")
    scratch.drop("shared")
    scratch.settle()
    sketches = classes.select("node", "size", F.inline("parts")).select("node", "band", "size", "sketch")
    blocks = F.ceil(F.col("n") / BUCKET).cast("int")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = members.join(sketches, ["node", "band"]).withColumn("blocks", blocks).withColumn("block", block)
    near = _tiled(rows.select("s", "node", "size", "sketch", "block", "blocks"), ["s"])

    def solved(key: tuple[int, int, int], rows: list[tuple[int, int, bytes, bool]]) -> list[tuple[int, int]]:
        if key[1] != key[2]:
            rows = sorted(rows, key=lambda r: not r[3])
        left = len(rows) if key[1] == key[2] else sum(r[3] for r in rows)
        if not left:
            return []
        return [(rows[x][0], rows[y][0]) for x, y in alike([r[2] for r in rows], [r[1] for r in rows], percent, left)]

    step = _by_tile(solved, ["s", "i", "j"], ["node", "size", "sketch", "left"])
    links = scratch.store(near.mapInArrow(step, "a long, b long").distinct(), f"links{share}")
    scratch.drop("members")
    scratch.settle()
    return links


def sets_of(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """``wanted`` (``node, doc, c1, c2, ...``) with the ``tokens`` of its classes, read again from one document each."""
    plain = docs.select(_doc(doc_id, text).alias("own"), F.col(text).alias("body"))
    kind = plain.schema["own"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [packer.compress((x.as_py() or "").encode()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["own", "packed"])

    packed = plain.mapInArrow(pack, f"own {kind}, packed binary")
    same = (F.col("own.text") == F.col("doc.text")) & F.col("own.id").eqNullSafe(F.col("doc.id"))
    joined = packed.join(wanted, same).select("node", "grp", "block", "blocks", "c1", "c2", "packed")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows, found = [], []
                for k, (node, c1, c2, data) in enumerate(zip(*[part.column(c).to_pylist() for c in ("node", "c1", "c2", "packed")])):
                    if node in seen:  # a row that is repeated
                        continue
                    tokens = shingles(unpacker.decompress(data).decode(), hashes, width)
                    if _class_key(tokens) == (c1, c2):
                        seen.add(node)
                        rows.append(k)
                        found.append(tokens.tobytes())
                kept = [part.column(c).take(pa.array(rows, pa.int64())) for c in ("node", "grp", "block", "blocks")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.binary())], names=["node", "grp", "block", "blocks", "tokens"])

    return joined.mapInArrow(read, "node long, grp long, block int, blocks int, tokens binary")


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections between two lists of sets."""
    both = [*left, *right]
    owner = np.repeat(np.arange(len(both)), [len(x) for x in both])
    names, number, times = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    shared = times[number] > 1  # a shingle of one set is in no intersection
    column = np.cumsum(times > 1) - 1
    owner, number = owner[shared], column[number[shared]]
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    total = int((times > 1).sum())
    for at in range(0, total, COLUMNS):
        a, b = np.searchsorted(number, [at, at + COLUMNS])
        grid = np.zeros((len(both), min(COLUMNS, total - at)), np.float32)
        grid[owner[a:b], number[a:b] - at] = 1
        out += grid[: len(left)] @ grid[len(left) :].T
    return np.rint(out).astype(np.int64)


def forest(pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those pairs that connect something new."""
    lead: dict[int, int] = {}

    def top(x: int) -> int:
        while lead.get(x, x) != x:
            lead[x] = lead.get(lead[x], lead[x])
            x = lead[x]
        return x

    out = []
    for a, b in pairs:
        x, y = top(a), top(b)
        if x != y:
            lead[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def links(sets: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of a spanning forest of the links in each task's pair of blocks."""

    def solved(key: tuple[int, int, int], rows: list[tuple[int, bool, bytes]]) -> list[tuple[int, int]]:
        one = key[1] == key[2]
        sides = [[r for r in rows if one or r[1] == side] for side in (True, False)]
        if not all(sides):
            return []
        left, right = ([np.frombuffer(r[2], np.uint64) for r in side] for side in sides)
        inside = common(left, right)
        a, b = (np.array([len(x) for x in side], np.int64) for side in (left, right))
        linked = 100 * inside >= percent * (a[:, None] + b - inside)
        ids = [[r[0] for r in side] for side in sides]
        pairs = ((ids[0][x], ids[1][y]) for x, y in zip(*(z.tolist() for z in np.nonzero(linked))) if not one or x < y)
        return forest(pairs)

    step = _by_tile(solved, ["grp", "i", "j"], ["node", "left", "tokens"])
    return _tiled(sets, ["grp"]).mapInArrow(step, "a long, b long")


def memberships(scratch: Scratch, docs: DataFrame, doc_id: str, text: str, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc`` (``none, id``, and the hash of the text), ``size``, ``component`` and ``component_id`` of every row.

    ``component`` names the group; groups of one id, which several rows hold, have one ``component_id``.
    """
    rows = scratch.store(sized(docs, doc_id, text, width, percent), "rows")
    one = rows.filter("size > 0").groupBy("c1", "c2").agg(F.min("doc").alias("doc"), F.first("size").alias("size"), F.first("parts").alias("parts"))
    classes = scratch.store(one.withColumn("node", F.monotonically_increasing_id()), "classes")
    rows_slim = scratch.store(rows.select("doc", "size", "c1", "c2"), "slim")
    scratch.drop("rows")
    scratch.settle()
    near = connected(scratch, candidates(scratch, classes, percent), "near")
    near = near.select("node", F.col("component").alias("grp"))
    # From here on classes are named only; signatures and sketches can go.
    slim = scratch.store(classes.select("node", "doc", "c1", "c2", "size"), "named")
    scratch.drop("classes", *[f"links{share}" for share in range(SHARES)])
    scratch.settle()
    classes = slim
    grouped = scratch.store(near.join(classes.select("node", "size"), "node"), "grouped")
    sizes = scratch.store(grouped.groupBy(F.col("grp").alias("g")).agg(F.count("*").alias("n"), F.sum("size").alias("all")), "sizes")
    # A block has so many classes, and so many shingles, at most about.
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("all") / BLOCK_TOKENS)).cast("int")
    place = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = grouped.join(sizes, F.col("grp") == F.col("g")).withColumn("blocks", blocks).select("node", "grp", place.alias("block"), "blocks")
    wanted = classes.select("node", "doc", "c1", "c2").join(dealt, "node")
    sets = scratch.store(sets_of(docs, wanted, doc_id, text, width), "sets")
    scratch.settle()
    joined = connected(scratch, links(sets, percent), "joined")
    of_class = classes.select("node", "c1", "c2", F.col("doc.id").alias("id")).join(joined, "node", "left")
    component = F.coalesce("component", "node")
    of_class = of_class.select("c1", "c2", "id", component.alias("component"))
    smallest = of_class.groupBy("component").agg(F.min("id").alias("component_id"))
    known = of_class.join(smallest, "component").select(F.col("c1").alias("k1"), F.col("c2").alias("k2"), "component", "component_id")
    known = scratch.store(known, "known")
    same = (F.col("c1") == F.col("k1")) & (F.col("c2") == F.col("k2")) & (F.col("size") > 0)
    scratch.drop("sets", "named", "grouped", "sizes")
    scratch.settle()
    own = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc.id"))
    return rows_slim.join(known, same, "left").select("doc", "size", "component", own.alias("component_id"))


def representatives(scratch: Scratch, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id; the columns of ``docs``.

    Documents without words stay. Of rows that repeat an id within a group the one with the
    smallest hash of its text stays, and of equal rows one.
    """
    found = memberships(scratch, docs, doc_id, text, width, percent)
    first = found.filter("size > 0").groupBy("component").agg(F.min("doc").alias("doc")).select("doc")
    times = found.groupBy("doc").agg(F.count("*").alias("k_times"))
    chosen = first.unionByName(found.filter("size = 0").select("doc")).distinct()
    kept = scratch.store(chosen.join(times, "doc"), "kept")
    scratch.settle()
    k = kept.select(F.col("doc.none").alias("k_none"), F.col("doc.id").alias("k_id"), F.col("doc.text").alias("k_text"), "k_times")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _doc(doc_id, text).alias("own"))
    same = (F.col("own.none") == F.col("k_none")) & F.col("own.id").eqNullSafe(F.col("k_id")) & (F.col("own.text") == F.col("k_text"))
    stay = whole.join(k, same)
    # Only rows that repeat move once more.
    alone, repeated = stay.filter("k_times = 1"), stay.filter("k_times > 1").dropDuplicates(["own"])
    return alone.select("row.*").unionByName(repeated.select("row.*"))
