"""Quality by the votes of the nearest labelled documents in a latent-semantic space.

A text is a bag of terms: each word, hashed; the shape of each word (runs of
capitals, small letters, digits and other signs); and counts of words that
repeat the word before or an earlier word. Bags are weighted by the square root
of their relative frequency and by how rare a term is, and are projected on the
leading singular directions of a labelled sample.

The sample is bounded: at most ``SAMPLE_ROWS`` documents of each label, in the
order of a hash of the id and text, each id, label and text once. Its vectors, ``2 * SAMPLE_ROWS * DIMENSIONS`` numbers
at most, are broadcast with the projection. Every text, read whole, gets its
exact cosine with every labelled vector, a block of texts at a time; the labels
of the ``NEIGHBOURS`` nearest vote with the cosine's power ``SHARPNESS`` as
weight.

Null and empty texts, and texts with no term known to the sample, score the
share of label 1 among the labelled rows (0.5 where there are none). A null
label is no label; an id with both labels counts once for each. Null ids pass
through. Rows that repeat an id are scored each for itself. An empty table gives
an empty table. Extra columns pass through, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from promptframe.llm.words import beside

SAMPLE_ROWS, DIMENSIONS, NEIGHBOURS, SHARPNESS = 1500, 48, 25, 8
WORD_TERMS, SHAPE_TERMS = 2048, 512
TERMS = WORD_TERMS + SHAPE_TERMS + 2
BLOCK = 256
# Words whose terms a task remembers.
REMEMBERED = 500_000

_SHAPE = bytes(
    ord("A") if 65 <= x <= 90 else ord("a") if 97 <= x <= 122 or x >= 128 else ord("0") if 48 <= x <= 57 else x for x in range(256)
)


class Terms(dict):
    """The word term and the shape term of a word, as one number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        shape = bytearray()
        for byte in word.translate(_SHAPE):
            if not shape or shape[-1] != byte:
                shape.append(byte)
        plain = zlib.crc32(word.lower()) % WORD_TERMS
        found = self[word] = plain * SHAPE_TERMS + zlib.crc32(bytes(shape)) % SHAPE_TERMS
        return found


def bag(text: str | None, terms: Terms) -> np.ndarray | None:
    """The weight of every term before rarity; null for texts without words."""
    words = (text or "").encode().split()
    if not words:
        return None
    codes = np.fromiter(map(terms.__getitem__, words), np.int64, len(words))
    out = np.zeros(TERMS, np.float32)
    out[:WORD_TERMS] = np.bincount(codes // SHAPE_TERMS, minlength=WORD_TERMS)
    out[WORD_TERMS : WORD_TERMS + SHAPE_TERMS] = np.bincount(codes % SHAPE_TERMS, minlength=SHAPE_TERMS)
    out[-2] = sum(map(bytes.__eq__, words[1:], words))
    out[-1] = len(words) - len(set(words))
    return np.sqrt(out / len(words))


def bags(texts: list[str | None], terms: Terms) -> np.ndarray:
    return np.stack([np.zeros(TERMS, np.float32) if x is None else x for x in (bag(t, terms) for t in texts)])


def units(x: np.ndarray) -> np.ndarray:
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


class Model:
    def __init__(self, sample: np.ndarray, labels: np.ndarray, prior: float):
        self.prior, self.labels = prior, labels.astype(np.float32)
        self.projection = self.vectors = None
        if not len(sample):
            return
        seen = (sample > 0).sum(axis=0)
        rarity = np.where(seen > 0, np.log((1 + len(sample)) / (1 + seen)) + 1, 0).astype(np.float32)
        weighted = units(sample * rarity)
        # Leading directions by repeated multiplication of a fixed random start.
        start = np.random.default_rng(7).standard_normal((TERMS, DIMENSIONS + 16)).astype(np.float32)
        for _ in range(6):
            start = np.linalg.qr(weighted.T @ (weighted @ start))[0]
        right = np.linalg.svd(weighted @ start, full_matrices=False)[2]
        self.projection = (rarity[:, None] * (start @ right.T[:, :DIMENSIONS])).astype(np.float32)
        self.vectors = units(sample @ self.projection)

    def state(self) -> dict:
        """Plain arrays, which travel without this class."""
        return dict(self.__dict__)

    @classmethod
    def of(cls, state: dict) -> Model:
        out = cls.__new__(cls)
        out.__dict__.update(state)
        return out

    def scores(self, found: np.ndarray) -> np.ndarray:
        """The score of each bag."""
        out = np.full(len(found), self.prior)
        if not len(self.labels):
            return out
        latent = units(found @ self.projection)
        near = latent @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, best, axis=1), 0).astype(float) ** SHARPNESS
        total = weight.sum(axis=1)
        known = total > 0
        out[known] = (weight * self.labels[best]).sum(axis=1)[known] / total[known]
        return np.clip(out, 0.0, 1.0)


def learn(docs: DataFrame, labels: DataFrame, allowed: Column, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """A model from the labelled rows for which ``allowed``, a condition on the id, holds."""
    known = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1) & allowed)
    known = known.select(F.col(doc_id).alias("l_id"), F.col(label).cast("int").alias("label"))
    share = known.agg(F.avg("label")).first()[0]
    order = F.xxhash64(F.col("id").cast("string"), "body")
    named = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"))
    rows = named.filter("body IS NOT NULL").select("id", order.alias("hash")).join(known, F.col("id") == F.col("l_id"))
    # A row that is there many times has one place, and one vote.
    rows = rows.select("l_id", "label", "hash").dropDuplicates()
    place = F.row_number().over(Window.partitionBy("label").orderBy("hash", "l_id"))
    chosen = (
        rows.withColumn("place", place)
        .filter(F.col("place") <= SAMPLE_ROWS)
        .select(F.col("l_id").alias("c_id"), F.col("label").alias("c_label"), F.col("hash").alias("c_hash"))
    )
    # Only names are sorted; the texts of the chosen, of a bounded number, are then read.
    sample = named.join(F.broadcast(chosen), (F.col("id") == F.col("c_id")) & (order == F.col("c_hash")))
    sample = sample.dropDuplicates(["c_id", "c_label", "c_hash"])

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            found = bags(batch.column(2).to_pylist(), terms)
            packed = pa.array([x.astype(np.float16).tobytes() for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], names=["label", "hash", "bag"])

    found = sample.select("c_label", "c_hash", "body").mapInArrow(rows_of, "label int, hash long, bag binary").collect()
    found.sort(key=lambda r: (r["hash"], r["label"]))
    matrix = np.stack([np.frombuffer(r["bag"], np.float16).astype(np.float32) for r in found]) if found else np.zeros((0, TERMS), np.float32)
    return Model(matrix, np.array([r["label"] for r in found]), 0.5 if share is None else float(share))


def score(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``doc`` (the row as it was) and ``score``."""
    kept = [c for c in docs.columns if keep_text or c != text]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), F.col(text).alias("body"))
    shared = docs.sparkSession.sparkContext.broadcast(model.state())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, model = Terms(), Model.of(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                found = model.scores(bags(part.column(1).to_pylist(), terms))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.float64())], names=["doc", "score"])

    return packed.mapInArrow(rows, beside(packed, "doc", score="double"))
