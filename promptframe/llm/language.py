"""Language of a text by cross-parsing.

A text is parsed from left to right into the longest phrases that occur in a
language's training text; the suffix automaton of the training text finds the
end of each phrase in one step a byte. The fewer phrases, normalised by the
logarithm of the training size (what it costs to name one phrase), the closer
the text is to the language; the language with the least cost wins.

Training reads whole texts of a sample of labelled rows. Rows that agree in id and
text are one; in the order of a hash of both, after the texts above ``LONG_TEXT``
bytes, a language takes up to ``SAMPLE_ROWS`` rows, and no further row once it has
``SAMPLE_BYTES`` of text; the last row is taken whole. Where the tables of all
languages would exceed ``MODEL_BYTES``, each language leaves out last rows. Only a
language whose first row alone is too long for its share learns from that row's
beginning. The automaton of a language has at most twice as many states as its
sample has bytes and travels as one table of transitions.

Prediction reads whole texts. Long ones are parsed in segments of ``SEGMENT``
bytes side by side, each as if a phrase began there, with the places noted at which
phrases begin. The parse of the whole text then enters each segment where its last
phrase ends and goes on phrase by phrase until it meets a noted place, from where
both are the same; so phrases are those of the plain parse.

Case is ignored, and all that is no letter counts as one space. Texts that are
null or without a letter are ``und`` with score 0, as are all texts where there
is nothing to learn from. Equal costs go to the first language by name. Null
ids pass through; a null id counts as empty text for the fold. Rows that repeat
an id are predicted each for itself. An empty table gives an empty table. Extra
columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from promptframe.llm.words import beside

# A language's sample, and the tables of all of them together.
SAMPLE_ROWS, SAMPLE_BYTES, LONG_TEXT = 120, 1 << 16, 1 << 15
MODEL_BYTES = 256 << 20
SEGMENT = 2048
# Bytes of text that are parsed side by side.
BATCH_BYTES = 4 << 20
UNKNOWN = "und"

_KEPT = bytes(x if x >= 128 or chr(x).isalpha() else 32 for x in range(256))


def normalise(text: str) -> bytes:
    return b" ".join(text.lower().encode().translate(_KEPT).split())


class Automaton:
    """The suffix automaton of a text, as a table of steps.

    ``steps[state * symbols + symbol]`` is the next state, or ``~state`` where
    the phrase ends before the symbol and the next one has begun with it.
    """

    def __init__(self, text: bytes, symbol_of: np.ndarray, symbols: int):
        link, length, moves = [-1], [0], [{}]
        last = 0
        for byte in text:
            new = len(moves)
            moves.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and byte not in moves[at]:
                moves[at][byte] = new
                at = link[at]
            if at >= 0:
                to = moves[at][byte]
                if length[at] + 1 == length[to]:
                    link[new] = to
                else:
                    # A state of its own for the shorter strings that end here.
                    short = len(moves)
                    moves.append(dict(moves[to]))
                    length.append(length[at] + 1)
                    link.append(link[to])
                    while at >= 0 and moves[at].get(byte) == to:
                        moves[at][byte] = short
                        at = link[at]
                    link[to] = link[new] = short
            last = new
        first = np.zeros(symbols, np.int32)
        for byte, to in moves[0].items():
            first[symbol_of[byte]] = to
        steps = np.tile(~first, (len(moves), 1))
        for state, found in enumerate(moves):
            for byte, to in found.items():
                steps[state, symbol_of[byte]] = to
        self.steps = steps.reshape(-1)
        self.cost = float(np.log2(len(text) + 2))


class Model:
    """Automata by language, over the bytes that occur in any training text; symbol 0 is every other byte."""

    def __init__(self, texts: dict[str, bytes]):
        self.names = sorted(texts)
        used = sorted(set(b"".join(texts.values())))
        self.symbol_of = np.zeros(256, np.int32)
        self.symbol_of[used] = np.arange(1, len(used) + 1)
        self.symbols = len(used) + 1
        automata = [Automaton(texts[x], self.symbol_of, self.symbols) for x in self.names]
        self.steps, self.costs = [x.steps for x in automata], np.array([x.cost for x in automata])

    def state(self) -> dict:
        """Plain arrays, which travel without this class."""
        return {k: getattr(self, k) for k in ("names", "symbol_of", "symbols", "steps", "costs")}

    @classmethod
    def of(cls, state: dict) -> Model:
        out = cls.__new__(cls)
        out.__dict__.update(state)
        return out

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each text by language."""
        lengths = np.array([len(x) for x in texts], np.int64)
        segments = -(-lengths // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), segments)
        out = np.zeros((len(texts), len(self.names)), np.int64)
        if not len(owner):
            return out
        first = np.cumsum(lengths) - lengths
        place = np.arange(len(owner)) - np.repeat(np.cumsum(segments) - segments, segments)
        begin = first[owner] + place * SEGMENT
        size = np.minimum(SEGMENT, lengths[owner] - place * SEGMENT)
        order = np.argsort(-size, kind="stable")  # lanes that end early are at the end
        begin, size = begin[order], size[order]
        data = self.symbol_of[np.frombuffer(b"".join(texts), np.uint8)]
        lanes = np.searchsorted(-size, -np.arange(size[0]), side="left")
        states = [np.zeros(len(owner), np.int32) for _ in self.steps]
        begins = [np.zeros(len(data), bool) for _ in self.steps]
        for t in range(int(size[0])):
            n = lanes[t]
            at = begin[:n] + t
            symbol = data[at]
            for steps, state, noted in zip(self.steps, states, begins):
                step = steps.take(state[:n].astype(np.int64) * self.symbols + symbol)
                over = step >> 31  # -1 where a phrase ended
                noted[at] = over
                np.bitwise_xor(step, over, out=state[:n])
        for noted in begins:
            noted[begin] = True
        for k, (steps, noted) in enumerate(zip(self.steps, begins)):
            upto = np.concatenate([[0], np.cumsum(noted)])
            out[:, k] = upto[first + lengths] - upto[first]
            for text in np.flatnonzero(segments > 1).tolist():
                out[text, k] = self._joined(steps, data, noted, int(first[text]), int(first[text] + lengths[text]))
        return out

    def _joined(self, steps: np.ndarray, data: np.ndarray, noted: np.ndarray, start: int, stop: int) -> int:
        """Phrases of the text in ``data[start:stop]``, from where its segments' phrases begin."""
        total, at = 0, start
        for low in range(start, stop, SEGMENT):
            high = min(low + SEGMENT, stop)
            while at < high and not noted[at]:
                total, at = total + 1, self._phrase_end(steps, data, at, stop)
            if at < high:
                met = np.flatnonzero(noted[at:high])
                total += len(met)
                at = self._phrase_end(steps, data, at + int(met[-1]), stop)
        return total

    def _phrase_end(self, steps: np.ndarray, data: np.ndarray, at: int, stop: int) -> int:
        state = max(0, int(steps[data[at]]))
        at += 1
        while at < stop:
            state = int(steps[state * self.symbols + data[at]])
            if state < 0:
                break
            at += 1
        return at

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = [(UNKNOWN, 0.0)] * len(texts)
        at = [i for i, x in enumerate(texts) if x and self.names and any(map(str.isalpha, x))]
        begin = 0
        while begin < len(at):
            some, chosen, total = [], [], 0
            while begin < len(at) and (not some or total < BATCH_BYTES):
                some.append(normalise(texts[at[begin]]))
                chosen.append(at[begin])
                total += len(some[-1])
                begin += 1
            cost = self.phrases(some) * self.costs
            best = cost.argmin(axis=1)
            least = np.sort(cost, axis=1)
            for i, row, name, low in zip(chosen, least, best, least[:, 0]):
                margin = 1.0 - low / row[1] if len(row) > 1 and row[1] else 1.0
                out[i] = (self.names[name], float(margin))
        return out


def within(texts: dict[str, list[bytes]], most: int) -> dict[str, bytes]:
    """Training texts whose tables have at most ``most`` bytes: last rows are left out, of the first only what is too long."""
    symbols = len(set(b"".join(chain(*texts.values())))) + 2
    share = max(1, most // (8 * symbols * max(1, len(texts))))
    out = {}
    for name, rows in texts.items():
        sizes = np.cumsum([len(x) + 1 for x in rows])
        out[name] = b" ".join(rows[: max(1, int(np.searchsorted(sizes, share, side="right")))])[:share]
    return out


def learn(docs: DataFrame, allowed: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model from the labelled rows for which ``allowed`` holds."""
    some = docs.filter(allowed & F.col(lang).isNotNull() & F.col(text).isNotNull())
    key = F.xxhash64(F.col(doc_id).cast("string"), F.col(text)).alias("hash")
    size = F.octet_length(F.col(text)).cast("long")
    rows = some.select(F.col(lang).cast("string").alias("lang"), key, size.alias("size")).distinct()
    order = Window.partitionBy("lang").orderBy(F.col("size") > LONG_TEXT, "hash", "size")
    sample = rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= SAMPLE_ROWS)
    before = F.coalesce(F.sum("size").over(Window.partitionBy("lang").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sample = sample.withColumn("before", before).filter(F.col("before") < SAMPLE_BYTES)
    # At most SAMPLE_ROWS rows a language, with hashes in place of texts.
    wanted = F.broadcast(sample.select(F.col("lang").alias("s_lang"), F.col("hash").alias("s_hash"), "place"))
    texts = some.select(F.col(lang).cast("string").alias("lang"), key, F.col(text).alias("body"))
    found = texts.join(wanted, (F.col("lang") == F.col("s_lang")) & (F.col("hash") == F.col("s_hash"))).dropDuplicates(["lang", "place"])
    by_lang: dict[str, list[bytes]] = {}
    for row in found.select("lang", "place", "body").orderBy("lang", "place").toLocalIterator():
        own = normalise(row["body"])
        if own:
            by_lang.setdefault(row["lang"], []).append(own)
    return Model(within(by_lang, MODEL_BYTES))


def identify(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``doc`` (the row as it was), ``lang_pred`` and ``score``, the margin to the second language."""
    kept = [c for c in docs.columns if keep_text or c != text]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), F.col(text).alias("body"))
    shared = docs.sparkSession.sparkContext.broadcast(model.state())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.of(shared.value)
        for batch in batches:
            found = model.predict(batch.column(1).to_pylist())
            columns = [batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "lang_pred", "score"])

    return packed.mapInArrow(rows, beside(packed, "doc", lang_pred="string", score="double"))
