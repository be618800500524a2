"""Operators that compare documents or vectors, and learned ones."""

import random
from collections import Counter

import numpy as np
import pytest
from llm import frames
from pyspark.sql import functions as F

from promptframe.llm import language, neighbours, ngram_join, quality_knn
from promptframe.llm.components import connected
from promptframe.llm.queries import QUERIES, table
from promptframe.llm.words import held_out
from promptframe.scratch import Scratch

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def scratch(spark):
    return Scratch(spark, "test")


# Language


def phrases(text: bytes, training: bytes) -> int:
    """Greedy phrases by looking every one up."""
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in training:
            end += 1
        count, at = count + 1, end
    return count


def test_phrases_are_longest_matches():
    rnd = random.Random(4)
    for _ in range(40):
        training = {name: "".join(rnd.choice(letters) for _ in range(120)).encode() for name, letters in (("x", "aab c"), ("y", "abcd"))}
        model = language.Model(training)
        some = ["".join(rnd.choice(rnd.choice(["abc", "abcde "])) for _ in range(rnd.randint(1, 200))).encode() for _ in range(5)]
        got = model.phrases(some)
        # Its one difference: a byte that no phrase can begin with only ends the phrase before it.
        for text, row in zip(some, got):
            for name, n in zip(model.names, row):
                want = phrases(text, training[name])
                known = set(training[name])
                strange = sum(b not in known for b in text)
                assert n == want if not strange else want - strange <= n <= want + strange + 1


def test_long_texts_are_read_whole():
    model = language.Model({"en": b"the cat sat on the mat and the dog ran", "xx": b"zyx wvu tsr qpo nml kji"})
    long = "zyx " * 50 + "the cat sat on the mat " * 400
    assert model.predict([long])[0][0] == "en"
    assert model.predict(["zyx wvu " * 900 + "the cat"])[0][0] == "xx"
    assert model.predict([None, "", "123 !", "the cat"]) == [("und", 0.0)] * 3 + [model.predict(["the cat"])[0]]
    assert language.Model({}).predict(["abc"]) == [("und", 0.0)]


def test_phrases_of_long_texts_are_those_of_the_plain_parse():
    rnd = random.Random(9)
    training = {"x": "".join(rnd.choice("abc ") for _ in range(300)).encode(), "y": ("abc" * 900 + "cab ").encode()}
    model = language.Model(training)
    size = language.SEGMENT
    some = ["".join(rnd.choice("abc ") for _ in range(n)) for n in (1, size - 1, size, size + 1, 10_000, 5 * size + 7)]
    # Phrases longer than a segment, and parses that meet late.
    some += ["abc" * 4000, "ab" + "abc" * 3000 + "b" + "cab" * 2500, "a" * 9000, "abcab" * 2000]
    some = [x.encode() for x in some]
    got = model.phrases(some)
    for text, row in zip(some, got):
        assert row.tolist() == [phrases(text, training[name]) for name in model.names]
    assert model.phrases(some[::-1]).tolist() == got[::-1].tolist()


def test_language_sample_holds_whole_different_texts(spark):
    rows = [(1, "uno dos tres cuatro " * 30, "es", "a")] * 3000 + [(i, f"der die das {i} und nicht " * 5, "de", "a") for i in range(2, 90)]
    rows += [(i, f"el perro y la casa {i} " * 4, "es", "a") for i in range(90, 150)] + [(200, "le la les " * 20_000, "fr", "a")]
    model = language.learn(frames.docs(spark, rows), F.lit(True))
    assert model.names == ["de", "es", "fr"]
    assert model.predict(["el perro y la casa", "der die das und nicht", "le la les", "² ½ ① 12"])[3] == ("und", 0.0)
    assert [x[0] for x in model.predict(["el perro y la casa", "der die das und nicht", "le la les"])] == ["es", "de", "fr"]


def test_training_texts_are_bounded_by_rows():
    texts = {"a": [b"x" * 40, b"y" * 40, b"z" * 40], "b": [b"q" * 1000, b"r"]}
    assert language.within(texts, 1 << 20) == {"a": b" ".join(texts["a"]), "b": b" ".join(texts["b"])}
    few = language.within(texts, 8 * 7 * 2 * 100)
    assert few == {"a": b" ".join(texts["a"][:2]), "b": b"q" * 100}


def test_language_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in table(spark, MEDIUM, "documents").collect()}
    found = QUERIES["op1_cross_parsing"](spark, MEDIUM).collect()
    assert len(found) == len(truth) and all(0 <= r["score"] <= 1 for r in found)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in found if r["held_out"]]) >= 0.98


def test_language_odd_rows(spark):
    docs = frames.docs(spark)
    model = language.learn(docs, ~held_out(F.col("doc_id")))
    found = language.identify(docs, model)
    assert found.select("doc.*").columns == docs.columns
    by_text = {r["doc"]["text"]: r["lang_pred"] for r in found.collect()}
    assert by_text[None] == by_text[""] == "und" and by_text[frames.PROSE] == "en"
    empty = frames.docs(spark, [])
    assert language.identify(empty, language.learn(empty, F.lit(True))).count() == 0


# Vectors


def nearest(rows, k):
    """``query, rank, id, cosine`` by comparing all."""
    kept = {}
    for i, v in rows:
        ok = v is not None and len(v) and None not in v and np.isfinite(v).all() and any(v)
        if ok and i is not None and (i not in kept or v < kept[i]):
            kept[i] = v
    out = []
    for q, v in kept.items():
        if q % 50 == 0:
            a = np.array(v, float)
            near = [(-float(a @ np.array(w)) / float(np.sqrt((a @ a) * (np.array(w) @ np.array(w)))), i) for i, w in kept.items() if i != q and len(w) == len(v)]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted((round(s, 9), i) for s, i in near)[:k], 1)]
    return sorted(out)


def found_nearest(spark, rows, k=5):
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, v string, id int")
    found = neighbours.nearest(scratch(spark), frame, F.col("id") % 50 == 0, k).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in found)


@pytest.mark.parametrize("tiles", [False, True])
def test_neighbours(spark, monkeypatch, tiles):
    if tiles:
        monkeypatch.setattr(neighbours, "QUERY_ROWS", 2)
        monkeypatch.setattr(neighbours, "CANDIDATE_ROWS", 60)
        monkeypatch.setattr(neighbours, "STRIP", 16)
    rnd = np.random.default_rng(1)
    rows = [(i, rnd.standard_normal(9).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[50][1]) for i in range(40)]  # many copies of a query
    rows += [(1050, rows[50][1]), (7, rows[7][1]), (8, [0.0] * 9), (2000, [1.0, 2.0]), (2001, [2.0, 4.0]), (2050, [-1.0, 0.5])]
    rows += [(None, [1.0] * 9), (3000, None), (3001, []), (3050, [0.0] * 9), (3051, [1.0, None]), (3100, [float("nan")] * 9)]
    assert found_nearest(spark, rows) == nearest(rows, 5)


def test_neighbours_few_and_none(spark):
    assert found_nearest(spark, [(0, [1.0, 0.0]), (1, [0.0, 2.0])]) == [(0, 1, 1, 0.0)]
    assert found_nearest(spark, [(0, [1.0, 0.0])]) == [] == found_nearest(spark, [])


def test_rounding_bounds_hold():
    rnd = np.random.default_rng(2)
    x, y = rnd.standard_normal((40, 7)) ** 3, rnd.standard_normal((60, 7))
    (a, s, e), (b, t, f) = neighbours.rounded(x), neighbours.rounded(y)
    near = (a.astype(float) @ b.T) * (s[:, None] * t)
    exact = np.array([[neighbours.cosines(p[None], q[None])[0] for q in y] for p in x])
    assert (np.abs(near - exact) <= f + e[:, None] * (1 + f) + 1e-9).all()
    tiny = neighbours.cosines(np.array([[3e-200, 4e-200]]), np.array([[3e180, 4e180]]))
    assert tiny[0] == pytest.approx(1.0)


# Learned quality


def test_quality_accuracy(spark):
    truth = {r["doc_id"]: r["quality"] for r in table(spark, MEDIUM, "labels").collect()}
    found = [r for r in QUERIES["op7_neighbour_quality"](spark, MEDIUM).collect() if r["held_out"] and r["doc_id"] in truth]
    good, bad = ([r["score"] for r in found if truth[r["doc_id"]] == x] for x in (1, 0))
    assert np.mean([[g > b for g in good] for b in bad]) >= 0.97
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in found]) >= 0.97


def test_quality_odd_rows(spark):
    docs = frames.docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (13, 0, 0), (13, 0, 1), (10, 0, 0), (4, None, 0), (None, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality_knn.learn(docs, labels, F.lit(True))
    found = quality_knn.score(docs, model)
    assert found.select("doc.*").columns == docs.columns
    rows = found.collect()
    assert len(rows) == len(frames.TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    by_text = {r["doc"]["text"]: r["score"] for r in rows}
    assert by_text[None] == by_text[""] == pytest.approx(2 / 5)
    assert by_text[frames.TEXTS[0][1]] > 0.5 > by_text["spam $$$ " * 100]


def test_repeated_rows_are_learned_from_once(spark, monkeypatch):
    monkeypatch.setattr(quality_knn, "SAMPLE_ROWS", 5)
    rows = [(1, frames.PROSE)] * 300 + [(k, f"{frames.OTHER} {k}") for k in range(2, 6)] + [(9, "spam $$$ " * 50)] * 40
    labels = spark.createDataFrame([(k, 1) for k in range(1, 6)] + [(1, 1), (9, 0), (9, 0)], "doc_id long, quality int")
    model = quality_knn.learn(frames.plain(spark, rows), labels, F.lit(True))
    assert sorted(model.labels.tolist()) == [0, 1, 1, 1, 1, 1] and len(model.vectors) == 6


def test_quality_without_labels(spark):
    docs, labels = frames.docs(spark), spark.createDataFrame([], "doc_id long, quality int")
    model = quality_knn.learn(docs, labels, F.lit(True))
    assert {r["score"] for r in quality_knn.score(docs, model).collect()} == {0.5}
    assert quality_knn.score(frames.docs(spark, []), model).count() == 0


# N-gram join


def test_components_of_paths_and_stars(spark):
    rnd = random.Random(6)
    nodes = list(range(400))
    rnd.shuffle(nodes)
    links = list(zip(nodes[:150], nodes[1:150])) + [(nodes[200], x) for x in nodes[201:300]] + [(5, 5), (nodes[300], nodes[301])] * 2
    found = connected(scratch(spark), spark.createDataFrame(links, "a long, b long"), "c")
    got = {r["node"]: r["component"] for r in found.collect()}
    want = {x: min(nodes[:150]) for x in nodes[:150]} | {x: min(nodes[200:300]) for x in nodes[200:300]}
    want |= {x: min(nodes[300:302]) for x in nodes[300:302]}
    assert got == want
    assert connected(scratch(spark), spark.createDataFrame([], "a long, b long"), "e").count() == 0


def joined(spark, rows, width, percent):
    found = ngram_join.memberships(scratch(spark), frames.plain(spark, rows), "doc_id", "text", width, percent)
    return Counter((r["id"], r["size"], r["component_id"]) for r in found.select("doc.id", "size", "component_id").collect())


def wanted(rows, width, percent):
    sets = [frames.shingle_set(t, width) for _, t in rows]
    lead = frames.components(sets, percent)
    ids = {}
    for (i, _), c in zip(rows, lead):
        ids.setdefault(c, []).append(i)
    smallest = {c: min((i for i in own if i is not None), default=None) for c, own in ids.items()}
    return Counter((i, len(s), i if not s else smallest[c]) for (i, _), s, c in zip(rows, sets, lead))


def edited(rnd, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rnd.randrange(len(out))] = f"new{rnd.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("block", [2, 512])
@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_join_odd_rows(spark, monkeypatch, block, width, percent):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "BUCKET", block)
    rnd = random.Random(block + percent)
    base = [f"w{rnd.randrange(300)}" for _ in range(150)]
    rows = [(i, t) for i, t, *_ in frames.TEXTS]
    rows += [(200 + k, edited(rnd, base, k % 7)) for k in range(25)]
    rows += [(300 + k, " ".join(base[k : 100 + k])) for k in range(0, 40, 3)]  # a chain
    rows += [(400, " ".join(base).upper()), (401, " ".join(base).replace(" ", "\n\t")), (402, "One two"), (403, "one  TWO"), (404, "one two three")]
    assert joined(spark, rows, width, percent) == wanted(rows, width, percent)


def test_join_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SMALL, "documents").collect()]
    found = QUERIES["op5_ngram_join"](spark, SMALL).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == wanted(rows, 3, 90)


def test_join_keeps_one_of_each_group(spark):
    docs = frames.docs(spark)
    found = ngram_join.representatives(scratch(spark), docs)
    assert found.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in found.collect())
    sets = [frames.shingle_set(t, 5) for _, t, *_ in frames.TEXTS]
    lead = frames.components(sets, 80)
    # One row of each group, rows without words, and equal rows once.
    assert sum(got.values()) == len({c for c, s in zip(lead, sets) if s}) + len({(i, t) for (i, t, *_), s in zip(frames.TEXTS, sets) if not s})
    assert (1, frames.TEXTS[0][1]) in got and (2, frames.TEXTS[1][1]) not in got and (None, frames.PROSE) not in got
    assert ngram_join.representatives(scratch(spark), frames.docs(spark, [])).count() == 0


@pytest.mark.parametrize("percent", [90, 80])
def test_close_sets_share_a_signature_under_every_allocation(percent):
    rnd = np.random.default_rng(percent)
    limits = ngram_join.bands(400)
    for sets in (10, 10**9, 10**13):
        plan = [ngram_join.allocation(first, last, sets, percent) for first, last in limits]
        for (_, last), (segments, twos, spare) in zip(limits, plan):
            assert segments + twos - spare == 2 * last * (100 - percent) // (100 + percent) + 1
        for _ in range(400):
            size = int(rnd.integers(1, 300))
            a = np.unique(rnd.integers(0, 2**63, size).astype(np.uint64))
            drop = int(rnd.integers(0, max(1, size // 8)))
            more = rnd.integers(0, 2**63, int(rnd.integers(0, max(1, size // 8)))).astype(np.uint64)
            b = np.unique(np.concatenate([a[drop:], more]))
            inside = len(np.intersect1d(a, b))
            if len(b) and 100 * inside >= percent * (len(a) + len(b) - inside):
                one, two = ({(k, s): d for k, d, own in ngram_join.parts(x, limits, plan, percent) for s in own.tolist()} for x in (a, b))
                assert one.keys() & two.keys()
                for key in one.keys() & two.keys():
                    assert ngram_join.alike([one[key], two[key]], [len(a), len(b)], percent, 2) == [(0, 1)]


def test_common_counts_and_forest():
    rnd = np.random.default_rng(3)
    left, right = ([np.unique(rnd.integers(0, 60, int(rnd.integers(1, 50))).astype(np.uint64)) for _ in range(9)] for _ in range(2))
    assert (ngram_join.common(left, right) == [[len(np.intersect1d(a, b)) for b in right] for a in left]).all()
    assert ngram_join.forest([(1, 2), (2, 1), (2, 3), (1, 3), (4, 5)]) == [(1, 2), (2, 3), (4, 5)]
