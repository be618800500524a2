"""Operators that measure, cut, mix or pack single documents."""

import array
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm import frames
from pyspark.sql import functions as F

from promptframe.llm import line_dedup, mixing, packing, pii, quality_rules, repeated_spans
from promptframe.llm.queries import QUERIES, table, tokenizer_path
from promptframe.llm.words import held_out
from promptframe.scratch import Scratch

SMALL = "/root/testdata/sf0.001"


def texts(spark):
    return [(r["doc_id"], r["text"]) for r in table(spark, SMALL, "documents").collect()]


def scratch(spark):
    return Scratch(spark, "test")


# Lines


def deduped(rows, least=2):
    """``n_lines, n_dropped, kept`` of each row."""
    key = lambda line: frames.lower(line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    order = lambda i: (i is None, i or 0)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(order(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(holders[key(x)]) >= least and min(holders[key(x)]) != order(i))]
        out.append((len(lines), len(lines) - len(kept), None if text is None or not kept else "\n".join(kept)))
    return out


@pytest.mark.parametrize("least", [2, 3])
def test_line_dedup_odd_rows(spark, least):
    rows = [(i, t) for i, t, *_ in frames.TEXTS]
    found = line_dedup.dedup_lines(scratch(spark), frames.docs(spark), min_documents=least).collect()
    assert all(r["doc"]["a b.c"] == 12 and r["doc"]["kept"] == 7 for r in found)
    got = Counter((r["doc"]["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in found)
    assert got == Counter((i, *x) for (i, _), x in zip(rows, deduped(rows, least)))


def test_line_dedup_empty_table(spark):
    assert line_dedup.dedup_lines(scratch(spark), frames.docs(spark, [])).count() == 0


# Mixing


def mixed(spark, rows):
    frame = frames.docs(spark, rows)
    return mixing.mix_sources(scratch(spark), frame).collect()


def test_mix_odd_rows(spark):
    found = mixed(spark, frames.TEXTS)
    assert len(found) == len(frames.TEXTS)
    assert all(r["size"] == len(frames.words(r["doc"]["text"])) for r in found)
    assert all(0 <= r["copies"] <= mixing.MOST for r in found)
    targets = {r["doc"]["source"]: r["target"] for r in found}
    assert sum(targets.values()) == pytest.approx(sum(r["size"] for r in found))
    assert targets[None] <= 3 * sum(r["size"] for r in found if r["doc"]["source"] is None)


def test_mix_comes_near_its_targets_and_repeats(spark):
    rnd = random.Random(3)
    rows = [(i, "w " * rnd.randint(1, 40), "en", rnd.choice("aaaaaaabcd")) for i in range(1500)]
    first, second = mixed(spark, rows), mixed(spark, rows[::-1])
    key = lambda r: (r["doc"]["doc_id"], r["copies"])
    assert sorted(map(key, first)) == sorted(map(key, second))
    taken, target = Counter(), {}
    for r in first:
        taken[r["doc"]["source"]] += r["size"] * r["copies"]
        target[r["doc"]["source"]] = r["target"]
    # Half of the largest document at most.
    assert all(abs(taken[s] - target[s]) <= 20 for s in target)


def test_mix_of_equal_rows_and_one_bucket(spark):
    rows = [(7, "same text here", "en", "a")] * 300 + [(8, "other words", "en", "b")]
    found = mixed(spark, rows)
    # Equal rows are taken as near to the target as whole rows allow.
    for source in "ab":
        own = [r for r in found if r["doc"]["source"] == source]
        assert abs(sum(r["size"] * r["copies"] for r in own) - own[0]["target"]) <= 1.5
    rows = [(7, "same text here", "en", "a")] * 1000 + [(i, "w " * 30, "en", "b") for i in range(400)] + [(9, "x y", "en", None)] * 50
    found = mixed(spark, rows)
    for source, most in (("a", 1.5), ("b", 15), (None, 1)):
        own = [r for r in found if r["doc"]["source"] == source]
        assert abs(sum(r["size"] * r["copies"] for r in own) - own[0]["target"]) <= most


def test_mix_empty_tables(spark):
    assert mixed(spark, []) == []
    assert [r["copies"] for r in mixed(spark, [(1, None, None, None), (2, "", "en", "a")])] == [0, 0]


# Packing


def check_packing(rows, found, capacity):
    """Ids as the tokenizer gives them, gapless sequences within the capacity."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    want, got = Counter(), Counter()
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        # Full pieces from the end; what is left is the first.
        ends = list(range(len(ids), 0, -capacity))[::-1]
        for piece, end in enumerate(ends):
            start = max(0, end - capacity)
            own = ids[start:end]
            want[(i, piece, start, len(own), zlib.crc32(array.array("I", own).tobytes()))] += 1
    sequences = defaultdict(list)
    for r in found:
        got[(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])] += 1
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_packing_of_documents(spark):
    rows = texts(spark)
    found = QUERIES["op8_best_fit_packing"](spark, SMALL).collect()
    used = check_packing(rows, found, 2048)
    assert used <= -(-sum(r["length"] for r in found) // 2048) + 1


def test_packing_odd_rows(spark):
    rows = [*((i, t) for i, t, *_ in frames.TEXTS), (20, "a <|endoftext|> b"), (21, "  \x1c　 x\x85y")]
    found = packing.pack_documents(scratch(spark), frames.plain(spark, rows), tokenizer_path(), capacity=64, with_ids=True)
    found = found.collect()
    check_packing(rows, found, 64)
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in found)
    assert packing.pack_documents(scratch(spark), frames.docs(spark, []), tokenizer_path()).count() == 0


def test_packing_cuts_the_first_piece():
    assert list(packing.cut(3002, 2048)) == [(0, 954), (954, 2048)]
    assert list(packing.cut(4096, 2048)) == [(0, 2048), (2048, 2048)]
    assert list(packing.cut(1, 2048)) == [(0, 1)]


@pytest.mark.parametrize("blanks", [9_999, 10_000, 1_000_000])
def test_packing_of_long_white_space(spark, blanks):
    rows = [(1, "a" + " " * blanks + "b"), (2, "\t" * blanks), (3, " \n" * (blanks // 2))]
    found = packing.pack_documents(scratch(spark), frames.plain(spark, rows), tokenizer_path()).collect()
    check_packing(rows, found, 2048)


def test_encoder_equals_tokenizer_on_all_scripts():
    from tokenizers import Tokenizer

    with open(tokenizer_path(), encoding="utf-8") as file:
        source = file.read()
    encoder, tokenizer = packing.Encoder(source), Tokenizer.from_str(source)
    every = [c for c in map(chr, range(0x2FFF)) if not 0xD800 <= ord(c) < 0xE000]
    for at in range(0, len(every), 7):
        text = "a " + "".join(f"{c}b  {c}{c}1 " for c in every[at : at + 7]) + "it's we'LL\n\n x"
        assert encoder.encode(text) == array.array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def test_plan_places_every_rank_once():
    rnd = random.Random(5)
    for _ in range(60):
        capacity = rnd.choice([8, 50, 2048])
        histogram = {rnd.randint(1, capacity): rnd.randint(1, 400) for _ in range(rnd.randint(1, 30))}
        ranks, fill = defaultdict(list), defaultdict(list)
        for length, rank, count, first, offset in packing.plan(histogram, capacity):
            for k in range(count):
                ranks[length].append(rank + k)
                fill[first + k].append((offset, length))
        assert {k: len(v) for k, v in ranks.items()} == histogram
        assert all(sorted(v) == list(range(histogram[k])) for k, v in ranks.items())
        for places in fill.values():
            ends = [0] + [o + n for o, n in sorted(places)]
            assert ends[:-1] == [o for o, _ in sorted(places)] and ends[-1] <= capacity


# Quality rules


def test_quality_measures(spark):
    rows = [*((i, t) for i, t, *_ in frames.TEXTS), *texts(spark)]
    found = quality_rules.judge(scratch(spark), frames.plain(spark, rows)).collect()
    got = Counter((r["doc"]["doc_id"], *[r[m] for m in quality_rules.MEASURES]) for r in found)
    assert got == Counter((i, *frames.base_measures(t)) for i, t in rows)
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) for r in found)
    assert not any(r["kept"] and r["base_failed"] for r in found)


def test_quality_extra_columns_and_empty_table(spark):
    found = quality_rules.judge(scratch(spark), frames.docs(spark)).select("doc.*")
    assert found.columns == frames.docs(spark).columns and found.count() == len(frames.TEXTS)
    assert quality_rules.judge(scratch(spark), frames.docs(spark, [])).count() == 0


def test_quality_keeps_clean_and_rejects_junk(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = {r["doc_id"]: r["quality"] for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    found = [r for r in quality_rules.judge(scratch(spark), docs).collect() if r["doc"]["doc_id"] in labels and not r["base_failed"]]
    for label, share in ((1, 0.98), (0, 0.02)):
        own = [r["kept"] for r in found if labels[r["doc"]["doc_id"]] == label]
        assert (np.mean(own) >= share) if label else (np.mean(own) <= share)


def test_repeated_words_with_many_different_words():
    words = np.concatenate([np.arange(1 << 21, (1 << 21) + 50), [1 << 40, 3, 4, 5, 3, 4, 5, 9]])
    assert quality_rules.repeated_words(words) == 6
    assert quality_rules.repeated_words(np.array([1, 1, 1, 1])) == 4
    assert quality_rules.repeated_words(np.array([1, 2, 3])) == 0


def test_estimate_trusts_votes_for_bad():
    rules = len(quality_rules.RULES)
    clean, junk = sum(3**k for k in range(rules)), 2 + 2 * 3 + sum(3**k for k in range(2, rules))
    p = quality_rules.estimate(np.array([clean, junk, 0]), np.array([900.0, 100.0, 5.0]))
    assert p[0] > 0.9 and p[1] < 0.1 and 0 <= p[2] <= 1


# Personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def is_valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        doubled = [int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text):
    kinds = list(PATTERNS)
    found = [(m.start(), kinds.index(k), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if is_valid(k, m.group())]
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(found))


ODD = [
    (30, "a@b.c_d@e.f x@y.z. é😀 me@host.org,you@host.org.\n1.2.3.4.5.6.7.8 999.1.1.1 00001.2.3.004"),
    (31, "4111111111111111 4111-1111 1111 1111 4111 1111 1111 1112 +49 (0) 171-234.5678) +1 +12345678901234567"),
    (32, "1" * 20_000 + " a@b" + ".c" * 8000 + " " + "x" * 50_000 + "@"),
    (33, "+" * 50 + "1.2.3.4" * 40 + "\n\n\r\n@@ a@ @b.c 1@2.3"),
    (34, "4111 1111 1111 1111\n4111 1111 1111 1111 4111"),
]


def test_base_spans(spark):
    rows = [*((i, t) for i, t, *_ in frames.TEXTS), *ODD, *texts(spark)]
    docs = frames.plain(spark, rows)
    found = pii.with_spans(docs, pii.find_spans(scratch(spark), docs), "doc_id", "text").collect()
    own = lambda r: [s for s in r["spans"] or [] if s["kind"] < 4]
    names = list(PATTERNS)
    got = Counter((r["row"]["doc_id"], r["row"]["text"], ",".join(f"{names[s['kind']]}:{s['start']}:{s['end']}" for s in own(r))) for r in found)
    assert got == Counter((i, t, base_spans(t)) for i, t in rows)


def test_query_of_spans(spark):
    found = {r["doc_id"]: r for r in QUERIES["op9_disclosing_terms"](spark, SMALL).collect()}
    for i, text in texts(spark):
        spans = base_spans(text)
        assert found[i]["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
        assert set(filter(None, spans.split(","))) <= set(found[i]["spans"].split(","))
        assert found[i]["n_email"] == spans.count("email:")


def test_terms_that_give_an_entity_away(spark):
    fill = [(100 + k, f"the mill wheel turned {k} times for many people that day and the weather was fine") for k in range(200)]
    near = [(k, f"on day {k} the falconer wrote from jane@falcon.org about the weather") for k in range(6)]
    docs = frames.plain(spark, fill + near)
    found = pii.sanitise(pii.with_spans(docs, pii.find_spans(scratch(spark), docs), "doc_id", "text"))
    got = {r["row"]["doc_id"]: r["sanitised"] for r in found.collect()}
    assert got[3] == "on day 3 the    [EMAIL]  the weather"
    assert got[105] == fill[5][1]


def test_terms_go_wherever_they_stand(spark):
    fill = [(100 + k, f"the mill wheel turned {k} times for many people that day and the weather was fine") for k in range(200)]
    near = [(k, f"the falconer of day {k}: jane@falcon.org\n" + "the mill wheel turned " * 9 + "\n(Falconer), FALCONER. falconer's") for k in range(20)]
    docs = frames.plain(spark, fill + near + [(None, "the falconer; Falconer\nfalconers"), (7, "the mill 😀 FALCONER"), (7, "the mill 😀 FALCONER")])
    found = pii.sanitise(pii.with_spans(docs, pii.find_spans(scratch(spark), docs), "doc_id", "text"))
    got = [(r["row"]["doc_id"], r["sanitised"]) for r in found.collect()]
    assert (3, "the  of day 3: [EMAIL]\n" + "the mill wheel turned " * 9 + "\n(), . falconer's") in got
    assert (None, "the ; \nfalconers") in got and got.count((7, "the mill 😀 ")) == 2
    assert fill[5] in got


@pytest.mark.parametrize("few", [True, False])
def test_terms_of_the_whole_document(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(pii, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(pii, "HOT", 15)
    copied = "Contact for all questions: jane@falcon.org\n"  # one line in all documents of the entity
    fill = [(100 + k, f"the mill wheel turned {k} times for many people, questions for all") for k in range(300)]
    above = [(k, "Name: Falconer\n" + "the mill wheel turned " * 9 + "\n" + copied) for k in range(20)]
    other = [(50 + k, f"smith{'' if k else 's'} of the mill " + "wheel turned " * 9 + " +1 (555) 010-2345 many people") for k in range(4)]
    pair = [(60 + k, f"only {'miller' if k else 'bakers'} bob@mill.org") for k in range(3)]
    rows = fill + above + other + pair
    docs = frames.plain(spark, rows)
    found = pii.with_spans(docs, pii.find_spans(scratch(spark), docs), "doc_id", "text").collect()
    got = {(r["row"]["doc_id"], r["row"]["text"][s["start"] : s["end"]]) for r in found for s in r["spans"] or [] if s["kind"] == 4}
    words = {i: {w for w in re.findall(r"(?<![^\s(])[^\W\d_]{3,}(?=[.,:;)]*(?:\s|$))", t)} for i, t in rows}
    entities = {i: {m[0] for m in re.finditer(r"\S+@\S+|[+]1.{15}", t)} for i, t in rows}
    # Every pair of an entity and a word of the same document, counted in documents.
    with_e, with_t, both = Counter(), Counter(), Counter()
    for i, _ in rows:
        lowered = {w.lower() for w in words[i]}
        with_e.update(entities[i])
        with_t.update(lowered)
        both.update((e, w) for e in entities[i] for w in lowered)
    terms = {t for (e, t), n in both.items() if n >= 3 and n / with_t[t] >= (with_e[e] / len(rows)) ** 0.1}
    assert {"falconer", "name", "contact", "smith", "only"} <= terms and not {"the", "wheel", "miller"} & terms
    assert got == {(i, w) for i in words for w in words[i] if w.lower() in terms}


def test_spans_extra_columns_and_empty_table(spark):
    docs = frames.docs(spark)
    found = pii.sanitise(pii.with_spans(docs, pii.find_spans(scratch(spark), docs), "doc_id", "text"))
    assert found.select("row.*").columns == docs.columns and found.count() == len(frames.TEXTS)
    by_id = {r["row"]["doc_id"]: r["sanitised"] for r in found.collect()}
    assert by_id[14] == "mail [EMAIL] or [PHONE] from [IP]\ncard [CARD]" and by_id[5] is None
    assert pii.find_spans(scratch(spark), frames.docs(spark, [])).count() == 0


# Repeated spans


def cut(rows, length):
    """``n_bytes, n_removed, n_spans`` and digest of what is kept, of each row."""
    data = [(t or "").encode() for _, t in rows]
    count = Counter(x[k : k + length] for x in data for k in range(len(x) - length + 1))
    out = []
    for x in data:
        gone = np.zeros(len(x), bool)
        for k in range(len(x) - length + 1):
            if count[x[k : k + length]] > 1:
                gone[k : k + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(x), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(x, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def check_repeats(spark, rows, length, anchor):
    found = repeated_spans.remove_repeats(scratch(spark), frames.plain(spark, rows), length=length, anchor=anchor).collect()
    got = Counter((r["own_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found)
    assert got == Counter((i, *x) for (i, _), x in zip(rows, cut(rows, length)))
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in found)


@pytest.mark.parametrize("group", [1, 4096])
def test_repeats(spark, monkeypatch, group):
    monkeypatch.setattr(repeated_spans, "GROUP", group)
    monkeypatch.setattr(repeated_spans, "CHUNK", 1000)
    monkeypatch.setattr(repeated_spans, "STEP", 1 << 12)
    rnd = random.Random(group)
    shared = "".join(rnd.choice("abcd \n\0é") for _ in range(60))
    rows = [(i, t) for i, t, *_ in frames.TEXTS if len(t or "") < 20_000]
    rows += [(50 + k, "".join(rnd.choice("abcdefgh ") for _ in range(80)) + shared[k % 9 :] + "".join(rnd.choice("xyz") for _ in range(40))) for k in range(30)]
    check_repeats(spark, rows, 40, 16)


def test_repeats_query(spark):
    found = {r["doc_id"]: r for r in QUERIES["op6_repeated_spans"](spark, SMALL).collect()}
    rows = texts(spark)
    for (i, _), want in zip(rows, cut(rows, 200)):
        r = found[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want


def test_repeats_empty_table(spark):
    assert repeated_spans.remove_repeats(scratch(spark), frames.docs(spark, [])).count() == 0


def test_repeated_starts_on_random_texts():
    rnd = random.Random(2)
    for _ in range(150):
        length, letters = rnd.choice([2, 3, 7, 20]), rnd.choice(["ab", "abc", "abcdefgh\0"])
        some = ["".join(rnd.choice(letters) for _ in range(rnd.randint(length, 60))).encode() for _ in range(rnd.randint(1, 6))]
        some += [x[: len(x) // 2] + some[0] for x in some if rnd.random() < 0.4]
        count = Counter(x[k : k + length] for x in some for k in range(len(x) - length + 1))
        for x, got in zip(some, repeated_spans.repeated_starts(some, length)):
            assert got.tolist() == [count[x[k : k + length]] > 1 for k in range(len(x) - length + 1)]


def test_held_out(spark):
    rows = spark.createDataFrame([(1,), (None,), (12345,)], "i long")
    want = [zlib.crc32(b"1") % 5 == 0, True, zlib.crc32(b"12345") % 5 == 0]
    assert [r[0] for r in rows.select(held_out(F.col("i"))).collect()] == want


def test_leftmost_least_of_windows():
    rnd = np.random.default_rng(2)
    hashes = rnd.integers(0, 40, 500).astype(np.uint64) << np.uint64(20)
    for width in (1, 2, 3, 101, 137, 500):
        want = [i + int(np.argmin(hashes[i : i + width])) for i in range(len(hashes) - width + 1)]
        assert repeated_spans.leftmost_least(hashes, width).tolist() == want
