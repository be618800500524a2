"""Alignment, licences and the filter audit against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from llm import frames

from promptframe.llm import alignment, filter_audit, licenses
from promptframe.llm.queries import QUERIES, tokenizer_path
from promptframe.scratch import Scratch

SMALL = "/root/testdata/sf0.001"


def scratch(spark):
    return Scratch(spark, "test")


# Alignment


def plain_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(tokenizer_path())
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    byte_level = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [x for x in range(256) if x not in byte_level]
    byte_of = {chr(x): x for x in byte_level} | {chr(256 + k): x for k, x in enumerate(other)}
    rows, links = [], Counter()
    for text in texts:
        a = first.encode(" " + (text or ""), add_special_tokens=False)
        b = second.encode(text or "")
        bytes_a = [bytes(byte_of[c] for c in first.id_to_token(i)) for i in a.ids]
        pieces = [second.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            rows.append(None)
            continue
        ends_b = dict(zip(np.cumsum([len(x) for x in bytes_b]).tolist(), range(len(b))))
        groups, own, at_a, at_b, end = [], [], 0, 0, 0
        for k, (i, token) in enumerate(zip(a.ids, bytes_a)):
            end += len(token)
            if end in ends_b:
                j = ends_b[end]
                groups.append((a.ids[at_a : k + 1], b[at_b : j + 1]))
                own.append((i, b[j]))
                at_a, at_b = k + 1, j + 1
        links.update(own)
        rows.append((len(a.ids), len(b), groups, own))
    most = defaultdict(int)
    for (_, b), n in links.items():
        most[b] = max(most[b], n)
    out = []
    for row in rows:
        if row is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, own = row
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(links[p] == most[p[1]] for p in own)
        out.append((n_a, n_b, len(groups), len(own), best, sum(links[p] for p in own), hashlib.sha256(written.encode()).hexdigest()))
    return out


def aligned(spark, rows, **settings):
    frame = frames.plain(spark, rows)
    found = alignment.align(scratch(spark), frame, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"), **settings).collect()
    return sorted((repr(r["doc"]["doc_id"]), str(r["doc"]["text"]), *r[1:]) for r in found)


ODD = [
    *[(i, t) for i, t, *_ in frames.TEXTS],
    (30, "<|endoftext|> <s> <0x41> </s> <unk>"),
    (31, " ▁ a piece mark"),
    (32, "日本語のテキスト 😀 é́ \x00   x"),
    (33, "   spaces   and\t\ttabs \r\n\n lines  "),
    (34, " " * 20_000 + "x"),
    (35, "w" * 3000 + " end"),
]


@pytest.mark.parametrize("broadcast_pairs", [alignment.BROADCAST_PAIRS, 40, 0])
def test_alignment_odd_rows(spark, broadcast_pairs):
    want = sorted((repr(i), str(t), *row) for (i, t), row in zip(ODD, plain_alignment([t for _, t in ODD])))
    assert aligned(spark, ODD, broadcast_pairs=broadcast_pairs) == want


def test_alignment_of_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = {i: row for (i, _), row in zip(rows, plain_alignment([t for _, t in rows]))}
    assert {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_shared_cuts"](spark, SMALL).collect()} == want


def test_alignment_other_columns_and_empty_table(spark):
    paths = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
    found = alignment.align(scratch(spark), frames.docs(spark), *paths)
    assert found.select("doc.*").columns == frames.docs(spark).columns and found.count() == len(frames.TEXTS)
    assert alignment.align(scratch(spark), frames.docs(spark, []), *paths).count() == 0


def test_shared_cuts_are_the_common_ends():
    rnd = np.random.default_rng(4)
    for _ in range(200):
        ends_a, ends_b, texts_a, texts_b, at = [], [], [], [], 0
        for _ in range(rnd.integers(1, 6)):
            size = int(rnd.integers(1, 200))
            a, b = (np.unique(np.append(rnd.integers(1, size + 1, rnd.integers(0, 60)), size)) for _ in range(2))
            ends_a.append(a + at)
            ends_b.append(b + at)
            texts_a.append(len(a))
            texts_b.append(len(b))
            at += size
        ends_a, ends_b = np.concatenate(ends_a), np.concatenate(ends_b)
        last_a, last_b = alignment.shared_cuts(ends_a, ends_b, np.cumsum(texts_a), np.cumsum(texts_b))
        common = np.intersect1d(ends_a, ends_b)
        assert ends_a[last_a].tolist() == common.tolist() == ends_b[last_b].tolist()


# Licences


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", frames.lower(text or ""))


def plain_scan(text, rules):
    words, found = plain_words(text), {}
    for i, word in enumerate(words):
        window = " ".join([*words[max(0, i - licenses.REACH) : i], f"<{word}>", *words[i + 1 : i + 1 + licenses.REACH]])
        for r in rules:
            m = re.search(rf"(?:^| )({r.pattern})(?: |$)", window) if r.keyword == word else None
            if m:
                start = i - m[1].split("<")[0].count(" ")
                key = (start, start + m[1].count(" "), r.priority, r.label)
                found[key] = max(found.get(key, 0), r.weight)
    kept = {}
    for key in found:
        start, end, priority, label = key
        inside = any(
            o != key and o[0] <= start and o[1] >= end and o[2] <= priority
            and (o[0], -o[1], o[2], o[3]) < (start, -end, priority, label)
            for o in found
        )
        if priority == licenses.FIXED or not inside:
            kept[key] = found[key]
    base = sorted(k for k in kept if k[2] == licenses.FIXED)
    starts = [k[0] for k in base]
    labels = {}
    for (_, _, _, label), weight in kept.items():
        labels[label] = max(labels.get(label, 0), weight)
    left = 1.0
    for weight in sorted(labels.values()):
        left *= 1 - weight
    joined = ",".join(sorted({k[3] for k in base}))
    return len(words), len(base), min(starts, default=None), max(starts, default=None), joined, ",".join(sorted(labels)), 1 - left


LICENSED = [
    *[(i, t) for i, t, *_ in frames.TEXTS],
    (40, "Released under the MIT License. Released UNDER THE mit-license, under the mit licenses"),
    (41, "Licensed under the Apache License, Version 2.0 (the License)"),
    (42, "This work is licensed under CC BY-NC-SA 4.0; cc by nc"),
    (43, "SPDX-License-Identifier: GPL-3.0-or-later\n/* GNU General Public License version 3 */"),
    (44, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    (45, "Creative Commons Attribution-NonCommercial-ShareAlike, all rights reserved"),
    (46, "mitémit under the mit\x00license éunder the mit license"),
    (47, "the mit license " * 3000),
    (48, "x " * 50_000 + "under the mit license"),
    (49, "licensed under the bsd 3 clause license or the new bsd license or gplv2"),
]


def test_licenses_odd_rows(spark):
    rules = [*licenses.PHRASES, *licenses.default_rules()]
    rows = LICENSED + LICENSED[-10:-7]
    found = licenses.scan(scratch(spark), frames.plain(spark, rows)).collect()
    assert len(found) == len(rows)
    want = {}
    for i, t in rows:
        want.setdefault((i, t), plain_scan(t, rules))
    for r in found:
        own = tuple(r)[1:]
        assert own[:-1] == want[r["doc"]["doc_id"], r["doc"]["text"]][:-1]
        assert own[-1] == pytest.approx(want[r["doc"]["doc_id"], r["doc"]["text"]][-1])


def test_licenses_rules():
    rules = licenses.default_rules()
    assert len(rules) > 250 and len({(r.label, r.pattern) for r in rules}) == len(rules)
    assert all(re.compile(r.pattern) and 0 < r.weight <= 1 for r in rules)
    assert all(re.fullmatch("[a-z0-9]+", r.keyword) for r in [*rules, *licenses.PHRASES])


def test_licenses_other_columns_and_empty_table(spark):
    found = licenses.scan(scratch(spark), frames.docs(spark))
    assert found.select("doc.*").columns == frames.docs(spark).columns and found.count() == len(frames.TEXTS)
    assert licenses.scan(scratch(spark), frames.docs(spark, [])).count() == 0


# Filter audit


def plain_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, text, _ in docs:
        key = (i is None, i or 0)
        first[text or ""] = min(first.get(text or "", key), key)
    parts = defaultdict(list)
    for i, text, part in docs:
        text = text or ""
        words = frames.words(text)
        fails = set()
        fails |= {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else set()
        fails |= {"D"} if re.search("[#$%&*|]", text) else set()
        fails |= {"E"} if (i is None, i or 0) != first[text] else set()
        parts[part or ""].append((fails, i in good, i in toxic))
    rows = set()
    for part, own in parts.items():
        total, found = Counter(), []
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                fails = sum(f in x[0] for x in own)
                only = sum(x[0] == {f} for x in own)
                total[f] += len(gone)
                found.append((f, "".join(order), step, len(left), len(gone), fails - len(gone), only, sum(x[1] for x in gone), sum(x[2] for x in gone)))
        rows |= {(part, *x, total[f]) for f, *x in found}
    return rows


def audited(spark, docs, labels):
    docs = spark.createDataFrame([(i, t, s, 1, "m", 2.0) for i, t, s in docs], "doc_id long, text string, source string, mask int, part string, n double")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filter_audit.audit(scratch(spark), docs, labels)
    rows = [tuple(r) for r in found.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def test_audit_odd_rows(spark):
    docs = [(i, t, s) for i, t, _, s in frames.TEXTS]
    docs += [(50, "A B c " * 80, "a"), (51, "A B c " * 80, "b"), (51, "A B c " * 80, "b"), (None, "A B c " * 80, "b"), (52, " lead " * 250 + "#", "")]
    labels = [(1, 1, 0), (1, 0, 1), (3, None, 1), (None, 1, 1), (51, 1, 1), (50, 0, None), (50, 1, None), (999, 1, 1)]
    assert audited(spark, docs, labels) == plain_audit(docs, labels)


def test_audit_random_rows(spark):
    rnd = random.Random(8)
    words = ["a", "b", "C", "dd", "E#", "f"] + [f"w{i}" for i in range(300)]
    docs = [(rnd.randrange(150), " ".join(rnd.choices(words[: rnd.choice([5, 306])], k=rnd.choice([3, 199, 200, 260]))), rnd.choice("xyz")) for _ in range(120)]
    docs += rnd.choices(docs, k=40) + [(i + 1000, t, s) for i, t, s in rnd.choices(docs, k=40)]
    labels = [(i, rnd.randint(0, 1), rnd.randint(0, 1)) for i in range(0, 1200, 3)]
    assert audited(spark, docs, labels) == plain_audit(docs, labels)


def test_audit_empty_tables(spark):
    assert audited(spark, [], []) == set()
    assert len(audited(spark, [(1, None, None)], [])) == 600


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_shapley_is_the_sum_over_orders(n):
    rnd = random.Random(n)
    removed = [0] + [rnd.randint(0, 1000) for _ in range(2**n - 1)]
    want = [0] * n
    for order in permutations(range(n)):
        before = 0
        for i in order:
            want[i] += removed[before | 1 << i] - removed[before]
            before |= 1 << i
    rows, common = filter_audit.shapley_rows(n)
    assert [sum(c * v for c, v in zip(row, removed)) for row in rows] == [w * common for w in want]
