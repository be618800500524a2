"""The stages, one after the other."""

from collections import Counter

import corpus_pipeline
import pytest
from llm import frames
from llm.test_documents import deduped

FOLDER = "/root/testdata/sf0.001"


def test_stages_are_named():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_copies", "mixed", "packed"]


def test_stages_over_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        before, docs = docs.collect(), spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
        if name == "quality":
            failed = {r["doc_id"] for r in before if frames.base_measures(r["text"])[0] < 50}
            assert not failed & {r["doc_id"] for r in kept[name]}
        elif name == "lines":
            rows = [(r["doc_id"], r["text"]) for r in before]
            want = {i: (t and (x[2] or "")) for (i, t), x in zip(rows, deduped(rows))}
            assert {r["doc_id"]: r["text"] for r in kept[name]} == want
            assert all(r["n_chars"] == len(r["text"]) for r in kept[name])
        elif name == "near_copies":
            sets = [frames.shingle_set(r["text"], 5) for r in before]
            lead = frames.components(sets, 80)
            groups = {c: min(r["doc_id"] for r, k in zip(before, lead) if k == c) for c in lead}
            assert {r["doc_id"] for r in kept[name]} == set(groups.values())
        elif name == "mixed":
            size = Counter()
            for r in kept[name]:
                size[r["source"]] += len(frames.words(r["text"]))
            assert max(Counter(r["doc_id"] for r in kept[name]).values()) <= 3
            assert sum(size.values()) == pytest.approx(sum(len(frames.words(r["text"])) for r in before), rel=0.2)
        if name != "packed":
            assert docs.columns == columns
    pieces = Counter(r["doc_id"] for r in kept["packed"] if r["piece"] == 0)
    assert pieces == Counter(r["doc_id"] for r in kept["mixed"])


@pytest.mark.parametrize("texts", [frames.TEXTS, []])
def test_stages_on_odd_rows(spark, tmp_path, texts):
    docs = frames.docs(spark, texts)
    for name, stage in corpus_pipeline.STAGES:
        # Every stage takes the odd rows themselves.
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        found = spark.read.parquet(str(tmp_path / name))
        assert name == "packed" or found.columns == docs.columns
        assert bool(found.count()) == bool(texts)


def test_run(spark):
    found = corpus_pipeline.run(spark, FOLDER)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and found.count() > 0
