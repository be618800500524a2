"""One query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptframe.llm import (
    alignment,
    filter_audit,
    language,
    licenses,
    line_dedup,
    mixing,
    neighbours,
    ngram_join,
    packing,
    pii,
    quality_knn,
    quality_rules,
    repeated_spans,
)
from promptframe.llm.words import held_out
from promptframe.scratch import Scratch


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_cross_parsing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.learn(docs, ~held_out(F.col("doc_id")))
    out = language.identify(docs.select("doc_id", "text"), model, keep_text=False)
    return out.select("doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"), "lang_pred", "score")


def op2_block_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "op2")
    return neighbours.nearest(scratch, table(spark, folder, "embeddings"), F.col("id") % 50 == 0)


def op3_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "op3")
    out = mixing.mix_sources(scratch, table(spark, folder, "documents"), whole=False)
    return out.select("doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op4_quality_votes(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "op4")
    out = quality_rules.judge(scratch, table(spark, folder, "documents").select("doc_id", "text"), keep_text=False)
    return out.select("doc.doc_id", *quality_rules.MEASURES, "base_failed", "kept", "probability")


def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "op5")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = ngram_join.memberships(scratch, docs, "doc_id", "text", width=3, percent=90)
    return found.select("doc.id", F.col("size").alias("n_shingles"), "component_id").withColumnRenamed("id", "doc_id")


def op6_repeated_spans(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "op6")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return repeated_spans.remove_repeats(scratch, docs, with_kept=False).withColumnRenamed("own_id", "doc_id")


def op7_neighbour_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality_knn.learn(docs, labels, ~held_out(F.col("doc_id")))
    out = quality_knn.score(docs.select("doc_id", "text"), model, keep_text=False)
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return out.select("doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"), "score", predicted)


def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "op8")
    return packing.pack_documents(scratch, table(spark, folder, "documents"), tokenizer_path())


def op9_disclosing_terms(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "op9")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.with_spans(docs, pii.find_spans(scratch, docs), "doc_id", "text", keep_text=False)
    spans = F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    base = F.filter(spans, lambda s: s["kind"] < len(pii.PATTERNS))
    kinds = F.transform(spans, lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(pii.PATTERNS)
    ]
    digest = F.sha2(pii.written(base), 256).alias("base_sha256")
    return found.select("row.doc_id", *counts, digest, pii.written(spans).alias("spans"))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "op10")
    out = line_dedup.dedup_lines(scratch, table(spark, folder, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256")
    return out.select("doc.doc_id", "n_lines", "n_dropped", digest)


def op11_shared_cuts(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "op11")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = alignment.align(scratch, docs, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"), keep_text=False)
    return out.select("doc.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_signature_rules(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "op12")
    out = licenses.scan(scratch, table(spark, folder, "documents").select("doc_id", "text"), keep_text=False)
    return out.select("doc.doc_id", *out.columns[1:])


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "op13")
    return filter_audit.audit(scratch, table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES = {
    "op1_cross_parsing": op1_cross_parsing,
    "op2_block_neighbours": op2_block_neighbours,
    "op3_source_mix": op3_source_mix,
    "op4_quality_votes": op4_quality_votes,
    "op5_ngram_join": op5_ngram_join,
    "op6_repeated_spans": op6_repeated_spans,
    "op7_neighbour_quality": op7_neighbour_quality,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_disclosing_terms": op9_disclosing_terms,
    "op10_line_dedup": op10_line_dedup,
    "op11_shared_cuts": op11_shared_cuts,
    "op12_signature_rules": op12_signature_rules,
    "op13_filter_audit": op13_filter_audit,
}
