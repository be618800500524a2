"""From raw documents to packed sequences, one operator a stage.

Every stage reads all documents that the one before kept. All but the last
return the columns of documents. Null and empty texts, repeated rows and extra
columns are handled as the operators say; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptframe.llm import line_dedup, mixing, ngram_join, packing, quality_rules
from promptframe.llm.queries import table, tokenizer_path
from promptframe.scratch import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality_rules.judge(Scratch(spark, "quality"), docs).filter("kept").select("doc.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that other documents hold too go; a text that loses all of them is empty, null stays null."""
    found = line_dedup.dedup_lines(Scratch(spark, "lines"), docs, store_lines=False)
    text = F.when(F.col("doc.text").isNotNull(), F.coalesce("kept", F.lit("")))
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length(text).cast(docs.schema["n_chars"].dataType)
    return found.select(*[new[c].alias(c) if c in new else F.col(f"doc.`{c}`") for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.representatives(Scratch(spark, "near"), docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, in rows that are alike."""
    found = mixing.mix_sources(Scratch(spark, "mix"), docs).filter("copies > 0")
    return found.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return packing.pack_documents(Scratch(spark, "pack"), docs, tokenizer_path())


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("mixed", mixed), ("packed", packed)]

# Tokens have no SQL, and quality and near copies none that ends on whole tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written before the next begins."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir), name)
    return docs
