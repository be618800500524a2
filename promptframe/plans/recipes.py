"""Recipes: what is specific to a kind of document and question."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promptframe.operators.chain import (
    Filter,
    RowTransform,
    Transform,
    annotate_attachments,
    auto_reply_filter,
    empty_body_filter,
    min_length_filter,
    trim_whitespace,
)
from promptframe.operators.contract import PII_CONTRACT, SPAM_CONTRACT, Contract
from promptframe.operators.render import package_text, with_attachments
from promptframe.sources.documents import accepts_mail_name, read_documents
from promptframe.sources.emails import parse_emails


@dataclass(frozen=True)
class Reader:
    """Which names are read, how contents become columns, and the text a model gets."""

    accepts: Callable[[Column], Column]
    parse: Callable[[DataFrame], DataFrame]
    package: Callable[[], Column]

    def read(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.parse(read_documents(spark, folder, self.accepts))


@dataclass(frozen=True)
class Recipe:
    """A reader with the chains around it. Built by a function, as columns need a session."""

    name: str
    reader: Reader
    contract: Contract | None = None
    filters: tuple[Filter, ...] = ()
    transforms: tuple[Transform | RowTransform, ...] = ()
    filters_after: tuple[Filter, ...] = ()
    output_transform: Callable[[DataFrame], DataFrame] | None = None


def spam_recipe() -> Recipe:
    return Recipe(
        "spam_detection",
        Reader(accepts_mail_name, parse_emails, package_text),
        SPAM_CONTRACT,
        filters=(empty_body_filter(),),
        transforms=(trim_whitespace(),),
    )


def pii_recipe() -> Recipe:
    def package() -> Column:
        return with_attachments(package_text(), F.col("metadata.attachment_names"))

    return Recipe(
        "gdpr_detection",
        Reader(accepts_mail_name, parse_emails, package),
        PII_CONTRACT,
        filters=(min_length_filter(), auto_reply_filter()),
        transforms=(annotate_attachments(),),
    )
