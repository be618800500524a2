"""Prompt text by precedence, from any storage that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession

from promptframe.sources.storage import read_text

# Fixed value: the sentence used where no prompt is given.
DEFAULT_PROMPT = "Analyse the following content and respond according to the schema."


def _named(spark: SparkSession, path: str) -> str:
    """The text of a file that was asked for; a file that is missing is an error."""
    text = read_text(spark, path)
    if text is None:
        raise FileNotFoundError(f"no prompt file {path}")
    return text.strip()


def read_prompt(spark: SparkSession, prompt_file: str | None = None, job_folder: str | None = None) -> str:
    """The named file, else ``prompt.txt`` of the job folder if there is one, else the default sentence."""
    if prompt_file:
        return _named(spark, prompt_file)
    text = read_text(spark, f"{job_folder}/prompt.txt") if job_folder else None
    return DEFAULT_PROMPT if text is None else text.strip()


def prompt_override(spark: SparkSession, text: str | None = None, file: str | None = None) -> str | None:
    """The prompt that replaces the rendered one, if any: inline text before file."""
    return text or (_named(spark, file) if file else None)
