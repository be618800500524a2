"""Session settings the operators rely on, and the durable cut point."""

from __future__ import annotations

import sys
import tempfile

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Settings that change results, not only speed.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value instead of failing the parse.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that results depend on.

    Python functions of this package travel to the workers by value, so the
    workers need not have it installed.
    """
    cloudpickle.register_pickle_by_value(sys.modules["promptframe"])
    for key, value in RESULT_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, **settings: str) -> SparkSession:
    """A small session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("promptframe")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for durable intermediate results.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only where
    that is unset and the master is local does a temporary folder serve.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current:
        return current
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        named = tempfile.mkdtemp(prefix="promptframe-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
