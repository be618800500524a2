"""Connected components of links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptframe.scratch import Scratch


def connected(scratch: Scratch, links: DataFrame, label: str) -> DataFrame:
    """``node, component`` (the smallest node) of every node in ``links``, which has ``a, b``.

    Each round hangs a node's larger neighbours on its smallest one, then its
    smaller neighbours and itself on the smallest of them; the links become one
    star a component in about as many rounds as the logarithm of the longest
    path. Rounds end when nothing changes; each is written once, the one
    before it deleted.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = scratch.store(edges, f"{label}0")
    state, turn = None, 0
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        lead = F.least("u", "m")
        large = both.filter("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), lead.alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        small = large.join(least, F.col("u") == F.col("k"))
        hung = small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        turn += 1
        after = scratch.store(hung.select("e.*").filter("u <> v").distinct(), f"{label}{turn}")
        now = tuple(after.agg(F.count("*"), F.sum("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        scratch.drop(f"{label}{turn - 1}")
        edges = after
        if now == state:
            break
        state = now
    leads = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(leads.withColumn("component", F.col("node")))
