"""Mix sources to target weights.

Every source gets a share of all words by its weight, but at most ``most``
times its own words; what is above that is shared again by weight. A source
that is to give ``r`` times its words and a rest gives every document ``r``
times and, once more, the documents whose hash is below a threshold.

The thresholds come from histograms of words by source and by the upper bits
of the hash: the running sum finds the bucket in which the budget ends, and
only that bucket is counted again by the next bits, until it holds one hash.
Nothing is sorted by document, and a source that holds a third of all rows is
at most ``2 ** BITS`` rows a task. The document in which the budget ends is
taken if that brings the source nearer to its target. Rows that are alike in id,
source and text have one hash; where the budget ends among them, as many are
taken as bring the source nearest to its target. They are numbered in hashed
shares, so no task sees all rows that are alike.

Null text and text without words have size 0 and take no words. Null is a
source of its own, after all others. An empty table gives an empty table. Other columns pass through, whatever their names.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from promptframe.llm.words import word_count
from promptframe.scratch import Scratch, numbered

# The weights of sources in order of their names, repeated, and the most
# copies of a document.
WEIGHTS, MOST = (5, 2, 1), 3

BITS, LEVELS = 12, 5
# Shares in which rows that are alike are numbered.
SHARES = 4096
BROADCAST_ROWS = 50_000
WHOLE = "decimal(38,0)"


def mix_hash(doc_id: Column, text: Column) -> Column:
    """60 bits that do not depend on order, partitions or run."""
    named = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("long")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def source_targets(scratch: Scratch, sized: DataFrame, weights=WEIGHTS, most: int = MOST) -> tuple[DataFrame, int]:
    """``source, source_size, target, repeats, need`` by source, and the number of sources."""
    sums = scratch.store(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sums")
    count = sums.count()
    order = [F.col("source").isNull(), F.col("source")]
    ranked = numbered(scratch, sums, order, "place", "ranked", 1 + count // 100_000)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = ranked.withColumn("weight", weight)
    totals = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total, rest, shares = totals[0] or 0, totals[0] or 0, totals[1] or 1

    def above(rest: int, shares: int) -> Column:
        cap = F.col("source_size").cast(WHOLE) * F.lit(Decimal(most * shares))
        return cap < F.col("weight").cast(WHOLE) * F.lit(Decimal(rest))

    while True:  # a level that no longer changes is reached: it only rises, and each round caps a source more
        capped = F.when(above(rest, shares), F.col("source_size"))
        used, left = sources.agg(F.sum(capped), F.sum(F.when(capped.isNull(), F.col("weight")))).first()
        now = (total - most * int(used or 0), int(left or 0))
        if now == (rest, shares) or not now[1]:
            break
        rest, shares = now
    shared = (F.col("weight").cast(WHOLE) * F.lit(Decimal(rest))).cast("double") / F.lit(float(shares))
    target = F.when(above(rest, shares), F.col("source_size").cast("double") * most).otherwise(shared)
    out = sources.select("source", "source_size", target.alias("target"))
    repeats = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    out = out.withColumn("repeats", repeats)
    return out.withColumn("need", F.col("target") - F.col("repeats") * F.col("source_size")), count


def thresholds(scratch: Scratch, sized: DataFrame, plan: DataFrame, sources: int) -> DataFrame:
    """``s, below, taken, alike``: rows with a smaller hash are taken once more, and ``taken`` of the ``alike`` rows with this hash.

    ``sized``: ``source, size, hash``.
    """
    wanted = plan.filter("need > 0 AND source_size > 0").select(F.col("source").alias("s"), "need")
    state = wanted.select("s", "need", F.lit(0).cast("long").alias("path"), F.lit(0).cast("long").alias("before"))
    ended = []
    for level in range(LEVELS):
        shift = BITS * (LEVELS - level - 1)
        inside = F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("hash", shift + BITS) == F.col("path"))
        counted = (
            sized.join(_small(state, sources), inside)
            .groupBy("s", "need", "before", F.shiftright("hash", shift).alias("bucket"))
            .agg(F.sum("size").alias("words"), F.min("hash").alias("low"), F.max("hash").alias("high"), F.count("*").alias("n"))
        )
        # Both steps see at most 2 ** BITS buckets of a source.
        buckets = F.sort_array(F.collect_list(F.struct("bucket", "words", "low", "high", "n")))
        fields = ("bucket", "words", "low", "high", "n")

        def state_of(total: Column, of: Column | None) -> Column:
            rest = [(of[c] if of is not None else F.lit(None).cast("long")).alias(c) for c in fields]
            return F.struct(total.alias("sum"), *rest)

        running = F.aggregate(
            F.col("buckets"),
            state_of(F.col("before"), None),
            lambda a, b: F.when(a["bucket"].isNotNull(), a)
            .when(a["sum"] + b["words"] > F.col("need"), state_of(a["sum"], b))
            .otherwise(state_of(a["sum"] + b["words"], a)),
        )
        found = (
            counted.groupBy("s", "need", "before")
            .agg(buckets.alias("buckets"))
            .select("s", "need", running.alias("at"))
            .select("s", "need", F.col("at.bucket").alias("path"), F.col("at.sum").alias("before"), "at.words", "at.low", "at.high", "at.n")
            .filter("path IS NOT NULL")
        )
        found = scratch.store(found, f"level{level}")
        ended.append(found.filter("low = high"))
        state = found.filter("low <> high").select("s", "need", "path", "before")
        if level + 1 == LEVELS or state.isEmpty():
            break
    last = ended[0]
    for more in ended[1:]:
        last = last.unionByName(more)
    # The nearest number of rows of one size; half a row is left.
    taken = F.ceil((F.col("need") - F.col("before")) * F.col("n") / F.col("words") - 0.5)
    return last.select("s", F.col("low").alias("below"), F.greatest(taken, F.lit(0)).cast("long").alias("taken"), F.col("n").alias("alike"))


def number_alike(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``s``) and ``rank``, their number from 0 within ``s``, counted by shares."""
    dealt = rows.withColumn("share", F.pmod(F.monotonically_increasing_id(), F.lit(SHARES)))
    earlier = Window.partitionBy("s").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("s", "share").agg(F.count("*").alias("n"))
    before = counts.select(F.col("s").alias("b_s"), F.col("share").alias("b_share"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("s", "share").orderBy("hash")) - 1
    same = F.col("s").eqNullSafe(F.col("b_s")) & (F.col("share") == F.col("b_share"))
    return dealt.withColumn("within", within).join(before, same).withColumn("rank", F.col("before") + F.col("within"))


def mix_sources(
    scratch: Scratch,
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    most: int = MOST,
    whole: bool = True,
) -> DataFrame:
    """``doc`` (the row as it was, or its id alone), ``size, source_size, target, copies``.

    ``copies`` is how often the mix takes the document, 0 to ``most``.
    """
    sized = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        mix_hash(F.col(doc_id), F.concat_ws("|", F.col(source), F.col(text))).alias("hash"),
    )
    sized = scratch.store(sized, "sized")
    plan, sources = source_targets(scratch, sized, weights, most)
    plan = scratch.store(plan, "plan")
    cuts = thresholds(scratch, sized.select("source", "size", "hash"), plan, sources)
    ready = scratch.store(
        plan.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").select(
            F.col("source").alias("s"), "source_size", "target", "repeats", "below", "taken", "alike"
        ),
        "ready",
    )
    if whole:
        rows = docs.select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            mix_hash(F.col(doc_id), F.concat_ws("|", F.col(source), F.col(text))).alias("hash"),
        )
    else:
        rows = sized.select(F.struct("doc_id").alias("doc"), "source", "size", "hash")
    joined = rows.join(_small(ready, sources), F.col("source").eqNullSafe(F.col("s")))
    # Null where all rows of the source are taken equally often.
    edge = F.coalesce((F.col("hash") == F.col("below")) & (F.col("alike") > 1), F.lit(False))

    def mixed(some: DataFrame, extra: Column) -> DataFrame:
        copies = F.col("repeats") + F.coalesce(extra.cast("long"), F.lit(0))
        return some.select("doc", "size", "source_size", "target", copies.alias("copies"))

    one = (F.col("hash") < F.col("below")) | ((F.col("hash") == F.col("below")) & (F.col("taken") > 0))
    out = mixed(joined.filter(~edge), one)
    if ready.filter("alike > 1").isEmpty():
        return out
    alike = number_alike(scratch.store(joined.filter(edge), "alike"))
    return out.unionByName(mixed(alike, F.col("rank") < F.col("taken")))
