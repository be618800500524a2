"""CSV records whose quoted cells hold line feeds, read in splits.

Whether a line begins inside a quoted cell depends on all lines before it. But a
line does one of four things to that state: keep it, turn it, or leave it open or
closed whatever it was. So lines are read in splits as any text, each is judged
from both states, and what happened before a range of lines is one row a range.
Lines that are a record alone stay where they are; the others meet by record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promptframe.operators.ordering import KEY, RANGE, by_range, running_sums_by_range, with_range
from promptframe.session import durable, shuffle_partitions

# A quote opens a cell only at the cell's begin; doubled, it is part of the cell.
_CELL = r'(?:[ \t]*+"(?:[^"]|"")*+"[^,]*+|(?![ \t]*+")[^,]*+)'
_REST = rf'(?:{_CELL},)*+[ \t]*+"(?:[^"]|"")*+$'
_OPENS = rf"^{_REST}"
_STAYS = r'^(?:[^"]|"")*+$'
_OPENS_AGAIN = rf'^(?:[^"]|"")*+"[^,]*+,{_REST}'


def _after(line: Column) -> tuple[Column, Column]:
    """Whether a cell is open after the line, if none was before it and if one was."""
    return line.rlike(_OPENS).cast("int"), (line.rlike(_STAYS) | line.rlike(_OPENS_AGAIN)).cast("int")


def _turned(state: Column, times: Column) -> Column:
    return F.pmod(state + times, F.lit(2)).cast("int")


def line_states(ranged: DataFrame, ranges: int) -> DataFrame:
    """``ranged`` with ``_open``: 1 where a line begins inside a cell. ``_first`` marks lines that begin a file."""
    closed, opened = _after(F.col("value"))
    judged = ranged.withColumns({"_from0": closed, "_from1": opened})
    fixed = F.when(F.col("_first") | (F.col("_from0") == F.col("_from1")), F.col("_from0"))
    turns = F.when(fixed.isNull() & (F.col("_from0") == 1), 1).otherwise(0)
    here = W.partitionBy(RANGE).orderBy(KEY)
    upto, before = here.rowsBetween(W.unboundedPreceding, 0), here.rowsBetween(W.unboundedPreceding, -1)
    rows = by_range(judged.withColumns({"_fixed": fixed, "_turns": turns}), ranges)
    rows = rows.withColumn("_run", F.sum("_turns").over(upto))
    known = F.when(F.col("_fixed").isNotNull(), F.struct(F.col("_fixed").alias("state"), F.col("_run").alias("run")))
    rows = rows.withColumns({"_known": F.last(known, ignorenulls=True).over(before), "_last": known})
    # What each range does, and from that what was before it: one row a range.
    ends = rows.groupBy(RANGE).agg(F.sum("_turns").alias("turns"), F.max_by("_last", F.when(F.col("_last").isNotNull(), F.col(KEY))).alias("last"))
    order = W.orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
    ends = ends.withColumn("total", F.sum("turns").over(W.orderBy(RANGE)))
    at = F.when(
        F.col("last").isNotNull(), F.struct(F.col("last.state").alias("state"), (F.col("total") - F.col("turns") + F.col("last.run")).alias("run"))
    )
    ends = ends.withColumns({"_seen": F.last(at, ignorenulls=True).over(order), "_total": F.coalesce(F.col("total") - F.col("turns"), F.lit(0))})
    entry = _turned(F.coalesce(F.col("_seen.state"), F.lit(0)), F.col("_total") - F.coalesce(F.col("_seen.run"), F.lit(0)))
    entries = ends.select(RANGE, entry.alias("_entry"))
    placed = rows.join(F.broadcast(entries), RANGE)
    run = F.col("_run") - F.col("_turns")
    state = F.when(F.col("_known").isNotNull(), _turned(F.col("_known.state"), run - F.col("_known.run"))).otherwise(_turned(F.col("_entry"), run))
    return placed.select(*ranged.columns, "_from0", F.when(F.col("_first"), 0).otherwise(state).alias("_open"))


def joined_records(lines: DataFrame, order: Column, ranges: int | None = None) -> DataFrame:
    """``value, _order`` of every record of ``value, file`` lines; ``order`` is a struct that sorts them, files together."""
    ranges = ranges or shuffle_partitions(lines.sparkSession)
    ordered = lines.select("value", "file", order.alias("_order"))
    # Cut off, so that the order is the same for all that reads it.
    ordered = durable(ordered)
    first = ordered.groupBy(F.col("file").alias("_file")).agg(F.min("_order").alias("_begin"))
    marked = ordered.join(first, (F.col("file") == F.col("_file")) & (F.col("_order") == F.col("_begin")), "left")
    marked = marked.select("value", "_order", F.col("_file").isNotNull().alias("_first"))
    ranged = with_range(marked, ["_order"], ranges)
    states = durable(line_states(ranged, ranges))
    alone = (F.col("_open") == 0) & (F.col("_from0") == 0)
    numbered = running_sums_by_range(states, ranges, _record=F.when(F.col("_open") == 0, 1).otherwise(0))
    parts = numbered.where(~alone | (F.col("_open") == 1)).groupBy("_record").agg(
        F.sort_array(F.collect_list(F.struct("_order", "value"))).alias("lines")
    )
    text = F.array_join(F.transform("lines", lambda x: x["value"]), "\n")
    several = parts.select(text.alias("value"), F.element_at("lines", 1)["_order"].alias("_order"))
    return states.where(alone).select("value", "_order").unionByName(several)
