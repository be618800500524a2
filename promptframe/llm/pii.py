"""Personal data, and the words that give it away.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers by
pattern, each kind leftmost and non-overlapping, with the checks named at
``valid``; a match that fails is dropped and not tried again in part. None of
the patterns crosses a line feed, so they run line by line, in forms that take
time in proportion to the line however long it is.

The method adds words. An entity is the value of a base span. How much a word
``t`` reveals about entity ``e`` is their pointwise mutual information over
documents; the whole information of ``e`` is ``-log p(e)``. A plain word, at any
place of a document that holds an entity, is one of kind ``term`` where the
information it gives is at least ``DISCLOSED`` of the whole, which is where
``log p(e|t) >= -(1 - DISCLOSED) * -log p(e)``, and where at least ``SUPPORT``
documents hold both. All frequencies are counted over all documents, each row
being one. Every occurrence of such a word, in any document, is a span: it gives
the entity away wherever it stands. In the sanitised text base spans are
generalised to their kind and terms are removed.

Counts of entities, words and pairs are combined before the shuffle. Null and
empty texts have no spans. Rows that agree in id and text have the same spans;
null ids are ids like any other. An empty table gives an empty table. Extra
columns pass through ``sanitise``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from promptframe.scratch import Scratch

# The kinds in their order, and their patterns. Possessive forms,
# and starts only where a run starts, find the same matches without going back.
KINDS = ("email", "ip", "card", "phone", "term")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
IP_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)
# A word of letters alone, with nothing but punctuation between it and white space.
BEFORE, AFTER = r"(?<![^\x20\x09-\x0D(\[\"'])", r"(?=[.,;:!?)\]\"']*+(?:[\x20\x09-\x0D]|\z))"
TERM = BEFORE + r"\p{L}{3,}+" + AFTER
MARKED = r"@|[0-9][\x20().-]*[0-9]"

SUPPORT, DISCLOSED = 3, 0.9
BROADCAST_ROWS = 100_000
# Rows above which a key is common.
HOT = 10_000


def valid(kind: Column, value: Column) -> Column:
    """IP parts of at most 255; 14 to 19 digits that pass Luhn's test; 10 to 15 digits."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    count = F.char_length(digits)
    back = F.reverse(F.when(count <= CARD_DIGITS[1], digits))
    digit = lambda i: F.substring(back, i, F.lit(1)).cast("int")
    twice = lambda i: digit(i) * 2 - F.when(digit(i) > 4, 9).otherwise(0)
    sums = F.aggregate(
        F.sequence(F.lit(1), F.lit(CARD_DIGITS[1])),
        F.lit(0),
        lambda total, i: total + F.when(i > count, 0).when(i % 2 == 1, digit(i)).otherwise(twice(i)),
    )
    return (
        F.when(kind == "ip", value.rlike(rf"^{IP_PART}\.{IP_PART}\.{IP_PART}\.{IP_PART}\z"))
        .when(kind == "card", F.when(count.between(*CARD_DIGITS), sums % 10 == 0).otherwise(False))
        .when(kind == "phone", count.between(*PHONE_DIGITS))
        .otherwise(True)
    )


def matches(df: DataFrame, text: str, patterns: dict[str, Column], begin: Column) -> DataFrame:
    """Every match in column ``text`` as columns ``kind, value, start, end`` beside the others of ``df``, whose ``row`` names it.

    The text between matches gives their places: its lengths and theirs, summed.
    """
    body = F.col(text)
    found = [
        F.struct(
            F.lit(kind).alias("kind"),
            F.regexp_extract_all(body, pattern, F.lit(0)).alias("values"),
            F.when(F.rlike(body, pattern), F.transform(F.split(body, pattern, -1), F.char_length)).alias("gaps"),
        )
        for kind, pattern in patterns.items()
    ]
    own = [c for c in df.columns if c != text]
    kinds = df.withColumn("_begin", begin).select(*own, "_begin", F.inline(F.array(*found))).filter("size(values) > 0")
    each = kinds.select(
        *own, "_begin", "kind", F.posexplode(F.arrays_zip("values", F.slice("gaps", 1, F.size("values")).alias("gap"))).alias("_n", "_m")
    ).select(*own, "_begin", "kind", "_n", F.col("_m.values").alias("value"), F.col("_m.gap").alias("_gap"))
    upto = Window.partitionBy("row", "kind").orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("_begin") + F.sum(F.col("_gap") + F.char_length("value")).over(upto)
    placed = each.withColumn("end", end.cast("long"))
    return placed.select(*own, "kind", "value", (F.col("end") - F.char_length("value")).alias("start"), "end")


def row_id(doc_id: str, text: str) -> Column:
    return F.struct(F.col(doc_id).cast("string").alias("id"), F.xxhash64(text).alias("text"))


def marked_lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc, row, begin, line``: lines that may hold an entity, with their place in the text."""
    some = docs.filter(F.col(text).rlike(MARKED)).select(row_id(doc_id, text).alias("doc"), F.col(text).alias("body")).dropDuplicates(["doc"])
    lines = some.select("doc", F.posexplode(F.split("body", "\n", -1)).alias("n", "line"))
    kept = F.when(F.col("line").rlike(MARKED), F.col("line"))
    sizes = lines.select("doc", "n", F.char_length("line").alias("size"), kept.alias("line"))
    before = Window.partitionBy("doc").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.col("size") + 1).over(before), F.lit(0)).cast("long")
    return sizes.withColumn("begin", begin).filter("line IS NOT NULL").select("doc", F.struct("doc", "n").alias("row"), "begin", "line")


def base_spans(lines: DataFrame) -> DataFrame:
    """Places are those in the line."""
    patterns = {kind: F.lit(pattern) for kind, pattern in PATTERNS.items()}
    found = matches(lines, "line", patterns, F.lit(0))
    return found.filter(valid(F.col("kind"), F.col("value")))


def plain_words(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc, marked, forms`` of each row: whether it may hold an entity, and its plain words."""
    body = F.coalesce(F.col(text), F.lit(""))
    forms = F.array_distinct(F.regexp_extract_all(body, F.lit(TERM), F.lit(0)))
    return docs.select(row_id(doc_id, text).alias("doc"), body.rlike(MARKED).alias("marked"), forms.alias("forms"))


def few(df: DataFrame) -> bool:
    return df.count() <= BROADCAST_ROWS


def counted(rows: DataFrame, counts: DataFrame, key: str, number: str) -> DataFrame:
    """``rows`` whose ``key`` is in ``counts``, with its ``number``; no task gets all rows of a common key."""
    if few(counts):
        return rows.join(F.broadcast(counts), key)
    common = F.broadcast(counts.filter(F.col(number) > HOT))
    rest = rows.join(common.select(key), key, "left_anti").join(counts.filter(F.col(number) <= HOT), key)
    return rows.join(common, key).unionByName(rest)


def revealing(scratch: Scratch, words: DataFrame, base: DataFrame) -> DataFrame:
    """``entity, term`` of the words that give an entity away; ``words`` has ``doc, forms`` of each row.

    All counts are rows. A word reveals an entity only where at most
    ``with_e ** DISCLOSED * total ** (1 - DISCLOSED)`` rows hold it, so other
    pairs, which are most, are not made.
    """
    total = words.count()
    lowered = F.array_distinct(F.transform("forms", lambda f: F.lower(f)))
    holders = base.groupBy("doc").agg(F.collect_set(F.xxhash64("kind", F.lower("value"))).alias("entities"))
    holders = holders.select(F.col("doc.id").alias("h_id"), F.col("doc.text").alias("h_text"), "entities")
    same = F.col("doc.id").eqNullSafe(F.col("h_id")) & (F.col("doc.text") == F.col("h_text"))
    marked = words.filter("marked").select("doc", lowered.alias("terms")).join(holders, same)
    marked = scratch.store(marked.select("terms", "entities", F.monotonically_increasing_id().alias("n")), "marked")
    # One part in a thousand more, so that rounding loses no pair.
    most = 1.001 * F.pow("with_e", F.lit(DISCLOSED)) * F.lit(float(max(total, 1)) ** (1 - DISCLOSED))
    entities = marked.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("with_e"))
    entities = scratch.store(entities.filter(F.col("with_e") >= SUPPORT).withColumn("most", most), "entities")
    highest = entities.agg(F.max("most")).first()[0] or 0.0
    terms = words.select(F.explode(lowered).alias("term")).groupBy("term").agg(F.count("*").alias("with_t"))
    terms = scratch.store(terms.filter(F.col("with_t").between(F.lit(SUPPORT), F.lit(highest))), "terms")
    # The entities of a row that can have a term at all, then its words.
    own = counted(marked.select("n", F.explode("entities").alias("entity")), entities, "entity", "with_e")
    own = own.groupBy("n").agg(F.collect_list(F.struct("entity", "with_e", "most")).alias("own"))
    each = marked.join(own, "n").select(F.explode("terms").alias("term"), "own")
    each = counted(each, terms, "term", "with_t")
    fit = F.filter("own", lambda e: e["most"] >= F.col("with_t"))
    pairs = each.select("term", "with_t", F.inline(fit)).groupBy("entity", "term", "with_e", "with_t").agg(F.count("*").alias("with_both"))
    whole = F.log(F.lit(float(max(total, 2))) / F.col("with_e"))
    given = F.log(F.col("with_both") * F.lit(float(total)) / (F.col("with_e") * F.col("with_t")))
    found = pairs.filter((F.col("with_both") >= SUPPORT) & (whole > 0) & (given >= DISCLOSED * whole))
    return found.select("entity", "term")


def occurrences(scratch: Scratch, docs: DataFrame, doc_id: str, text: str, words: DataFrame, terms: DataFrame) -> DataFrame:
    """``doc, start, end`` of every place of the words ``term`` in the whole texts.

    A text is searched only for the words it holds, in the forms it holds them.
    """
    terms = F.broadcast(terms) if few(terms) else terms
    held = words.select("doc", F.explode("forms").alias("form")).withColumn("term", F.lower("form"))
    own = held.join(terms, "term", "left_semi").groupBy("doc").agg(F.array_join(F.sort_array(F.collect_set("form")), "|").alias("forms"))
    own = scratch.store(own.select(F.col("doc.id").alias("o_id"), F.col("doc.text").alias("o_text"), "forms"), "forms")
    same = F.col("doc.id").eqNullSafe(F.col("o_id")) & (F.col("doc.text") == F.col("o_text"))
    bodies = docs.select(row_id(doc_id, text).alias("doc"), F.col(text).alias("body")).join(own, same).dropDuplicates(["doc"])
    bodies = bodies.select("doc", F.col("doc").alias("row"), "body", F.concat(F.lit(BEFORE + "(?:"), "forms", F.lit(")" + AFTER)).alias("pattern"))
    return matches(bodies, "body", {"term": F.col("pattern")}, F.lit(0)).select("doc", "start", "end")


def find_spans(scratch: Scratch, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc`` (a row's id and the hash of its text), ``spans``: ``start, kind, end`` in order; rows without spans are not listed."""
    lines = marked_lines(docs, doc_id, text)
    base = scratch.store(base_spans(lines), "base")
    words = scratch.store(plain_words(docs, doc_id, text), "words")
    pairs = scratch.store(revealing(scratch, words, base), "revealing")
    found = occurrences(scratch, docs, doc_id, text, words, pairs.select("term").distinct())
    terms = found.select("doc", "start", F.lit(KINDS.index("term")).alias("kind"), "end")
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")) - 1
    place = F.col("begin")
    whole = base.select("doc", (place + F.col("start")).alias("start"), number.cast("int").alias("kind"), (place + F.col("end")).alias("end"))
    every = whole.unionByName(terms).groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    return scratch.store(every, "spans")


def written(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]))
    return F.coalesce(F.array_join(one, ","), F.lit(""))


def with_spans(docs: DataFrame, spans: DataFrame, doc_id: str, text: str, keep_text: bool = True) -> DataFrame:
    """``row`` (as it was) and its ``spans``, null where there are none."""
    kept = [F.col(f"`{c}`") for c in docs.columns if keep_text or c != text]
    rows = docs.select(F.struct(*kept).alias("row"), row_id(doc_id, text).alias("doc"))
    own = spans.select(F.col("doc.id").alias("s_id"), F.col("doc.text").alias("s_text"), "spans")
    same = F.col("doc.id").eqNullSafe(F.col("s_id")) & (F.col("doc.text") == F.col("s_text"))
    return rows.join(own, same, "left").select("row", "spans")


def sanitise(found: DataFrame, text: str = "text") -> DataFrame:
    """``found`` (of :func:`with_spans`) with ``sanitised``: base spans become ``[KIND]``, terms go.

    A span that begins inside an earlier one is covered by it.
    """
    body = F.col("row")[text]
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS[:-1]], F.lit(""))
    state = "struct<at:bigint,parts:array<string>>"
    cut = F.aggregate(
        F.coalesce(F.col("spans"), F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")),
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts")).cast(state),
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(
                    a["parts"],
                    F.array(
                        F.substring(body, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                        F.element_at(names, s["kind"] + 1),
                    ),
                ).alias("parts"),
            ).cast(state),
        ).otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["parts"].alias("parts")).cast(state)),
    )
    rest = F.substring(body, (F.col("_cut.at") + 1).cast("int"), F.char_length(body))
    return found.withColumn("_cut", cut).withColumn("sanitised", F.concat(F.array_join("_cut.parts", ""), rest)).drop("_cut")
