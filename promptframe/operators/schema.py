"""Answers against whole JSON schemas, recursive ones too.

A schema is compiled to a table of states, one a subschema: what a value itself
has to be, which states its members and items are in, and which further states
the value is in and how many of them have to hold (all, any, exactly one, none).
A reference is the state it names, so a schema that refers to itself is a table
like any other.

A value is checked by the table alone. From the root, each pair of a value and a
state is expanded into the pairs it depends on, level by level; then the levels
are judged from the last to the first. The expression of a level is the same for
every schema and every level. A schema that does not refer to itself has as many
levels as its longest chain of states. One that does is judged in waves of
``WAVE`` levels: what is deeper in an answer becomes rows of the next wave, and
its messages come back by a join, so only deep answers cost more.

Types are lax as in contracts (``"0.9"`` is a number) unless ``lax`` is off. A
keyword that is not enforced is an error. A null answer fits nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptframe.functions.answers import as_string, kind
from promptframe.functions.frames import compute_once
from promptframe.functions.numbers import to_double
from promptframe.functions.text import strip
from promptframe.operators.contract import (
    BOOLEAN_TEXTS,
    CONFIDENCE_NAMES,
    FORMATS,
    LABEL_NAMES,
    strict_json_schema,
)
from promptframe.session import durable

# A type's bit.
TYPES = {"null": 1, "boolean": 2, "integer": 4, "number": 8, "string": 16, "array": 32, "object": 64}
ALL, ANY, ONE, NONE = "all", "any", "one", "none"
NUMBERS = {"minimum": "ge", "maximum": "le", "exclusiveMinimum": "gt", "exclusiveMaximum": "lt", "multipleOf": "multiple"}
SIZES = {
    "minLength": "min_length",
    "maxLength": "max_length",
    "minItems": "min_items",
    "maxItems": "max_items",
    "minProperties": "min_members",
    "maxProperties": "max_members",
}
NOTES = {
    "title", "description", "default", "examples", "$defs", "definitions", "$schema", "$id", "$comment", "deprecated", "readOnly",
    "writeOnly", "discriminator",
}
READ = {
    "type", "enum", "const", "pattern", "format", "uniqueItems", "required", "properties", "additionalProperties", "items", "prefixItems",
    "allOf", "anyOf", "oneOf", "not", "$ref", *NUMBERS, *SIZES,
}

# Levels of a wave.
WAVE = 6

_NODE = "array<struct<path:string,state:int,value:variant>>"


@dataclass
class State:
    """What a value in this state has to meet; -1 is the state of anything."""

    expected: str = "nothing"
    never: bool = False
    types: int = 0
    bounds: dict[str, float] = field(default_factory=dict)
    sizes: dict[str, int] = field(default_factory=dict)
    patterns: list[str] = field(default_factory=list)
    unique: bool = False
    listed: bool = False
    texts: list[str] = field(default_factory=list)
    numbers: list[float] = field(default_factory=list)
    others: list[str] = field(default_factory=list)
    required: list[str] = field(default_factory=list)
    members: dict[str, int] = field(default_factory=dict)
    rest: int = -1
    prefix: list[int] = field(default_factory=list)
    items: int = -1
    branches: list[int] = field(default_factory=list)
    mode: str = ALL

    def literal(self) -> Column:
        def listing(values: list, kind: str) -> Column:
            return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")

        pairs = [x for key, state in self.members.items() for x in (F.lit(key), F.lit(state))]
        members = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,int>")
        columns = {
            "expected": F.lit(self.expected),
            "never": F.lit(self.never),
            "types": F.lit(self.types),
            **{n: F.lit(self.bounds.get(n)).cast("double") for n in NUMBERS.values()},
            **{n: F.lit(self.sizes.get(n)).cast("int") for n in SIZES.values()},
            "patterns": listing(self.patterns, "string"),
            "unique": F.lit(self.unique),
            "listed": F.lit(self.listed),
            "texts": listing(self.texts, "string"),
            "numbers": listing(self.numbers, "double"),
            "others": listing(self.others, "string"),
            "required": listing(self.required, "string"),
            "members": members,
            "rest": F.lit(self.rest),
            "prefix": listing(self.prefix, "int"),
            "items": F.lit(self.items),
            "branches": listing(self.branches, "int"),
            "mode": F.lit(self.mode),
        }
        return F.struct(*[c.alias(n) for n, c in columns.items()])


def compile_schema(schema: dict | bool) -> tuple[list[State], int]:
    """The states of a schema and the number of the root's; -1 if it accepts anything."""
    states: list[State] = []
    known: dict[str, int] = {}

    def pointed(reference: str) -> object:
        if not reference.startswith("#"):
            raise ValueError(f"reference {reference} is not supported")
        found = schema
        for name in reference[1:].split("/")[1:]:
            name = name.replace("~1", "/").replace("~0", "~")
            found = found[int(name)] if isinstance(found, list) else found[name]
        return found

    def referred(reference: str, chain: tuple[str, ...] = ()) -> int:
        if reference in chain:
            raise ValueError(f"reference {reference} leads only to itself")
        target = pointed(reference)
        if isinstance(target, dict) and set(target) - NOTES == {"$ref"}:
            return referred(target["$ref"], (*chain, reference))
        if reference not in known:
            made(target, reference)
        return known[reference]

    def grouped(options: list, mode: str) -> int:
        states.append(State())
        number = len(states) - 1
        branches = [made(o) for o in options]
        told = {ANY: "one of the options", ONE: "exactly one of the options", NONE: "not the excluded form"}
        states[number] = State(expected=told[mode], branches=[b if b >= 0 else anything() for b in branches], mode=mode)
        return number

    def anything() -> int:
        if "" not in known:
            known[""] = len(states)
            states.append(State(expected="anything"))
        return known[""]

    def made(s: object, name: str | None = None) -> int:
        if s is True or s == {}:
            if name is not None:
                known[name] = -1
            return -1
        number = len(states)
        states.append(State())
        if name is not None:
            known[name] = number  # before its parts, which may refer to it
        if s is False:
            states[number] = State(expected="nothing here", never=True)
            return number
        if not isinstance(s, dict):
            raise ValueError(f"{s!r} is no schema")
        unknown = set(s) - NOTES - READ
        if unknown:
            raise ValueError(f"{sorted(unknown)} is not supported")
        types = s.get("type", [])
        types = [types] if isinstance(types, str) else types
        if set(types) - set(TYPES):
            raise ValueError(f"type {types} is not supported")
        if s.get("format", "date") not in FORMATS:
            raise ValueError(f"format {s['format']} is not supported")
        values = s["enum"] if "enum" in s else [s["const"]] if "const" in s else None
        if "enum" in s and "const" in s:
            values = [v for v in values if v == s["const"]]
        state = State(
            types=sum(TYPES[t] for t in set(types)),
            bounds={n: float(s[k]) for k, n in NUMBERS.items() if k in s},
            sizes={n: int(s[k]) for k, n in SIZES.items() if k in s},
            patterns=[p for p in (s.get("pattern"), FORMATS.get(s.get("format"))) if p is not None],
            unique=bool(s.get("uniqueItems")),
            required=list(s.get("required", [])),
        )
        if values is not None:
            state.listed = True
            for v in values:
                if isinstance(v, str):
                    state.texts.append(v)
                elif isinstance(v, (int, float)) and not isinstance(v, bool):
                    state.numbers.append(float(v))
                else:
                    state.others.append(json.dumps(v, sort_keys=True, separators=(",", ":"), ensure_ascii=False))
        state.expected = _expectation(types, s, values)
        state.members = {k: made(p) for k, p in s.get("properties", {}).items()}
        state.rest = made(s.get("additionalProperties", True))
        state.prefix = [made(p) for p in s.get("prefixItems", [])]
        state.items = made(s.get("items", True))
        also = [referred(s["$ref"])] if "$ref" in s else []
        also += [made(p) for p in s.get("allOf", [])]
        also += [grouped(s[k], mode) for k, mode in (("anyOf", ANY), ("oneOf", ONE)) if k in s]
        also += [grouped([s["not"]], NONE)] if "not" in s else []
        state.branches = [b for b in also if b >= 0]
        states[number] = state
        return number

    root = referred("#")
    return states, root


def _expectation(types: list[str], s: dict, values: list | None) -> str:
    limits = [f"in {values}"] if values is not None else []
    limits += [f"{k} {s[k]}" for k in (*NUMBERS, *SIZES, "pattern", "format") if k in s]
    limits += ["uniqueItems"] if s.get("uniqueItems") else []
    return " ".join([" or ".join(types) or "value", *limits])


def levels_of(states: list[State], root: int) -> int | None:
    """States on the longest chain from the root, None where a chain has no end."""
    lengths: dict[int, int | None] = {}

    def longest(at: int) -> int | None:
        if at < 0:
            return 0
        if at in lengths:
            return lengths[at]
        lengths[at] = None  # while it is open
        s = states[at]
        below = [longest(x) for x in (*s.members.values(), s.rest, *s.prefix, s.items, *s.branches)]
        lengths[at] = None if None in below else 1 + max(below, default=0)
        return lengths[at]

    return longest(root)


def refuse_endless_values(states: list[State]) -> None:
    """Error where one value would be in the same state again and again."""
    done: set[int] = set()

    def follow(at: int, above: frozenset[int]) -> None:
        if at in above:
            raise ValueError("a schema that refers to itself for the same value")
        if at not in done:
            for branch in states[at].branches:
                follow(branch, above | {at})
            done.add(at)

    for at in range(len(states)):
        follow(at, frozenset())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


class SchemaContract:
    """A JSON schema as a contract: it checks answers and goes into requests."""

    def __init__(self, schema: dict, name: str | None = None, lax: bool = True):
        self.schema, self.lax = schema, lax
        self.name = name or schema.get("title", "Answer")
        self.states, self.root = compile_schema(schema)
        self.levels = levels_of(self.states, self.root)
        refuse_endless_values(self.states)
        self._table = F.array(*[s.literal() for s in self.states]) if self.states else None

    def json_schema(self) -> dict:
        return self.schema

    def text_format(self) -> dict:
        return {"format": {"type": "json_schema", "name": self.name, "schema": strict_json_schema(self.schema), "strict": True}}

    def _properties(self) -> dict[str, State]:
        root = self.states[self.root] if self.root >= 0 else State()
        return {k: self.states[s] for k, s in root.members.items() if s >= 0}

    def label_field(self, explicit: str | None = None) -> str | None:
        """The given name, else the first enumerated text member, else a well-known name."""
        found = self._properties()
        listed = [k for k, s in found.items() if s.types == TYPES["string"] and s.texts]
        return explicit or next(iter(listed + [n for n in LABEL_NAMES if n in found]), None)

    def confidence_field(self, explicit: str | None = None) -> str | None:
        found = self._properties()
        numeric = [n for n in CONFIDENCE_NAMES if n in found and found[n].types & (TYPES["number"] | TYPES["integer"])]
        return explicit or next(iter(numeric), None)

    def check(self, df: DataFrame, value: str, fits: str, messages: str) -> DataFrame:
        """Add whether a variant column fits, and what it violates."""
        if self.root < 0:
            told = F.when(F.col(value).isNull(), F.array(F.lit("answer: missing"))).otherwise(F.array().cast("array<string>"))
            found = df.withColumn(messages, told)
        else:
            root = F.struct(F.lit("").alias("path"), F.lit(self.root).alias("state"), F.col(value).alias("value"))
            judged = self._judged(df.withColumn("_n0", F.array(root).cast(_NODE)))
            told = F.when(F.col(value).isNull(), F.array(F.lit("answer: missing"))).otherwise(F.element_at("_m0", 1))
            found = judged.select(*df.columns, told.alias(messages))
        return found.select(*df.columns, (F.size(messages) == 0).alias(fits), messages)

    def _judged(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``_m0``, messages for each of the nodes in ``_n0``."""
        columns, levels = rows.columns, self.levels or WAVE
        for k in range(levels):
            kept = rows.columns
            rows = compute_once(rows.withColumn("_nodes", F.col(f"_n{k}")), _parts=self._expanded)
            rows = compute_once(rows, **{f"_n{k + 1}": F.flatten("_parts"), f"_e{k}": self._ends})
            rows = rows.select(*kept, f"_n{k + 1}", f"_e{k}")
        if self.levels is None:
            rows = self._with_deeper(rows, f"_n{levels}", f"_m{levels}")
        else:
            rows = rows.withColumn(f"_m{levels}", F.array().cast("array<array<string>>"))
        for k in reversed(range(levels)):
            ready = rows.withColumns({"_nodes": F.col(f"_n{k}"), "_below": F.col(f"_m{k + 1}"), "_at": F.col(f"_e{k}")})
            rows = compute_once(ready, **{f"_m{k}": self._verdicts})
            rows = rows.drop("_nodes", "_below", "_at", f"_m{k + 1}", f"_n{k + 1}", f"_e{k}")
        return rows.select(*columns, "_m0")

    # The expressions of any level, over ``_nodes`` and what is below them; made once.

    @cached_property
    def _expanded(self) -> Column:
        return F.transform("_nodes", lambda n: let(self._rules(n["state"]), lambda r: self._parts(n, r)))

    @cached_property
    def _ends(self) -> Column:
        return F.aggregate("_parts", F.array(F.lit(0)), lambda done, p: F.concat(done, F.array(F.element_at(done, -1) + F.size(p))))

    @cached_property
    def _verdicts(self) -> Column:
        def own(i: Column) -> Column:
            begin = F.get(F.col("_at"), i)
            return F.slice("_below", begin + 1, F.get(F.col("_at"), i + 1) - begin)

        return F.transform("_nodes", lambda n, i: self._verdict(n, own(i)))

    def _with_deeper(self, rows: DataFrame, nodes: str, messages: str) -> DataFrame:
        """``rows`` with the messages of the nodes that are deeper than a wave: those are rows of a wave of their own."""
        rows = durable(rows.withColumn("_row", F.monotonically_increasing_id()))
        deeper = rows.where(F.size(nodes) > 0).select(F.col("_row").alias("_of"), F.posexplode(nodes).alias("_place", "_node"))
        none = F.array().cast("array<array<string>>")
        if deeper.isEmpty():
            return rows.drop("_row").withColumn(messages, none)
        judged = self._judged(deeper.select("_of", "_place", F.array("_node").alias("_n0")))
        each = judged.select("_of", F.struct("_place", F.element_at("_m0", 1).alias("told")).alias("one"))
        # As many as the row's answer has nodes.
        told = each.groupBy(F.col("_of").alias("_told_of")).agg(F.transform(F.sort_array(F.collect_list("one")), lambda x: x["told"]).alias("_told"))
        told = durable(told)
        joined = rows.join(told, F.col("_row") == F.col("_told_of"), "left")
        return joined.withColumn(messages, F.coalesce("_told", none)).drop("_row", "_told_of", "_told")

    # From here on: columns over the table of states.

    def _rules(self, state: Column) -> Column:
        return F.element_at(self._table, state + 1)

    def _parts(self, n: Column, r: Column) -> Column:
        """The nodes that a node depends on: its branches, then members, then items."""

        def node(path: Column, state: Column, value: Column) -> Column:
            return F.struct(path.alias("path"), state.alias("state"), value.alias("value"))

        branches = F.transform(r["branches"], lambda s: node(n["path"], s, n["value"]))
        object_ = F.map_entries(F.try_variant_get(n["value"], "$", "map<string,variant>"))
        members = F.transform(
            object_, lambda e: node(F.concat(n["path"], F.lit("."), e["key"]), F.coalesce(r["members"][e["key"]], r["rest"]), e["value"])
        )
        items = F.transform(
            F.try_variant_get(n["value"], "$", "array<variant>"),
            lambda v, i: node(
                F.concat(n["path"], F.lit("["), i.cast("string"), F.lit("]")),
                F.when(i < F.size(r["prefix"]), F.get(r["prefix"], i)).otherwise(r["items"]),
                v,
            ),
        )
        none = F.array().cast(_NODE)
        needed = F.filter(F.concat(F.coalesce(members, none), F.coalesce(items, none)), lambda x: x["state"] >= 0)
        return F.concat(branches.cast(_NODE), needed.cast(_NODE))

    def _verdict(self, n: Column, below: Column) -> Column:
        def of(r: Column) -> Column:
            count = F.size(r["branches"])
            inner = F.flatten(F.slice(below, count + 1, F.size(below)))
            branches = F.slice(below, F.lit(1), count)
            hold = F.size(F.filter(branches, lambda m: F.size(m) == 0))
            met = (
                F.when(r["mode"] == ANY, hold > 0)
                .when(r["mode"] == ONE, hold == 1)
                .when(r["mode"] == NONE, hold == 0)
                .otherwise(F.lit(True))
            )
            told = F.when(r["mode"] == ALL, F.flatten(branches)).otherwise(F.array().cast("array<string>"))
            wrong = F.concat(_place(n["path"]), F.lit(": expected "), r["expected"])
            own = F.when(self._fits(n["value"], r) & met, F.array().cast("array<string>")).otherwise(F.array(wrong))
            keys = F.coalesce(F.map_keys(F.try_variant_get(n["value"], "$", "map<string,variant>")), r["required"])
            missing = F.transform(
                F.array_except(r["required"], keys), lambda k: F.concat(_place(F.concat(n["path"], F.lit("."), k)), F.lit(": missing"))
            )
            return F.array_distinct(F.concat(own, missing, told, inner))

        return let(self._rules(n["state"]), of)

    def _fits(self, value: Column, r: Column) -> Column:
        """Whether a value itself is as its state wants."""

        def allowed(*names: str) -> Column:
            return r["types"].bitwiseAND(sum(TYPES[x] for x in names)) != 0

        def of(k: Column) -> Column:
            text = as_string(value)
            is_text, is_boolean = k == "STRING", k == "BOOLEAN"
            is_number = k.startswith("BIGINT") | k.startswith("D")  # DECIMAL or DOUBLE
            is_list, is_object, is_null = k.startswith("ARRAY"), k.startswith("OBJECT"), k == "VOID"
            plain = F.try_variant_get(value, "$", "double")
            read = F.when(is_text, to_double(strip(text))).otherwise(plain) if self.lax else F.when(is_number, plain)
            number = F.when(is_number | is_text | is_boolean, read)
            whole = F.when(is_text, strip(text).rlike(r"^[+-]?\d+(_\d+)*(\.0+)?$")).otherwise(number % 1 == 0)
            boolean = is_boolean
            if self.lax:
                boolean = boolean | (is_text & F.lower(text).isin(BOOLEAN_TEXTS)) | (is_number & plain.isin([0.0, 1.0]))
            typed = (
                (r["types"] == 0)
                | (allowed("null") & is_null)
                | (allowed("boolean") & boolean)
                | (allowed("number") & number.isNotNull())
                | (allowed("integer") & number.isNotNull() & whole)
                | (allowed("string") & is_text)
                | (allowed("array") & is_list)
                | (allowed("object") & is_object)
            )
            as_text = is_text & ((r["types"] == 0) | allowed("string"))
            # Texts count as numbers only where a number is wanted and no text.
            measured = F.when(is_number | ((is_text | is_boolean) & ~as_text & allowed("number", "integer")), number)
            times = measured / r["multiple"]
            bounded = (
                (measured >= F.coalesce(r["ge"], measured))
                & (measured <= F.coalesce(r["le"], measured))
                & F.coalesce(measured > r["gt"], F.lit(True))
                & F.coalesce(measured < r["lt"], F.lit(True))
                & F.coalesce(F.abs(times - F.rint(times)) < 1e-9, F.lit(True))
                & ~(F.isnan(measured) & (r["ge"].isNotNull() | r["gt"].isNotNull()))
            )

            def sized(size: Column, name: str) -> Column:
                return F.coalesce(size >= r[f"min_{name}"], F.lit(True)) & F.coalesce(size <= r[f"max_{name}"], F.lit(True))

            lists = F.try_variant_get(value, "$", "array<variant>")
            different = F.size(F.array_distinct(F.transform(lists, lambda e: F.to_json(e)))) == F.size(lists)
            spelled = sized(F.char_length(text), "length") & F.forall(r["patterns"], lambda p: F.rlike(text, p))
            members = F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))
            in_list = (
                F.when(is_text, F.array_contains(r["texts"], text))
                .when(is_number, F.array_contains(r["numbers"], plain))
                .otherwise(F.array_contains(r["others"], F.to_json(value)))
            )
            return (
                ~r["never"]
                & typed
                & F.when(measured.isNotNull(), bounded).otherwise(True)
                & F.when(as_text, spelled).otherwise(True)
                & F.when(is_list, sized(F.size(lists), "items") & (~r["unique"] | different)).otherwise(True)
                & F.when(is_object, sized(F.size(members), "members")).otherwise(True)
                & F.when(r["listed"], in_list).otherwise(True)
            )

        return F.coalesce(let(kind(value), of), F.lit(False))


def _place(path: Column) -> Column:
    return F.when(path == "", F.lit("answer")).otherwise(F.regexp_replace(path, r"^\.", ""))
