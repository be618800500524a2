"""Response contracts: what an answer must look like.

A contract is plain data on the driver. It yields the strict JSON schema that
goes into each request and, for the answers, one list of violations as a
column expression over a variant.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptframe.functions.answers import as_string, keys_of, kind, member
from promptframe.functions.frames import compute_once
from promptframe.functions.numbers import to_double
from promptframe.functions.text import strip

# Names that point to the label and to the confidence field.
LABEL_NAMES = ["label", "classification", "category", "class_", "verdict", "prediction", "result"]
CONFIDENCE_NAMES = ["confidence", "certainty", "score", "probability", "spam_score"]
# JSON-schema keywords that grammar-based servers refuse.
UNSUPPORTED_KEYWORDS = [
    "minimum",
    "maximum",
    "exclusiveMinimum",
    "exclusiveMaximum",
    "minItems",
    "maxItems",
    "maxLength",
    "minLength",
    "pattern",
    "format",
    "uniqueItems",
    "multipleOf",
]
# Texts that stand for a boolean in lax checking.
BOOLEAN_TEXTS = ["0", "off", "f", "false", "n", "no", "1", "on", "t", "true", "y", "yes"]

_REQUIRED = object()


@dataclass(frozen=True)
class Field:
    """One member of an answer object.

    ``type`` is string, number, integer, boolean, array, object, any or union;
    ``items`` describes array elements, ``members`` a nested object, ``options``
    what a union may be. Lengths are those of texts or arrays.
    """

    name: str
    type: str
    default: object = _REQUIRED
    enum: tuple = ()
    ge: float | None = None
    le: float | None = None
    gt: float | None = None
    lt: float | None = None
    multiple_of: float | None = None
    min_length: int | None = None
    max_length: int | None = None
    pattern: str | None = None
    format: str | None = None
    unique: bool = False
    options: tuple[Field, ...] = ()
    nullable: bool = False
    items: Field | None = None
    members: Contract | None = None
    description: str | None = None

    @property
    def required(self) -> bool:
        return self.default is _REQUIRED


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...] = field(default_factory=tuple)
    forbid_extra: bool = True

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def json_schema(self) -> dict:
        properties = {f.name: _field_schema(f) for f in self.fields}
        schema = {"type": "object", "title": self.name, "properties": properties}
        required = [f.name for f in self.fields if f.required]
        if required:
            schema["required"] = required
        if self.forbid_extra:
            schema["additionalProperties"] = False
        return schema

    def text_format(self) -> dict:
        """The block that asks a model for strict structured output."""
        schema = strict_json_schema(self.json_schema())
        return {"format": {"type": "json_schema", "name": self.name, "schema": schema, "strict": True}}

    def label_field(self, explicit: str | None = None) -> str | None:
        """The given name, else the first enumerated text field, else a well-known name."""
        enumerated = [f.name for f in self.fields if f.type == "string" and f.enum]
        known = [n for n in LABEL_NAMES if n in self.names]
        return explicit or next(iter(enumerated + known), None)

    def confidence_field(self, explicit: str | None = None) -> str | None:
        """The given name, else the first well-known name of a numeric field."""
        numeric = {f.name for f in self.fields if f.type in ("number", "integer")}
        return explicit or next((n for n in CONFIDENCE_NAMES if n in numeric), None)

    def violations(self, value: Column) -> Column:
        """Array of messages, empty where the variant meets the contract."""
        found = _object_violations(self, value, [_Member(f, member(value, f.name)) for f in self.fields])
        return F.filter(F.array(*found), lambda m: m.isNotNull())

    def accepts(self, value: Column) -> Column:
        """True where the variant meets the contract."""
        return _fits_object(self, value)

    def check(self, df: DataFrame, value: str, fits: str, messages: str) -> DataFrame:
        """Add ``accepts`` and ``violations`` of a variant column.

        Members and their kinds are worked out once per row and checked from
        there, which keeps the generated code small.
        """
        members = {f"_m{i}": member(F.col(value), f.name) for i, f in enumerate(self.fields)}
        kinds = {f"_k{i}": kind(F.col(f"_m{i}")) for i in range(len(self.fields))}
        ready = compute_once(compute_once(df, **members), **kinds) if members else df
        found = [_Member(f, F.col(f"_m{i}"), F.col(f"_k{i}")) for i, f in enumerate(self.fields)]
        broken = F.filter(F.array(*_object_violations(self, F.col(value), found)), lambda m: m.isNotNull())
        return ready.select(
            *df.columns, _fits_object(self, F.col(value), found).alias(fits), broken.alias(messages)
        )


# JSON schema

_NUMBER_RULES = {"minimum": "ge", "maximum": "le", "exclusiveMinimum": "gt", "exclusiveMaximum": "lt", "multipleOf": "multiple_of"}
# The rules of each type: JSON-schema keyword and field.
_RULES = {
    "string": {"minLength": "min_length", "maxLength": "max_length", "pattern": "pattern", "format": "format"},
    "number": _NUMBER_RULES,
    "integer": _NUMBER_RULES,
    "array": {"minItems": "min_length", "maxItems": "max_length", "uniqueItems": "unique"},
    "boolean": {},
    "object": {},
    "any": {},
    "union": {},
}
# The formats of texts that are checked.
FORMATS = {
    "date": r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$",
    "date-time": r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])[Tt ]([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d+)?)?([Zz]|[+-]\d{2}:?\d{2})?$",
    "email": r"^[^\s@]+@[^\s@]+\.[^\s@]+$",
    "uuid": r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    "uri": r"^[A-Za-z][A-Za-z0-9+.-]*:\S+$",
}
# Keywords that name or explain, and those that the compiler reads itself.
_NOTES = {"title", "description", "default", "examples", "$defs", "$schema", "$id", "deprecated", "readOnly", "writeOnly", "discriminator"}
_READ = {"type", "enum", "const", "anyOf", "oneOf", "$ref", "properties", "required", "additionalProperties", "items"}


def _field_schema(f: Field) -> dict:
    if f.type == "object" and f.members:
        schema = f.members.json_schema()
    elif f.type == "union":
        schema = {"anyOf": [_field_schema(o) for o in f.options]}
    else:
        schema = {} if f.type == "any" else {"type": f.type}
    if f.items:
        schema["items"] = _field_schema(f.items)
    if f.enum:
        schema["enum"] = list(f.enum)
    for keyword, attribute in _RULES[f.type].items():
        if (bound := getattr(f, attribute)) not in (None, False):
            schema[keyword] = bound
    if f.nullable:
        schema = {"anyOf": [*(schema["anyOf"] if f.type == "union" else [schema]), {"type": "null"}]}
    if f.description:
        schema["description"] = f.description
    if not f.required and f.default is not None:
        schema["default"] = f.default
    return schema


def _map_schema(schema: object, change: Callable[[dict], dict]) -> object:
    """Rebuild a JSON schema with ``change`` applied to each subschema, inner ones first."""
    if not isinstance(schema, dict):
        return schema
    rebuilt = {}
    for key, value in schema.items():
        if key in ("properties", "$defs") and isinstance(value, dict):
            value = {name: _map_schema(sub, change) for name, sub in value.items()}
        elif key in ("anyOf", "oneOf", "allOf") and isinstance(value, list):
            value = [_map_schema(sub, change) for sub in value]
        elif key in ("items", "additionalProperties"):
            value = _map_schema(value, change)
        rebuilt[key] = value
    return change(rebuilt)


def strict_json_schema(schema: dict) -> dict:
    """Every object closed, every property required."""

    def close(s: dict) -> dict:
        if s.get("type") == "object" or "properties" in s:
            s = {**s, "additionalProperties": False}
            if s.get("properties"):
                s["required"] = list(s["properties"])
        return s

    return _map_schema(schema, close)


def sanitise_json_schema(schema: dict) -> dict:
    """The schema without the unsupported keywords."""
    return _map_schema(schema, lambda s: {k: v for k, v in s.items() if k not in UNSUPPORTED_KEYWORDS})


def _kind_of_values(values: tuple) -> str:
    """The type of enumerated values where a schema names none."""
    kinds = {"boolean" if isinstance(v, bool) else "string" if isinstance(v, str) else "number" for v in values}
    if len(kinds) > 1:
        raise ValueError(f"values of several types: {values}")
    return next(iter(kinds), "any")


def contract_from_json_schema(schema: dict, name: str | None = None) -> Contract:
    """A contract from a JSON schema with ``$defs`` references and unions.

    A keyword that is not enforced is an error, never left out in silence, as
    is a schema that refers to itself; ``SchemaContract`` takes those.
    """
    defs = schema.get("$defs", {})
    open_: list[str] = []

    def follow(s: dict) -> dict:
        seen = []
        while "$ref" in s:
            if set(s) - _NOTES - {"$ref"}:
                raise ValueError(f"{sorted(set(s) - _NOTES - {'$ref'})} beside a reference is not supported")
            if s["$ref"] in open_ or s["$ref"] in seen:
                raise ValueError(f"{s['$ref']} refers to itself, which is not supported")
            seen.append(s["$ref"])
            s = defs[s["$ref"].rsplit("/", 1)[-1]]
        return s

    def as_field(key: str, s: dict, required: bool) -> Field:
        solid = follow(s)
        # What a field refers to is open while its parts are read.
        open_.append(s.get("$ref", ""))
        try:
            return made_field(key, solid, s.get("default"), required)
        finally:
            open_.pop()

    def made_field(key: str, s: dict, default: object, required: bool) -> Field:
        if isinstance(s.get("type"), list):
            s = {"anyOf": [{**{k: v for k, v in s.items() if k != "type"}, "type": t} for t in s["type"]]}
        choices = [follow(c) for c in s.get("anyOf") or s.get("oneOf") or []]
        beside = set(s) - _NOTES - {"anyOf", "oneOf"}
        if choices and beside:
            raise ValueError(f"{key}: {sorted(beside)} beside a union is not supported")
        nullable = any(c.get("type") == "null" for c in choices)
        solid = [c for c in choices if c.get("type") != "null"]
        common = {"default": _REQUIRED if required else default, "nullable": nullable}
        if len(solid) > 1 and "oneOf" in s and "discriminator" not in s:
            raise ValueError(f"{key}: exactly one of several is not supported")
        if len(solid) > 1:
            return Field(key, "union", options=tuple(as_field("", c, True) for c in solid), **common)
        s = solid[0] if solid else s
        enum = tuple(s["enum"] if "enum" in s else [s["const"]] if "const" in s else [])
        kind_name = s.get("type") or _kind_of_values(enum)
        if kind_name not in _RULES:
            raise ValueError(f"{key}: type {kind_name} is not supported")
        if enum and kind_name in ("array", "object"):
            raise ValueError(f"{key}: enumerated values of type {kind_name} are not supported")
        if isinstance(s.get("additionalProperties"), dict):
            raise ValueError(f"{key}: typed additionalProperties is not supported")
        unknown = set(s) - _NOTES - _READ - set(_RULES[kind_name])
        if unknown or s.get("format", "date") not in FORMATS:
            raise ValueError(f"{key}: {sorted(unknown) or s['format']} is not supported for {kind_name}")
        return Field(
            key,
            kind_name,
            enum=enum,
            items=as_field("", s["items"], True) if s.get("items") else None,
            members=as_contract(s, key) if kind_name == "object" and "properties" in s else None,
            **common,
            **{attribute: s[keyword] for keyword, attribute in _RULES[kind_name].items() if keyword in s},
        )

    def as_contract(s: dict, title: str) -> Contract:
        unknown = set(s) - _NOTES - _READ
        if unknown or isinstance(s.get("additionalProperties"), dict):
            raise ValueError(f"{title}: {sorted(unknown) or 'typed additionalProperties'} is not supported")
        required = s.get("required", [])
        fields = tuple(as_field(k, p, k in required) for k, p in s.get("properties", {}).items())
        return Contract(s.get("title", title), fields, s.get("additionalProperties") is False)

    top = as_contract(follow(schema), "Answer")
    return Contract(name or top.name, top.fields, top.forbid_extra)


# Checks on variants. A test is true, or false where the value does not fit.


def _scalar_fits(f: Field, value: Column, kind_of: Column) -> Column:
    is_text, is_boolean = kind_of == "STRING", kind_of == "BOOLEAN"
    is_number = kind_of.startswith("BIGINT") | kind_of.startswith("D")  # DECIMAL or DOUBLE
    if f.type == "string":
        text = as_string(value)
        ok = is_text
        if f.enum:
            ok = ok & text.isin(list(f.enum))
        if f.min_length is not None:
            ok = ok & (F.length(text) >= f.min_length)
        if f.max_length is not None:
            ok = ok & (F.length(text) <= f.max_length)
        for pattern in (f.pattern, FORMATS.get(f.format)):
            if pattern is not None:
                ok = ok & text.rlike(pattern)
        return ok
    if f.type == "boolean" and f.enum:
        return is_boolean & F.try_variant_get(value, "$", "boolean").isin(list(f.enum))
    if f.type == "boolean":
        text_ok = F.lower(as_string(value)).isin(BOOLEAN_TEXTS)
        number_ok = F.try_variant_get(value, "$", "double").isin([0.0, 1.0])
        return is_boolean | (is_text & text_ok) | (is_number & number_ok)
    # Lax number: numbers, booleans and number texts.
    as_number = F.try_variant_get(value, "$", "double")
    number = F.when(is_text, to_double(strip(as_string(value)))).otherwise(as_number)
    ok = (is_number | is_text | is_boolean) & number.isNotNull()
    if f.type == "integer":
        whole = F.when(
            is_text, strip(as_string(value)).rlike(r"^[+-]?\d+(_\d+)*(\.0+)?$")
        ).otherwise(number % 1 == 0)
        ok = ok & whole
    if f.enum:
        # Enumerated numbers are not read from texts or booleans.
        ok = ok & is_number & number.isin([float(v) for v in f.enum])
    if f.multiple_of is not None:
        times = number / F.lit(float(f.multiple_of))
        ok = ok & (F.abs(times - F.rint(times)) < 1e-9)
    if f.ge is not None:
        ok = ok & (number >= F.lit(float(f.ge)))
    if f.gt is not None:
        ok = ok & (number > F.lit(float(f.gt)))
    if f.lt is not None:
        ok = ok & (number < F.lit(float(f.lt)))
    if f.le is not None:
        # NaN is above every number, so it fails an upper bound but has to be refused by a lower one.
        ok = ok & (number <= F.lit(float(f.le)))
    if (f.ge is not None or f.gt is not None) and f.le is None and f.lt is None:
        ok = ok & ~F.isnan(number)
    return ok


def _fits(f: Field, value: Column, kind_of: Column | None = None) -> Column:
    """Whether a present value fits the field; never null."""
    kind_of = kind(value) if kind_of is None else kind_of
    if f.type == "any":
        ok = F.lit(True)
    elif f.type == "array":
        elements = F.try_variant_get(value, "$", "array<variant>")
        ok = kind_of.startswith("ARRAY")
        if f.items is not None:
            ok = ok & F.forall(elements, lambda e: _fits(f.items, e))
        if f.min_length is not None:
            ok = ok & (F.size(elements) >= f.min_length)
        if f.max_length is not None:
            ok = ok & (F.size(elements) <= f.max_length)
        if f.unique:
            ok = ok & (F.size(F.array_distinct(F.transform(elements, lambda e: F.to_json(e)))) == F.size(elements))
    elif f.type == "union":
        ok = reduce(lambda a, b: a | b, [_fits(o, value, kind_of) for o in f.options])
    elif f.type == "object":
        ok = _fits_object(f.members, value) if f.members else kind_of.startswith("OBJECT")
    else:
        ok = _scalar_fits(f, value, kind_of)
    null_ok = F.lit(f.nullable or f.type == "any")
    return F.coalesce(F.when(kind_of == "VOID", null_ok).otherwise(ok), F.lit(False))


def _unknown_keys(contract: Contract, value: Column) -> Column:
    known = F.array(*[F.lit(n) for n in contract.names]).cast("array<string>")
    return F.array_except(keys_of(value), known)


@dataclass(frozen=True)
class _Member:
    field: Field
    value: Column
    kind_of: Column | None = None


def _fits_object(contract: Contract, value: Column, members: list[_Member] | None = None) -> Column:
    if members is None:
        members = [_Member(f, member(value, f.name)) for f in contract.fields]
    ok = kind(value).startswith("OBJECT")
    for m in members:
        present = _fits(m.field, m.value, m.kind_of)
        ok = ok & F.when(m.value.isNull(), F.lit(not m.field.required)).otherwise(present)
    if contract.forbid_extra:
        ok = ok & (F.size(_unknown_keys(contract, value)) == 0)
    return F.coalesce(ok, F.lit(False))


def _expectation(f: Field) -> str:
    limits = [f"in {list(f.enum)}"] if f.enum else []
    signs = ((">=", f.ge), ("<=", f.le), (">", f.gt), ("<", f.lt), ("multiple of", f.multiple_of))
    signs += (("length >=", f.min_length), ("length <=", f.max_length), ("matching", f.pattern), ("as", f.format))
    limits += [f"{sign} {bound}" for sign, bound in signs if bound is not None]
    limits += ["unique"] if f.unique else []
    limits += [" or ".join(_expectation(o) for o in f.options)] if f.options else []
    return " ".join([f.type, *limits])


def _object_violations(contract: Contract, value: Column, members: list[_Member]) -> list[Column]:
    """Messages on an answer object and its members; null where the rule holds."""
    is_object = kind(value).startswith("OBJECT")
    found = [F.when(~is_object, F.lit("answer: not an object"))]
    if contract.forbid_extra:
        extra = _unknown_keys(contract, value)
        message = F.concat(F.lit("unknown keys: "), F.array_join(extra, ", "))
        found.append(F.when(is_object & (F.size(extra) > 0), message))
    for m in members:
        missing = F.lit(f"{m.field.name}: missing" if m.field.required else None).cast("string")
        wrong = F.lit(f"{m.field.name}: expected {_expectation(m.field)}")
        bad = F.when(m.value.isNull(), missing).when(~_fits(m.field, m.value, m.kind_of), wrong)
        found.append(F.when(is_object, bad))
    return found


# Contracts of the two built-in recipes.

_TEXTS = Field("", "string")

SPAM_CONTRACT = Contract(
    "SpamAnswer",
    (
        Field("classification", "string", enum=("spam", "ham")),
        Field("confidence", "number", ge=0.0, le=1.0),
        Field("reason", "string", min_length=1),
        Field("indicators", "array", default=(), items=_TEXTS),
        Field("suspicious_urls", "array", default=(), items=_TEXTS),
        Field("sender_analysis", "string", default=""),
    ),
)

_PII_CATEGORY = Contract(
    "PiiCategory",
    (
        Field("category", "string"),
        Field("count", "integer", ge=0),
        Field("examples", "array", default=(), items=_TEXTS),
        Field("gdpr_article", "string", default=""),
    ),
)

PII_CONTRACT = Contract(
    "PiiAnswer",
    (
        Field("contains_pii", "boolean"),
        Field("sensitivity_level", "string"),
        Field("confidence", "number", ge=0.0, le=1.0),
        Field("pii_categories", "array", default=(), items=Field("", "object", members=_PII_CATEGORY)),
        Field("reason", "string", min_length=1),
        Field("recommended_action", "string", default=""),
    ),
)
