import json
from typing import Any, Literal, Optional

import pytest
from pyspark.sql import functions as F

from promptframe.functions.answers import parse_whole
from promptframe.operators.contract import (
    PII_CONTRACT,
    SPAM_CONTRACT,
    Contract,
    Field,
    contract_from_json_schema,
    sanitise_json_schema,
    strict_json_schema,
)

SCALARS = [
    "0.9", '"0.9"', '" 0.9 "', "true", "false", "1", "0", "2", "3.0", "3.5", '"3"', '"3.0"', '"3.5"', '" 3 "', '"yes"',
    '"YES"', '"on"', '"maybe"', '""', '" "', '"spam"', "null", "[]", "[1]", '["a"]', "{}", '{"a":1}', "1e3", "1.5e0",
    "-1", '"-1"', '"1_000"', '"nan"', '"NaN"', '"inf"', "1.0", "0.0", "-0.0", '"T"', '"1"', '"2"', '"0.9f"', "1e400",
    "12345678901234567890", '"12345678901234567890"', '"+5"', '"5."', '".5"', '"1e2"',
]


def accepted(spark, contract, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    parsed = frame.select("i", parse_whole("t").alias("v"))
    rows = parsed.select("i", contract.accepts(F.col("v")), contract.violations(F.col("v"))).collect()
    for _, ok, messages in rows:
        assert ok == (not messages)
    return [ok for _, ok, _ in sorted(rows)]


def pydantic_accepts(model, texts):
    out = []
    for t in texts:
        try:
            model.model_validate(json.loads(t))
            out.append(True)
        except Exception:
            out.append(False)
    return out


def test_scalar_rules_equal_pydantic(spark):
    pydantic = pytest.importorskip("pydantic")
    config = pydantic.ConfigDict(extra="forbid")
    kinds = {
        "string": (str, Field("v", "string")),
        "filled": (pydantic.constr(min_length=1), Field("v", "string", min_length=1)),
        "number": (float, Field("v", "number")),
        "bounded": (pydantic.confloat(ge=0, le=1), Field("v", "number", ge=0, le=1)),
        "at_least": (pydantic.confloat(ge=0), Field("v", "number", ge=0)),
        "integer": (int, Field("v", "integer")),
        "count": (pydantic.conint(ge=0), Field("v", "integer", ge=0)),
        "boolean": (bool, Field("v", "boolean")),
        "enum": (Literal["spam", "ham"], Field("v", "string", enum=("spam", "ham"))),
        "texts": (list[str], Field("v", "array", items=Field("", "string"))),
        "numbers": (list[float], Field("v", "array", items=Field("", "number"))),
        "maybe": (Optional[float], Field("v", "number", nullable=True)),
        "any": (Any, Field("v", "any")),
    }
    texts = [f'{{"v":{s}}}' for s in SCALARS] + ['{"v":["a",1]}', '{"v":[1,"2",true]}', "{}", "[]", "1", '{"v":1,"w":2}']
    for name, (kind, field) in kinds.items():
        model = pydantic.create_model("M", __config__=config, v=(kind, ...))
        want = pydantic_accepts(model, texts)
        got = accepted(spark, Contract("M", (field,)), texts)
        assert [t for t, g, w in zip(texts, got, want) if g != w] == [], name


def test_nested_contract_and_defaults(spark):
    good = {"contains_pii": True, "sensitivity_level": "low", "confidence": 0.5, "reason": "r"}
    category = {"category": "email", "count": 2, "examples": ["a"]}
    cases = [
        (good, True),
        ({**good, "pii_categories": [category, category]}, True),
        ({**good, "pii_categories": [{**category, "count": -1}]}, False),
        ({**good, "pii_categories": [{**category, "more": 1}]}, False),
        ({**good, "pii_categories": [{"count": 1}]}, False),
        ({**good, "pii_categories": None}, False),
        ({**good, "reason": ""}, False),
        ({k: v for k, v in good.items() if k != "confidence"}, False),
        ({**good, "other": 1}, False),
        ([good], False),
    ]
    assert accepted(spark, PII_CONTRACT, [json.dumps(c) for c, _ in cases]) == [ok for _, ok in cases]


def test_messages_name_every_violation(spark):
    frame = spark.createDataFrame([('{"classification":"x","confidence":2,"extra":1}',)], "t string")
    messages = frame.select(SPAM_CONTRACT.violations(parse_whole("t"))).head()[0]
    assert messages == [
        "unknown keys: extra",
        "classification: expected string in ['spam', 'ham']",
        "confidence: expected number >= 0.0 <= 1.0",
        "reason: missing",
    ]


def test_strict_schema_closes_every_object():
    schema = {
        "type": "object",
        "properties": {"a": {"type": "string"}, "b": {"type": "array", "items": {"$ref": "#/$defs/B"}}},
        "$defs": {"B": {"type": "object", "properties": {"c": {"type": "integer"}}}},
        "anyOf": [{"type": "object", "properties": {"d": {}}}],
    }
    strict = strict_json_schema(schema)
    assert strict["required"] == ["a", "b"] and strict["additionalProperties"] is False
    assert strict["$defs"]["B"]["required"] == ["c"] and strict["$defs"]["B"]["additionalProperties"] is False
    assert strict["anyOf"][0]["required"] == ["d"]
    assert "required" not in schema


def test_sanitised_schema_keeps_property_names():
    schema = {"type": "object", "properties": {"format": {"type": "number", "minimum": 0, "maximum": 1}}, "pattern": "x"}
    assert sanitise_json_schema(schema) == {"type": "object", "properties": {"format": {"type": "number"}}}


def test_text_format_block():
    block = SPAM_CONTRACT.text_format()["format"]
    assert block["type"] == "json_schema" and block["strict"] is True
    assert block["schema"]["required"] == SPAM_CONTRACT.names


def test_field_inference():
    def fields(*pairs):
        return Contract("c", tuple(Field(n, t, enum=e) for n, t, e in pairs))

    assert SPAM_CONTRACT.label_field() == "classification"
    assert fields(("label", "string", ()), ("kind", "string", ("a",))).label_field() == "kind"
    assert fields(("verdict", "string", ()), ("label", "string", ())).label_field() == "label"
    assert fields(("other", "string", ())).label_field() is None
    assert SPAM_CONTRACT.confidence_field() == "confidence"
    assert fields(("confidence", "string", ()), ("score", "number", ())).confidence_field() == "score"
    assert fields(("confidence", "string", ())).confidence_field() is None
    assert SPAM_CONTRACT.label_field("reason") == "reason"


def test_contract_from_pydantic_schema(spark):
    pydantic = pytest.importorskip("pydantic")

    class Item(pydantic.BaseModel):
        model_config = pydantic.ConfigDict(extra="forbid")
        name: str
        count: int = pydantic.Field(ge=0)

    class Answer(pydantic.BaseModel):
        label: Literal["a", "b"]
        note: Optional[str] = None
        items: list[Item] = []

    contract = contract_from_json_schema(Answer.model_json_schema())
    texts = [
        '{"label":"a"}', '{"label":"c"}', '{"label":"a","note":null,"free":1}', '{"label":"a","note":1}',
        '{"label":"b","items":[{"name":"x","count":"3"}]}', '{"label":"b","items":[{"name":"x","count":-3}]}',
        '{"label":"b","items":[{"name":"x","count":3,"z":1}]}',
    ]
    assert contract.name == "Answer" and not contract.forbid_extra
    assert accepted(spark, contract, texts) == pydantic_accepts(Answer, texts)


def test_every_rule_of_a_schema_equals_pydantic(spark):
    pydantic = pytest.importorskip("pydantic")
    schema = lambda rule: {"properties": {"v": rule}, "required": ["v"]}
    kinds = [
        ({"type": "number", "exclusiveMinimum": 0, "exclusiveMaximum": 1}, pydantic.confloat(gt=0, lt=1)),
        ({"type": "integer", "multipleOf": 2}, pydantic.conint(multiple_of=2)),
        ({"type": "string", "maxLength": 2}, pydantic.constr(max_length=2)),
        ({"type": "string", "pattern": "^[a-z]+$"}, pydantic.constr(pattern="^[a-z]+$")),
        ({"type": "array", "items": {"type": "string"}, "minItems": 1, "maxItems": 1}, pydantic.conlist(str, min_length=1, max_length=1)),
        ({"enum": [1, 2, 3]}, Literal[1, 2, 3]),
    ]
    texts = [f'{{"v":{x}}}' for x in SCALARS if x not in ('"nan"', '"NaN"')] + ['{"v":["a","b"]}']
    for rule, kind in kinds:
        model = pydantic.create_model("M", v=(kind, ...))
        own = texts if "enum" not in rule else [t for t in texts if t not in ('{"v":1.0}', '{"v":3.0}', '{"v":true}')]
        assert accepted(spark, contract_from_json_schema(schema(rule)), own) == pydantic_accepts(model, own), rule


def test_rules_that_are_not_enforced_are_errors():
    for rule in ({"type": "string", "contentEncoding": "x"}, {"type": "string", "format": "ipv4"}, {"allOf": [{"type": "string"}]},
                 {"anyOf": [{"type": "string"}, {"type": "integer"}], "minLength": 1}, {"type": "string", "minimum": 1}):
        with pytest.raises(ValueError, match="not supported"):
            contract_from_json_schema({"properties": {"v": rule}})


def test_forms_that_fields_cannot_hold_are_errors():
    text = {"Text": {"type": "string"}}
    part = {"Part": {"type": "object", "properties": {"parts": {"type": "array", "items": {"$ref": "#/$defs/Part"}}}}}
    two = [{"type": "integer"}, {"type": "string"}]
    for defs, rule in (
        (text, {"$ref": "#/$defs/Text", "minLength": 2}),
        ({}, {"type": "object", "additionalProperties": {"type": "integer"}}),
        ({}, {"type": "array", "enum": [[1]]}),
        ({}, {"oneOf": two}),
        (part, {"$ref": "#/$defs/Part"}),
        ({"A": {"$ref": "#/$defs/A"}}, {"$ref": "#/$defs/A"}),
    ):
        with pytest.raises(ValueError, match="not supported"):
            contract_from_json_schema({"$defs": defs, "properties": {"v": rule}})
    both = {"$defs": text, "properties": {"a": {"$ref": "#/$defs/Text"}, "b": {"$ref": "#/$defs/Text", "description": "again"}}}
    assert [f.type for f in contract_from_json_schema(both).fields] == ["string", "string"]


def test_array_bounds_keep_their_keywords():
    rule = {"type": "array", "items": {"type": "string"}, "minItems": 1, "maxItems": 3, "uniqueItems": True}
    made = contract_from_json_schema({"properties": {"v": rule}, "required": ["v"]}).json_schema()
    assert made["properties"]["v"] == rule
