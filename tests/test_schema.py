import json
from typing import Literal, Optional, Union

import pytest

from promptframe.functions.answers import parse_whole
from promptframe.operators import validate
from promptframe.operators.schema import SchemaContract, compile_schema, levels_of
from test_contract import SCALARS, pydantic_accepts

TREE = {
    "title": "Tree",
    "$ref": "#/$defs/Node",
    "$defs": {
        "Node": {
            "type": "object",
            "properties": {
                "name": {"type": "string", "minLength": 1},
                "children": {"type": "array", "items": {"$ref": "#/$defs/Node"}},
                "next": {"anyOf": [{"$ref": "#/$defs/Node"}, {"type": "null"}]},
            },
            "required": ["name"],
            "additionalProperties": False,
        }
    },
}


def checked(spark, schema, texts, lax=True):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", parse_whole("t").alias("v"))
    rows = SchemaContract(schema, lax=lax).check(frame, "v", "fits", "messages").collect()
    assert all(r.fits == (not r.messages) for r in rows)
    return [r.messages for r in sorted(rows, key=lambda r: r.i)]


def fits(spark, schema, texts, lax=True):
    return [not m for m in checked(spark, schema, texts, lax)]


def test_schemas_that_refer_to_themselves(spark):
    deep = {"name": "x"}
    for i in range(11):
        deep = {"name": f"n{i}", "children": [deep, {"name": "leaf"}]} if i % 2 else {"name": "m", "next": deep}
    broken = json.loads(json.dumps(deep).replace('"name": "x"', '"name": ""'))
    texts = [
        '{"name":"a"}', '{"name":"a","children":[{"name":"b","children":[]}]}', '{"name":"a","children":[{"name":""}]}',
        '{"name":"a","children":[{"name":"b","other":1}]}', '{"name":"a","next":null}', '{"name":"a","next":{"next":null}}', "[]",
        json.dumps(deep), json.dumps(broken), '{"name":"a","children":{"name":"b"}}', '{"children":[{},{"name":"{[\\"{{"}]}',
    ]
    found = checked(spark, TREE, texts)
    assert [not m for m in found] == [True, True, False, False, True, False, False, True, False, False, False]
    assert found[2] == ["children[0].name: expected string minLength 1"]
    assert found[3] == ["children[0].other: expected nothing here"]
    assert found[6] == ["answer: expected object"]
    assert sorted(found[10]) == ["children[0].name: missing", "name: missing"]


def test_recursive_models_equal_pydantic(spark):
    pydantic = pytest.importorskip("pydantic")

    class Node(pydantic.BaseModel):
        model_config = pydantic.ConfigDict(extra="forbid")
        kind: Literal["a", "b"]
        weight: float = pydantic.Field(default=1.0, ge=0)
        parts: list["Node"] = []
        by_name: dict[str, "Node"] = {}
        partner: Optional["Node"] = None
        either: Union[int, list[str], None] = None

    leaf = '{"kind":"a"}'
    texts = [
        leaf, '{"kind":"c"}', '{"kind":"b","weight":"2"}', '{"kind":"b","weight":-1}', f'{{"kind":"a","parts":[{leaf},{leaf}]}}',
        f'{{"kind":"a","parts":[{leaf},1]}}', f'{{"kind":"a","by_name":{{"x":{leaf},"y":{leaf}}}}}', '{"kind":"a","by_name":{"x":{}}}',
        f'{{"kind":"a","partner":{{"kind":"b","partner":{leaf}}}}}', '{"kind":"a","partner":{"kind":"b","partner":{"kind":"z"}}}',
        '{"kind":"a","either":3}', '{"kind":"a","either":"3"}', '{"kind":"a","either":["x"]}', '{"kind":"a","either":[1]}',
        '{"kind":"a","either":null}', '{"kind":"a","more":1}', "null", '"a"',
    ]
    assert fits(spark, Node.model_json_schema(), texts) == pydantic_accepts(Node, texts)


def test_scalars_equal_pydantic(spark):
    pydantic = pytest.importorskip("pydantic")
    kinds = [
        float, int, bool, str, pydantic.confloat(ge=0, le=1), pydantic.confloat(gt=0, lt=1), pydantic.conint(multiple_of=2),
        pydantic.constr(min_length=1, max_length=3), pydantic.constr(pattern="^[a-z]+$"), Optional[float], list[str], list[float],
        dict[str, int], Literal["spam", "ham"],
    ]
    texts = [f'{{"v":{x}}}' for x in SCALARS if x not in ('"nan"', '"NaN"')] + ['{"v":["a","b"]}', '{"v":{"a":"x"}}', "{}"]
    for kind in kinds:
        model = pydantic.create_model("M", v=(kind, ...))
        got, want = fits(spark, model.model_json_schema(), texts), pydantic_accepts(model, texts)
        assert [t for t, g, w in zip(texts, got, want) if g != w] == [], kind


def test_forms_that_were_lost(spark):
    schema = {
        "$defs": {"Text": {"type": "string"}},
        "properties": {
            "long": {"$ref": "#/$defs/Text", "minLength": 3},
            "counts": {"type": "object", "additionalProperties": {"type": "integer"}},
            "pair": {"type": "array", "enum": [["a", "b"], []]},
            "both": {"allOf": [{"type": "string"}, {"pattern": "^x"}, {"maxLength": 3}]},
            "one": {"oneOf": [{"type": "integer", "multipleOf": 2}, {"type": "integer", "multipleOf": 3}]},
            "odd": {"type": "integer", "not": {"multipleOf": 2}},
            "place": {"prefixItems": [{"type": "string"}, {"type": "number"}], "items": False},
            "never": False,
        },
    }
    cases = [
        ("long", '"abc"', True), ("long", '"ab"', False), ("long", "7", False), ("counts", '{"a":1,"b":2}', True),
        ("counts", '{"a":1,"b":"x"}', False), ("pair", '["a","b"]', True), ("pair", '["a"]', False), ("pair", "[]", True),
        ("both", '"xa"', True), ("both", '"ax"', False), ("both", '"xabc"', False), ("one", "4", True), ("one", "9", True),
        ("one", "12", False), ("one", "5", False), ("odd", "3", True), ("odd", "4", False), ("place", '["a",1]', True),
        ("place", '["a",1,2]', False), ("place", "[1,1]", False), ("place", '["a"]', True), ("never", "null", False), ("free", "1", True),
    ]
    got = fits(spark, schema, [f'{{"{k}":{v}}}' for k, v, _ in cases], lax=False)
    assert [c for c, g in zip(cases, got) if g != c[2]] == []


def test_strict_types(spark):
    schema = {"properties": {"n": {"type": "number"}, "b": {"type": "boolean"}, "i": {"type": "integer", "minimum": 1}}}
    texts = ['{"n":1.5}', '{"n":"1.5"}', '{"b":true}', '{"b":"yes"}', '{"b":1}', '{"i":2.0}', '{"i":"2"}', '{"i":0}']
    assert fits(spark, schema, texts, lax=False) == [True, False, True, False, False, True, False, False]


def test_states(spark):
    states, root = compile_schema(TREE)
    assert levels_of(states, root) is None and len(states) < 12
    flat, root = compile_schema({"properties": {"a": {"items": {"type": "string"}}}})
    assert levels_of(flat, root) == 3
    for bad in ({"$ref": "#"}, {"properties": {"a": {"contains": {}}}}, {"type": "set"}, {"$ref": "other.json"}, {"format": "ipv4"}, {"allOf": [{"$ref": "#"}]}):
        with pytest.raises(ValueError):
            SchemaContract(bad)


def test_schema_contract_in_validation(spark):
    contract = SchemaContract({"properties": {"label": {"type": "string", "enum": ["a"]}, "score": {"type": "number"}}, "required": ["label"]})
    assert (contract.label_field(), contract.confidence_field()) == ("label", "score")
    assert contract.text_format()["format"]["schema"]["required"] == ["label", "score"]
    rows = [("1", None, '{"label":"a"}', False), ("2", None, '{"label":"b"}', False), ("3", "e", None, False), ("4", None, "{", False)]
    frame = spark.createDataFrame(rows, "custom_id string, error string, raw_text string, malformed boolean")
    found = {r.custom_id: (r.status, r.message) for r in validate.validate_outputs(frame, contract).collect()}
    assert found["1"] == ("valid", None) and found["3"][0] == "skipped"
    assert found["2"] == ("invalid", "Schema validation error: label: expected string in ['a']")
    assert found["4"] == ("invalid", "JSON parse error")
