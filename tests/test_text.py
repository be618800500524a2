import json
import random

from pyspark.sql import functions as F

from promptframe.functions import text as X
from promptframe.functions.answers import parse_whole
from promptframe.functions.html import tree_text
from promptframe.functions.numbers import round_exact, to_double

SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace()]


def test_strip_removes_what_python_strips(column):
    texts = ["", "  a  ", "\xa0a　", "\t\n a b \x1c", "a", "   "] + [s + "x" + s for s in SPACES]
    assert column(texts, X.strip("x")) == [t.strip() for t in texts]


def test_squeeze_whitespace(column):
    texts = ["line1\n\n\n\n\nline2\n\n\n\nline3", "a \t\xa0 b\n c", "  \n\n\n x \n\n", "a\n\nb"]
    want = ["line1\n\nline2\n\nline3", "a b\n c", "x", "a\n\nb"]
    assert column(texts, X.squeeze_whitespace("x")) == want


def test_clean_xml_drops_controls_and_emoji(column):
    assert column(["a\x07b\x0bc\t\n\r퟿é�\U0001f600￿"], X.clean_xml("x")) == [
        "abc\t\n\r퟿é�"
    ]


def test_token_estimate(column):
    assert column(["", "x" * 400, "abc", "x" * 7], X.token_estimate("x")) == [1, 100, 1, 1]


def test_html_to_text(column):
    page = "<html><head><title>T</title></head><body><script>var a='<p>'</script><p>Hi &amp; <b>you</b></p></body></html>"
    assert column(["<p>a</p>\n <br/> b"], X.html_to_text_basic("x")) == ["a b"]
    assert [p for p in tree_text(page).split("\n") if p.strip()] == ["Hi & ", "you"]


def test_suffix(column):
    names = ["a.EML", "noext", ".hidden", "a.b.txt", "x.4d456", "dot."]
    assert column(names, X.suffix("x")) == [".eml", "", "", ".txt", ".4d456", ""]


def test_json_quote(column):
    texts = ['a"b\\c\n', "é", ""]
    assert [json.loads(q) for q in column(texts, X.json_quote("x"))] == texts


def test_parse_whole_accepts_one_json_value_only(column):
    texts = ['{"a":1}', '{"a":1} x', '{"a":1}] x', "1,2", "", "[1]", "null", '"s"', "{a:1}", '{"a":1}\n```', "tru", " 3 "]

    def is_json(t):
        try:
            json.loads(t)
            return True
        except ValueError:
            return False

    assert column(texts, parse_whole("x").isNotNull()) == [is_json(t) for t in texts]


def test_repeated_key_keeps_last(column):
    assert column(['{"a":1,"a":2}'], F.to_json(parse_whole("x"))) == ['{"a":2}']


def test_to_double_takes_number_texts_only(column):
    texts = ["0.9", "1e3", "0.9f", "1d", "", "x", "+.5", "5.", "1_000", "0x1p3", "inf", "-Infinity"]

    def number(t):
        try:
            return float(t)
        except ValueError:
            return None

    assert column(texts, to_double(F.col("x"))) == [number(t) for t in texts]


def test_round_exact_is_python_round(spark):
    rng = random.Random(3)
    values = [rng.random() * 10 ** rng.randint(-6, 6) for _ in range(3000)]
    values += [k / 128 for k in range(-300, 300)] + [n / 10**7 for n in range(5, 4000, 10)] + [0.285, 2.675, 1.0, 0.0, -0.5]
    frame = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    for digits in (2, 4, 6):
        got = dict(frame.select("i", round_exact(F.col("v"), digits)).collect())
        assert [got[i] for i in range(len(values))] == [round(v, digits) for v in values]
