import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from traitrank.functions import (
    collection_label,
    fallback_text,
    first_truthy,
    hex_to_decimal,
    numeric_order,
    odds_score,
    parse_token_id,
    stringify_or_null,
    variant_at,
)

BATCH = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def evaluate(spark, values, expression, kind="string"):
    """``expression`` of column v for each value, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r["x"] for r in df.select("i", expression.alias("x")).orderBy("i").collect()]


def test_token_id_edges(spark):
    expected = {
        "0x1f": "31",
        "0X1f": None,
        "007": "7",
        " 7 ": "7",
        "-3": "-3",
        "+5": "5",
        "+-5": None,
        "-0": "0",
        "0x": None,
        "": None,
        "0": "0",
        "abc": None,
        "1.5": None,
        "1_0": None,
        "９": None,
        " 0x1f": None,
        "0x1F\t": "31",
        "0x" + "0" * 70: "0",
        "0x" + "f" * 64: str(2**256 - 1),
        "9" * 90: "9" * 90,
        "12\u0085": "12",
        "12\u2028": "12",
        "\u200712\u2029\n": "12",
        "0xff\u2029": "255",
        "12\u200b": None,
    }
    got = evaluate(spark, list(expected), parse_token_id(F.col("v")))
    assert dict(zip(expected, got)) == expected
    assert evaluate(spark, [None], parse_token_id(F.col("v"))) == [None]


@BATCH
@given(st.lists(st.integers(0, 2**300), min_size=30, max_size=60))
def test_hex_is_exact_at_any_width(spark, numbers):
    got = evaluate(spark, [f"{n:x}" for n in numbers], hex_to_decimal(F.col("v")))
    assert got == [str(n) for n in numbers]


@BATCH
@given(st.lists(st.integers(-(2**260), 2**260), min_size=30, max_size=60))
def test_numeric_order(spark, numbers):
    df = spark.createDataFrame([(str(n),) for n in numbers], "v string")
    got = [r["v"] for r in df.orderBy(*numeric_order(F.col("v"))).collect()]
    assert got == [str(n) for n in sorted(numbers)]


def stringified(spark, texts):
    parsed = F.try_parse_json(F.concat(F.lit('{"value":'), F.col("v"), F.lit("}")))
    return evaluate(spark, texts, stringify_or_null(variant_at(parsed, "$.value")))


def python_text(text):
    value = json.loads(text)
    return str(value) if value else None


def test_stringify_edges(spark):
    texts = (
        ["0", "0.0", "-0.0", "0e5", "false", '""', "[]", "{}", "null"]
        + ['"0"', '"false"', '"x"', '"a\\nb"', '"\\u00e9"', "true", "1", "-5", "1.0", "1.50", "100.00"]
        + ["1e3", "1E3", "1e15", "1e16", "1e22", "0.0001", "0.00001", "-1.5e-7", "12345678.5"]
        + ["9223372036854775807", "9223372036854775808", "123456789012345678901234567890"]
        + ["1e400", "-1e400", "1e-400", "0.001", "9999999.0", "10000000.0"]
    )
    assert stringified(spark, texts) == [python_text(t) for t in texts]


def test_stringify_nested_is_json(spark):
    assert stringified(spark, ["[1, 2]", '{"a": "b"}', "[0]"]) == ["[1,2]", '{"a":"b"}', "[0]"]


@BATCH
@given(st.lists(st.floats(-1e15, 1e15).filter(lambda x: abs(x) > 1e-300), min_size=20, max_size=50))
def test_stringify_floats(spark, numbers):
    got = stringified(spark, [repr(x) for x in numbers])
    # The JVM's digits may be one longer than the shortest, never another number.
    assert [float(g) for g in got] == numbers
    assert sum(g != repr(x) for g, x in zip(got, numbers)) <= len(numbers) // 5


@pytest.mark.parametrize(
    "body, expected",
    [
        ('{"a": {"n": ""}, "b": {"n": 0}, "c": "t"}', "t"),
        ('{"a": {"n": "x"}, "b": {"n": "y"}}', "x"),
        ('{"a": "text", "b": null, "c": false}', ""),
        ('{"a": {"n": []}, "b": {"n": true}}', "True"),
    ],
)
def test_first_truthy(spark, body, expected):
    record = F.try_parse_json("v")
    text = first_truthy(
        variant_at(record, "$.a.n"), variant_at(record, "$.b.n"), variant_at(record, "$.c")
    )
    assert evaluate(spark, [body], text) == [expected]


def test_fallback_text(spark):
    df = spark.createDataFrame([(None, "", "z"), (None, None, ""), ("a", "b", "c")], "a string, b string, c string")
    got = [r[0] for r in df.select(fallback_text(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert sorted(got) == ["", "a", "z"]


@pytest.mark.parametrize("n, total, score", [(29, 129, 28), (5, 5, 0), (1, 201, 0), (3, 7, 75), (3, 4, 300)])
def test_odds_score(spark, n, total, score):
    df = spark.createDataFrame([(n, total)], "n bigint, t bigint")
    assert df.select(odds_score(F.col("n"), F.col("t"))).first()[0] == score
    assert score == (0 if n == total else int(n / (total - n) * 100))


def test_collection_label(spark):
    assert evaluate(spark, ["0xBd3531dA5CF5"], collection_label(F.col("v"))) == ["collection_0xbd3531"]
