from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import predicates, scalar
from millrace.operators.grouping import word_count


@pytest.fixture
def value(spark):
    def evaluate(column):
        return spark.range(1).select(column).first()[0]
    return evaluate


def test_case_label(spark, rows):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "id INT, value INT")
    labelled = df.withColumn("value_desc", scalar.label_values("value", {1: "one", 2: "two"}, "other"))
    assert rows(labelled) == [(1, 1, "one"), (2, 2, "two"), (3, 3, "other")]


def test_splits_and_padding(value):
    assert value(scalar.item_at(F.array(F.lit("a")), 1)) is None
    assert value(scalar.split_part(F.lit("-48.8712"), ".", 1)) == "8712"
    assert value(scalar.split_part(F.lit("48"), ".", 1)) is None
    assert value(scalar.split_once(F.lit("123 Main St"), " ", 1)) == "Main St"
    assert value(scalar.strip(F.lit(" \tx\n"))) == "x"
    assert [value(scalar.zero_pad(F.lit(n), 2)) for n in (4, 12, 123)] == ["04", "12", "123"]
    assert value(scalar.zero_pad(F.lit(None).cast("int"), 2)) is None
    assert value(scalar.join_all("-", F.lit("a"), F.lit("b"))) == "a-b"
    assert value(scalar.join_all("-", F.lit("a"), F.lit(None))) is None


def test_times(value):
    big = F.lit(1519516800)
    assert value(scalar.seconds_to_millis(big)) == 1519516800000
    assert value(scalar.millis_to_timestamp(scalar.seconds_to_millis(big)).cast("string")) == "2018-02-25 00:00:00"
    one = F.lit("2020-01-01 00:00:00").cast("timestamp")
    assert value(scalar.epoch_with_fallback(F.lit(None).cast("timestamp"), one)) == 1577836800
    assert value(scalar.months_before("2020-07-01", 12)) == date(2019, 7, 1)
    assert value(scalar.parse_datetime(F.lit("2019-05-12 08:51:07"))) == datetime(2019, 5, 12, 8, 51, 7)
    assert value(scalar.parse_datetime(F.lit("12.05.2019"))) is None
    assert value(scalar.date_path(one)) == "2020/01/01"


@pytest.mark.parametrize("text, expected", [
    ("06/29/2020", date(2020, 6, 29)), ("02/30/2021", date(2021, 2, 28)), ("04/31/2020", date(2020, 4, 30)),
    ("02/29/2020", date(2020, 2, 29)), ("13/01/2020", None), ("01/32/2020", None), ("01/00/2020", None),
    ("6/29/2020", None), ("2020-06-29", None), ("", None), (None, None),
])
def test_us_dates(value, text, expected):
    assert value(scalar.parse_us_date(F.lit(text).cast("string"))) == expected


def test_texts(value):
    assert value(scalar.ellipsize(F.lit("abcd"), 5)) == "abcd"
    assert value(scalar.ellipsize(F.lit("abcde"), 5)) == "abcde..."
    assert value(scalar.same_text(F.lit("AbC"), F.lit("aBc"))) is True
    assert value(scalar.null_if_token(F.lit("null"))) is None
    assert value(scalar.tags_to_map(F.array(F.lit("env:prod"), F.lit("url:a:b")))) == {"env": "prod", "url": "a:b"}


def test_grok(value):
    pattern = "%{TIMESTAMP_ISO8601:timestamp} %{LOGLEVEL:level} %{GREEDYDATA:message}"
    line = scalar.grok(F.lit("2024-01-02T03:04:05.678Z ERROR it broke\nbadly"), pattern)
    assert {k: value(c) for k, c in line.items()} == {
        "timestamp": "2024-01-02T03:04:05.678Z", "level": "ERROR", "message": "it broke\nbadly"}
    assert all(value(c) is None for c in scalar.grok(F.lit("no layout"), pattern).values())


def test_word_rules(spark, rows):
    lines = spark.createDataFrame([("a b  ",), ("a  b",), ("",), ("   ",), (" a",)], "value STRING")
    assert rows(word_count(lines)) == [("", 3), ("a", 3), ("b", 2)]


def test_strict_predicates(spark):
    df = spark.createDataFrame([(True, None), (False, 1), (None, None)], "flag BOOLEAN, n INT")
    assert df.filter(predicates.not_false("flag")).count() == 1
    assert df.filter(~predicates.all_equal({"flag": True, "n": None})).count() == 2


def test_search_terms(spark, rows):
    df = spark.createDataFrame([("python-app", "x"), ("y", "lambda"), ("y", None)], "service STRING, source STRING")
    either = predicates.has("service", "python-app") | predicates.has("source", "lambda")
    assert df.filter(either).count() == 2 and df.filter(~either).count() == 1


def test_event_pattern(spark, rows):
    pattern = {"source": ["jobs"], "detail-type": ["Change"], "detail": {"jobName": ["a", "b"], "state": ["SUCCEEDED"]}}
    good = '{"source":"jobs","detail-type":"Change","detail":{"jobName":"b","state":"SUCCEEDED","x":1}}'
    df = spark.createDataFrame([(1, good), (2, good.replace("SUCCEEDED", "FAILED")), (3, '{"source":"jobs"}'), (4, "x")],
                               "id INT, body STRING")
    assert rows(df.filter(predicates.json_event_matches("body", pattern)).select("id")) == [(1,)]


def test_dimensions(spark, rows):
    df = spark.createDataFrame([(1, {"a": "x", "b": "y"}), (2, {"a": "x"}), (3, None)], "id INT, d MAP<STRING, STRING>")
    assert rows(df.filter(predicates.dimensions_match("d", {"a": "x", "b": "y"})).select("id")) == [(1,)]
