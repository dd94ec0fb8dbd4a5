import pytest

from millrace.operators import joins
from millrace.plans import exports


def journeys(spark):
    return (spark.createDataFrame([(10, "eat healthy"), (20, "midfullness"), (30, "exercise")],
                                  "journeyid INT, journeyname STRING"),
            spark.createDataFrame([(1, "sam"), (2, "paul"), (3, "tim")], "memberid INT, name STRING"),
            spark.createDataFrame([(10, 1), (20, 2), (30, 3), (20, 1)], "journeyid INT, memberid INT"))


def test_three_table_export(spark, rows):
    journey, member, pairs = journeys(spark)
    out = exports.three_table_export(journey, member, pairs).select("journeyid", "name")
    assert rows(out) == [(10, "sam"), (20, "paul"), (20, "sam"), (30, "tim")]


def test_partial_key_join_fans_out(spark):
    journey, member, pairs = journeys(spark)
    first = joins.prefix_join(journey, pairs, "journeyid", "journeyid")
    second = joins.prefix_join(member, pairs, "memberid", "memberid")
    assert ".journeyid" in first.columns
    assert joins.prefix_join(first, second, "memberid", "memberid").count() == 6
    counts = joins.fanout_counts(first, second, ["memberid"])
    assert counts.groupBy().sum("joined_rows").first()[0] == 6


def test_prefix_join_keeps_both_sides(spark, rows):
    a = spark.createDataFrame([(1, "l", "old")], "id INT, name STRING, `.name` STRING")
    b = spark.createDataFrame([(1, "r")], "id INT, name STRING")
    out = joins.prefix_join(a, b, ["id"], ["id"])
    assert out.columns == [".id", "..name", ".name", "id", "name"]
    assert rows(out) == [(1, "l", "old", 1, "r")]


def test_merge_and_lists(spark, rows):
    source = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, v STRING")
    stage = spark.createDataFrame([("B", 2), ("C", 3)], "v STRING, id INT")
    merged = joins.merge_by_key(source, stage, ["id"])
    assert rows(merged.select("id", "v")) == [(1, "a"), (2, "B"), (3, "C")]
    repeated = stage.union(stage).select("id")
    assert rows(joins.in_list(source, repeated, "id")) == [(2, "b")]
    assert rows(joins.ref_check(source, stage, "id")) == [(1, "a")]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, rows, how):
    fact = spark.range(3000).selectExpr("IF(id % 3 = 0, 7, nullif(id % 40, 5)) AS k", "id AS n")
    other = spark.range(35).selectExpr("id AS k", "id * 10 AS v").union(spark.sql("SELECT 7L, 71L"))
    salted = joins.salted_join(fact, other, ["k"], ["n"], how=how, hot_rows=100)
    assert rows(salted.select("k", "n", "v")) == rows(fact.join(other, "k", how).select("k", "n", "v"))


def test_salted_join_refuses_right(spark):
    df = spark.range(1).selectExpr("id AS k")
    with pytest.raises(ValueError):
        joins.salted_join(df, df, ["k"], ["k"], how="right")
