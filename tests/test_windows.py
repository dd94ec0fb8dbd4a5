import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import windows


@pytest.mark.parametrize("hot_rows, block_rows", [(0, 1), (50, 7), (50, 1 << 20), (1 << 20, 7)])
def test_running_total_with_a_hot_key(spark, hot_rows, block_rows):
    rng = random.Random(3)
    data = [(1 if i % 3 == 0 else rng.randrange(20), i, rng.randrange(-50, 50)) for i in range(400)]
    opening = spark.createDataFrame([(1, 1000), (5, -3)], "k INT, opening INT")
    df = spark.createDataFrame(data, "k INT, seq INT, v INT")
    got = windows.running_total(df, "k", "seq", "v", opening=opening, hot_rows=hot_rows,
                                block_rows=block_rows)
    totals, expected = {1: 1000, 5: -3}, []
    for k, seq, v in data:
        totals[k] = totals.get(k, 0) + v
        expected.append((k, seq, v, totals[k]))
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_running_total_with_sparse_numbers(spark):
    rng = random.Random(6)
    numbers = sorted(rng.sample(range(1, 10**15), 600))
    df = spark.createDataFrame([("hot" if i % 3 else None, n, i) for i, n in enumerate(numbers)], "k STRING, seq BIGINT, v INT")
    got = windows.running_total(df, "k", "seq", "v", hot_rows=100, block_rows=50)
    totals, want = {}, []
    for r in df.collect():
        totals[r["k"]] = totals.get(r["k"], 0) + r["v"]
        want.append((r["k"], r["seq"], r["v"], totals[r["k"]]))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_running_total_keeps_rows_without_a_key(spark, rows):
    df = spark.createDataFrame([(None, 1, 5), (None, 9, 6), ("a", 2, 1)], "k STRING, seq INT, v INT")
    assert rows(windows.running_total(df, "k", "seq", "v", block_rows=4)) == [
        ("a", 2, 1, 1), (None, 1, 5, 5), (None, 9, 6, 11)]


def test_dense_ids(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("n"))
    got = windows.dense_ids(df, ["n"], start=100000, partitions=6).orderBy("n").collect()
    assert [(r["n"], r["id"]) for r in got] == [(n, 100000 + n) for n in range(1000)]


def test_last_write(spark, rows):
    df = spark.createDataFrame([(1, 1, "a", 1), (1, 1, "b", 3), (1, 1, "c", 2), (1, 2, None, 1)],
                               "pk INT, sk INT, v STRING, at INT")
    assert rows(windows.last_write(df, ["pk", "sk"], ["at"])) == [(1, 1, "b", 3), (1, 2, None, 1)]


def test_missing_breach_is_none(spark):
    df = spark.createDataFrame([("k", 0, True, 1), ("k", 1, None, 1), ("k", 2, True, 1), ("l", 0, None, 1), ("l", 1, True, 2)],
                               "k STRING, t INT, b BOOLEAN, n INT")
    flagged = windows.breached_in_row(df, ["k"], "t", "b", F.col("n")).orderBy("k", "t")
    assert [r["in_alarm"] for r in flagged.collect()] == [True, False, True, False, False]


def test_breaches_and_changes(spark):
    bits = [1, 1, 1, 0, 1, 1, 1, 1]
    df = spark.createDataFrame([("k", i, bool(b)) for i, b in enumerate(bits)], "k STRING, t INT, b BOOLEAN")
    flagged = windows.breached_in_row(df, ["k"], "t", "b", 3)
    assert [r["in_alarm"] for r in flagged.orderBy("t").collect()] == [
        False, False, True, False, False, False, True, True]
    states = flagged.withColumn("state", F.when(F.col("in_alarm"), "ALARM").otherwise("OK"))
    changes = windows.state_changes(states, ["k"], "t", "state").orderBy("t").collect()
    assert [(r["t"], r["state"]) for r in changes] == [(0, "OK"), (2, "ALARM"), (3, "OK"), (6, "ALARM")]
