"""Every registered query against its SQL, and properties of the plans that matter at scale."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from millrace.operators import ledger
from millrace.plans import feeds
from parity import ORACLE, QUERIES

from .test_feeds import star_tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, db, name):
    assert difference(spark, db, FOLDER, name) is None


def plan(spark, name):
    return entry.queries()[name](spark, FOLDER)._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["hh_list", "member_interactions", "validate_transfers", "alarm_states",
                                  "running_balance", "word_count", "three_table_export", "fanout_join"])
def test_no_cross_join_and_no_one_task_window(spark, name):
    physical = plan(spark, name).split("== Physical Plan ==")[1]
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical
    assert "Exchange SinglePartition" not in physical


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    stored = {}
    for name, df in star_tables(spark).items():
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    text = feeds.item_list(**stored)._jdf.queryExecution().toString()
    for pushed in ("EqualTo(status,Published)", "Not(EqualTo(hide_on_healthy_habits,true))",
                   "EqualTo(manually_entered,true)"):
        assert pushed in text
    scans = [line for line in text.splitlines() if "ReadSchema" in line]
    assert len(scans) == 4 and not any("title" in line or "color" in line for line in scans)


def test_member_join_is_inner(spark):
    assert "LeftOuter" not in plan(spark, "member_interactions").split("== Physical Plan ==")[1]


@pytest.mark.parametrize("name, early", [("word_count", "partial_count"), ("avg_by_facet", "partial_sum"),
                                         ("apdex_by_user", "partial_count"), ("last_write_wins", "row_number(), 1, Partial")])
def test_rows_are_combined_before_the_shuffle(spark, name, early):
    physical = plan(spark, name).split("== Physical Plan ==")[1]
    assert early in physical[physical.index("Exchange"):]


@pytest.fixture(name="small_skew")
def small_skew_settings(spark):
    """Settings under which the test tables are large enough to be split as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
        # A shuffle that one task writes cannot be split: the first join must not be merged to one.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1000",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_join_keys_are_split(spark, tmp_path, small_skew):
    """Member 7 has most of the activities; the join on members reads its partition in pieces."""
    rows = spark.range(20000).selectExpr(
        "IF(id % 3 > 0, 7, id % 900) AS member_key", "concat('t', id % 2) AS activity_type",
        "timestamp_ntz'2020-06-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS activity_date",
        "timestamp_ntz'2020-06-01 00:00:00' AS dw_created_date")
    rows.repartition(8).write.parquet(str(tmp_path / "activity"))
    members = spark.range(900).selectExpr("id AS member_key", "id AS member_id")
    types = spark.createDataFrame([("t0",), ("t1",)], "activity_type STRING")
    trackers = types.selectExpr("1 AS tracker_id", "activity_type")
    out = feeds.member_interactions(types, members, spark.read.parquet(str(tmp_path / "activity")), trackers,
                                    "2020-07-01")
    assert len(out.collect()) == 20000
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot", ["from_account", "to_account"])
def test_hot_accounts_are_split(spark, tmp_path, small_skew, hot):
    """Two thirds of the transfers name one account; those without a readable number are not looked up at all."""
    other = "to_account" if hot == "from_account" else "from_account"
    spark.range(30000).selectExpr(
        f"IF(id % 9 = 0, 'x', IF(id % 3 > 0, '7', string(id % 900))) AS {hot}", f"string(1000 + id % 700) AS {other}",
        "1 AS amount", "uuid() AS note").repartition(8).write.parquet(str(tmp_path / "requests"))
    accounts = spark.range(2000).selectExpr("id", "1 AS balance")
    out = ledger.validate_transfers(spark.read.parquet(str(tmp_path / "requests")), accounts)
    counts = dict(out.groupBy("error_code").count().collect())
    assert counts["INVALID_ACCOUNT_FORMAT"] == 3334 and sum(counts.values()) == 30000
    out.write.format("noop").mode("overwrite").save()
    rows = out.collect()
    assert len(rows) == 30000 and "skew=true" in out._jdf.queryExecution().executedPlan().toString()
