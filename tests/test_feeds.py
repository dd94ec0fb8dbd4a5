"""Item list, metadata and interactions on the seed rows of the recommendation star."""

from datetime import datetime

import pytest

from millrace.plans import feeds, star

DAY = "timestamp_ntz"


def star_tables(spark, extra=True):
    actions = [(1, "Weight", "Weight", "Weight")]
    activities = [(1, 1, "Weight", True), (2, 1, "BioMetrics", False)]
    trackers = [(1, "Daily Weight Tracker", "What’s your Weight?", 1, 1, False, "Published", None)]
    categories = [(1, "Getting Active", "#f26700", 0, "GettingActive", "Published", False)]
    if extra:
        actions += [(i, n, n, n) for i, n in ((2, "Steps"), (3, "Sleep"), (4, "Mood"), (5, "Yoga"))]
        activities += [
            (3, 1, "Weight", True),       # same type twice: distinct
            (4, 1, "Unknown", None),      # nullable flag: dropped
            (5, 2, "Steps", True), (6, 3, "Sleep", True), (7, 4, "Mood", True), (8, 5, "Yoga", True),
        ]
        trackers += [
            (2, "sponsored", "t", 1, 2, False, "Published", 9),
            (3, "hidden", "t", 1, 3, True, "Published", None),
            (4, "unpublished", "t", 1, 4, False, "Unpublished", None),
            (5, "other category", "t", 2, 5, False, "Published", None),
        ]
        categories += [(2, "Sleeping Well", "#000000", 1, "Sleep", "Unpublished", False)]
    return {
        "action": spark.createDataFrame(actions, "id INT, name STRING, description STRING, action_type STRING"),
        "action_activities": spark.createDataFrame(
            activities, "id BIGINT, action_id INT, activity_type STRING, manually_entered BOOLEAN"),
        "tracker": spark.createDataFrame(
            trackers, "id BIGINT, description STRING, title STRING, thrive_category_id BIGINT, action INT, "
                      "hide_on_healthy_habits BOOLEAN, status STRING, sponsor_id BIGINT"),
        "category": spark.createDataFrame(
            categories, "id BIGINT, name STRING, color STRING, order_index BIGINT, type STRING, status STRING, "
                        "sensitive BOOLEAN"),
    }


@pytest.mark.parametrize("extra", [False, True])
def test_item_list(spark, rows, extra):
    assert rows(feeds.item_list(**star_tables(spark, extra))) == [("Weight",)]


def test_star_join_names_and_stages(spark, rows):
    joined = star.joined_star(**star_tables(spark, extra=False))
    assert joined.count() == 2
    assert {".description", "description", ".name", "name", ".status", "status"} <= set(joined.columns)
    row = joined.first()
    assert (row[".description"], row["description"]) == ("Weight", "Daily Weight Tracker")
    assert (row[".name"], row["name"]) == ("Weight", "Getting Active")
    assert rows(star.visible_items(joined)) == [("Weight",)]


def test_star_filter_needs_both_statuses(spark, rows):
    joined = star.joined_star(**star_tables(spark))
    assert rows(star.visible_items(joined, "activity_type")) == [("Weight",), ("Weight",)]
    assert rows(star.visible_items(joined, "activity_type", both_statuses=False)) == [
        ("Mood",), ("Weight",), ("Weight",)]


def warehouse(spark):
    def at(year, month):
        return datetime(year, month, 29, 11, 34, 29)

    facts = [(1, 1, "Weight", at(2020, 6)), (2, 1, "TrainTheBrain", at(2019, 12)), (3, 1, "Weight", at(2020, 5)),
             (4, 2, "Weight", at(2020, 4)), (5, 2, "TrainTheBrain", at(2020, 4)), (6, 2, "Weight", at(2020, 4)),
             (7, 2, "Weight", at(2013, 6))]
    trackers = [(1, 1, "MovesSteps"), (2, 6, "TrainTheBrain"), (3, 6, "AreYouCurrent"), (4, 2, "StriivSleep"),
                (5, 1, "SamsungGearSteps"), (6, 1, "GarminSession"), (7, 1, "StravaSteps"), (8, 3, "Weight"),
                (9, 8, "Mood"), (10, 3, "Yoga")]
    return {
        "types": spark.createDataFrame([("Weight",)], "activity_type STRING"),
        "member": spark.createDataFrame([(k, k) for k in range(1, 7)] + [(7, None)],
                                        "member_key BIGINT, member_id BIGINT"),
        "activity": spark.createDataFrame(
            [(*f, f[3]) for f in facts],
            f"member_activity_key BIGINT, member_key BIGINT, activity_type STRING, activity_date {DAY}, "
            f"dw_created_date {DAY}"),
        "tracker": spark.createDataFrame(trackers, "tracker_id BIGINT, thrive_category_id BIGINT, activity_type STRING"),
        "category": spark.createDataFrame([(k, k) for k in range(1, 11)],
                                          "thrive_category_key BIGINT, thrive_category_id BIGINT"),
    }


def test_item_metadata(spark, rows):
    w = warehouse(spark)
    assert rows(feeds.item_metadata(w["types"], w["tracker"], w["category"])) == [("hh_8", "hh_", 3)]


@pytest.mark.parametrize("salt_rows", [None, 1])
def test_member_interactions(spark, rows, salt_rows):
    w = warehouse(spark)
    assert feeds.listed_activities(w["types"], w["activity"], "2020-07-01").count() == 4
    got = feeds.member_interactions(w["types"], w["member"], w["activity"], w["tracker"], "2020-07-01",
                                    salt_rows=salt_rows)
    shift = 5 * 3600  # the recorded epochs come from a session five hours west of UTC
    assert rows(got) == [(1, "hh_8", 1590770069 - shift), (1, "hh_8", 1593448469 - shift),
                         (2, "hh_8", 1588178069 - shift), (2, "hh_8", 1588178069 - shift)]


def test_interactions_in_a_western_session(spark, rows):
    w = warehouse(spark)
    spark.conf.set("spark.sql.session.timeZone", "Etc/GMT+5")
    try:
        local = w["activity"].selectExpr("member_key", "activity_type", "activity_date::timestamp AS activity_date",
                                         "dw_created_date::timestamp AS dw_created_date")
        got = feeds.member_interactions(w["types"], w["member"], local, w["tracker"], "2020-07-01")
        assert [r[2] for r in rows(got)] == [1590770069, 1593448469, 1588178069, 1588178069]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_feed_files(spark, tmp_path):
    w = warehouse(spark)
    metadata = feeds.item_metadata(w["types"], w["tracker"], w["category"])
    interactions = feeds.member_interactions(w["types"], w["member"], w["activity"], w["tracker"], "2020-07-01")
    written = feeds.write_feed(str(tmp_path), w["types"], metadata, interactions)
    assert (tmp_path / "item_list.csv").read_text() == "activity_type\nWeight\n"
    assert (tmp_path / "item_metadata.csv").read_text() == "ITEM_ID,ITEM_TYPE,thrive_category_id\nhh_8,hh_,3\n"
    assert len((tmp_path / "member_interactions.csv").read_text().splitlines()) == 5
    assert set(written) == {"item_list.csv", "item_metadata.csv", "member_interactions.csv"}
