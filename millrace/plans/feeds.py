"""Recommendation feed: list of item types, item metadata, member interactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import not_false, since_months
from ..functions.scalar import epoch_with_fallback, prefixed
from ..operators.joins import in_list, salted_join
from ..sinks.files import write_single_file

# The published status, and the prefix of item ids.
PUBLISHED = "Published"
ITEM_PREFIX = "hh_"


def item_list(action: DataFrame, action_activities: DataFrame, tracker: DataFrame, category: DataFrame) -> DataFrame:
    """Distinct activity types that a visible, published, unsponsored tracker offers.

    Only the type survives, so every other table is a filter on the activities (a semi join): the
    two small sides meet first, and the activities are shuffled by action at most once.
    """
    actions = action.select(F.col("id").alias("action_id"))
    activities = (action_activities.select("action_id", "activity_type", "manually_entered")
                  .filter(not_false("manually_entered")).drop("manually_entered"))
    categories = (category.filter(F.col("status") == PUBLISHED)
                  .select(F.col("id").alias("thrive_category_id")))
    trackers = (tracker.filter((F.col("hide_on_healthy_habits") == F.lit(False))
                               & (F.col("status") == PUBLISHED) & F.col("sponsor_id").isNull())
                .select(F.col("action").alias("action_id"), "thrive_category_id"))
    offered = in_list(trackers, categories, "thrive_category_id").select("action_id")
    return in_list(in_list(activities, offered, "action_id"), actions, "action_id").select("activity_type").distinct()


def item_metadata(types: DataFrame, tracker: DataFrame, category: DataFrame,
                  prefix: str = ITEM_PREFIX) -> DataFrame:
    """(ITEM_ID, ITEM_TYPE, thrive_category_id) of trackers whose activity type is in the list.

    Equal (tracker, category, type) rows count once.
    """
    listed = in_list(tracker.select("tracker_id", "thrive_category_id", "activity_type"), types, "activity_type")
    known = in_list(listed, category.select("thrive_category_id"), "thrive_category_id").distinct()
    return known.select(prefixed(prefix, "tracker_id").alias("ITEM_ID"), F.lit(prefix).alias("ITEM_TYPE"),
                        "thrive_category_id")


def listed_activities(types: DataFrame, activity: DataFrame, as_of: str, months: int = 12) -> DataFrame:
    """Activities of a listed type in the months before ``as_of``."""
    recent = (activity.filter(since_months("activity_date", as_of, months))
              .select("activity_date", "dw_created_date", "member_key", "activity_type"))
    return in_list(recent, types, "activity_type")


def member_interactions(types: DataFrame, member: DataFrame, activity: DataFrame, tracker: DataFrame, as_of: str,
                        months: int = 12, prefix: str = ITEM_PREFIX, salt_rows: int | None = None) -> DataFrame:
    """(USER_ID, ITEM_ID, TIMESTAMP) per listed activity of a known member.

    Members without activities fall out at the tracker join, so the member join is an inner one.
    ``salt_rows`` spreads members with more activities than that over several tasks; the default
    leaves hot members to adaptive skew handling.
    """
    members = member.filter(F.col("member_id").isNotNull()).select("member_id", "member_key")
    recent = listed_activities(types, activity, as_of, months)
    if salt_rows is None:
        joined = recent.join(members, "member_key")
    else:
        joined = salted_join(recent, members, ["member_key"], ["activity_date", "activity_type"], hot_rows=salt_rows)
    trackers = tracker.select("tracker_id", "activity_type")
    return joined.join(trackers, "activity_type").select(
        F.col("member_id").alias("USER_ID"), prefixed(prefix, "tracker_id").alias("ITEM_ID"),
        epoch_with_fallback("activity_date", "dw_created_date").alias("TIMESTAMP"),
    )


def write_feed(folder: str, types: DataFrame, metadata: DataFrame, interactions: DataFrame) -> dict[str, list[str]]:
    """Write the three frames as named CSV files."""
    frames = {"item_list.csv": types, "item_metadata.csv": metadata, "member_interactions.csv": interactions}
    return {name: write_single_file(df, f"{folder.rstrip('/')}/{name}") for name, df in frames.items()}
