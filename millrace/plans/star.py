"""The item list again, over whole tables with clashing column names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.predicates import all_equal
from ..operators.joins import prefix_join
from ..operators.shaping import apply_mapping, rename_field, select_fields

# Columns of the four tables. Ids and references are 64-bit on both sides of a join.
TABLES = {
    "action": "id BIGINT, action_type STRING, name STRING, description STRING",
    "action_activities": "id BIGINT, action_id BIGINT, activity_type STRING, manually_entered BOOLEAN",
    "tracker": "id BIGINT, thrive_category_id BIGINT, action BIGINT, sponsor_id BIGINT, title STRING, "
               "description STRING, status STRING, hide_on_healthy_habits BOOLEAN",
    "category": "id BIGINT, name STRING, type STRING, color STRING, status STRING, order_index BIGINT, "
                "sensitive BOOLEAN",
}
# Each join: the table that is added, the column on what is there so far, and its own.
EDGES = [("action", "action_id", "action.id"), ("tracker", "action.id", "action"),
         ("category", "thrive_category_id", "category.id")]


def typed(df: DataFrame, table: str) -> DataFrame:
    """The columns of a table's schema in its types; the id is named after the table."""
    fields = [(f.name, f.dataType.simpleString()) for f in T.StructType.fromDDL(TABLES[table]).fields]
    return rename_field(apply_mapping(df, [(*f, *f) for f in fields]), "id", f"{table}.id")


def joined_star(action: DataFrame, action_activities: DataFrame, tracker: DataFrame, category: DataFrame) -> DataFrame:
    """All columns of the four tables; clashing left names get a leading dot."""
    tables = {"action": action, "tracker": tracker, "category": category}
    joined = typed(action_activities, "action_activities")
    for table, left, right in EDGES:
        joined = prefix_join(joined, typed(tables[table], table), left, right)
    return joined


def visible_items(joined: DataFrame, output: str = "action_type", both_statuses: bool = True) -> DataFrame:
    """Rows of visible, unsponsored, manually entered items; one output column, not distinct.

    After the joins ``status`` is the category's and ``.status`` the tracker's. Both must be
    published; ``both_statuses=False`` tests the category only.
    """
    wanted = {"hide_on_healthy_habits": False, "sponsor_id": None, "status": "Published", "manually_entered": True}
    if both_statuses:
        wanted["`.status`"] = "Published"
    return select_fields(joined.filter(all_equal(wanted)), [output])
