"""Warehouse tables to files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.joins import prefix_join
from ..operators.shaping import Mapping, apply_mapping, drop_fields


def table_export(table: DataFrame, mappings: list[Mapping]) -> DataFrame:
    return apply_mapping(table, mappings)


def three_table_export(journey: DataFrame, member: DataFrame, member_journey: DataFrame) -> DataFrame:
    """Members with their journeys: each pair of the link table gives one row.

    The members are joined to the link rows themselves. Joining two half-joined frames on the
    member alone would repeat each journey once per journey of that member.
    """
    pairs = drop_fields(prefix_join(journey, member_journey, "journeyid", "journeyid"), ["`.journeyid`"])
    return drop_fields(prefix_join(member, pairs, "memberid", "memberid"), ["`.memberid`"])
