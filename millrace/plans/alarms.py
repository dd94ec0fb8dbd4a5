"""Alarm evaluation over stored metric points."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.predicates import contains
from ..operators.alarms import ALL_MINUTES_RULES, RULES, Rule, evaluate


def alarm_changes(points: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """The moments at which an alarm goes on or off."""
    return evaluate(points, rules, changes_only=True)


# Fixed value: the word that the domains under watch have in their name.
DOMAIN = "audience"


def domain_alarms(points: DataFrame, domain: str = DOMAIN) -> DataFrame:
    """Conditions over points whose ``domain_name`` contains a word."""
    return evaluate(points.filter(contains("domain_name", domain)), ALL_MINUTES_RULES)
