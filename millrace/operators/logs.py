"""Log lines: search, remap, parse. The same functions serve batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import has
from ..functions.scalar import grok
from .shaping import remap

# Fixed value: the layout of an application log line.
LINE_PATTERN = "%{TIMESTAMP_ISO8601:timestamp} %{LOGLEVEL:level} %{GREEDYDATA:message}"


def application_logs(service: str = "python-app", source: str = "lambda") -> Column:
    """service:<service> OR source:<source>"""
    return has("service", service) | has("source", source)


def error_logs(service: str = "python-app") -> Column:
    """service:<service> AND level ERROR"""
    return has("service", service) & has("level", "ERROR")


def parse_lines(logs: DataFrame, line: str = "line", pattern: str = LINE_PATTERN) -> DataFrame:
    """Add the named parts of each line; a line of another layout keeps NULL parts."""
    return logs.withColumns(grok(line, pattern))


def process(logs: DataFrame, wanted: Column | None = None) -> DataFrame:
    """Filter, copy the service name to its target attribute, parse."""
    kept = logs.filter(application_logs() if wanted is None else wanted)
    return parse_lines(remap(kept, "service", "dd.service"))


def with_event_day(logs: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Year, month and day columns of the log time, for a date-partitioned archive.

    Log times may have a comma before the fraction and no colons between the parts of time and offset.
    """
    text = F.regexp_replace(ts, ",", ".")
    for short in (r"^(\S+[T ]\d{2})(\d{2})", r"^(\S+[T ]\d{2}:\d{2})(\d{2})", r"([T ]\S*[+-]\d{2})(\d{2})$"):
        text = F.regexp_replace(text, short, "$1:$2")
    text = F.regexp_replace(text, r"^(\S+[T ]\d{2}:\d{2})(Z|[+-]\S*)?$", "$1:00$2")
    when = text.try_cast("timestamp")
    return logs.withColumns({
        "year": F.date_format(when, "yyyy"), "month": F.date_format(when, "MM"), "day": F.date_format(when, "dd"),
    })
