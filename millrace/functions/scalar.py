"""Scalar expressions. All of them are Column builders: nothing here runs Python on rows.

ANSI mode is on, so every expression that can meet a bad value uses the ``try``/NULL form.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\x0b\x0c"

# The parts a grok pattern may name.
GROK_PARTS = {
    "TIMESTAMP_ISO8601": r"\d{4}-\d{2}-\d{2}[T ]\d{2}:?\d{2}(?::?\d{2}(?:[.,]\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?",
    "LOGLEVEL": (
        r"(?i:alert|trace|debug|notice|info(?:rmation)?|warn(?:ing)?|err(?:or)?"
        r"|crit(?:ical)?|fatal|severe|emerg(?:ency)?)"
    ),
    "GREEDYDATA": r".*",
}


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _literal_pattern(separator: str) -> str:
    return rf"\Q{separator}\E"


def item_at(array: Column | str, index: int) -> Column:
    """Array element by position, NULL when the array is shorter."""
    return F.get(_col(array), F.lit(index))


def split_part(text: Column | str, separator: str, index: int) -> Column:
    """Zero-based piece of a split, NULL when there are fewer pieces."""
    return F.get(F.split(_col(text), _literal_pattern(separator)), F.lit(index))


def split_once(text: Column | str, separator: str, index: int) -> Column:
    """Piece 0 or 1 of a split at the first separator only."""
    return F.get(F.split(_col(text), _literal_pattern(separator), 2), F.lit(index))


def strip(text: Column | str) -> Column:
    return F.btrim(_col(text), F.lit(WHITESPACE))


def zero_pad(number: Column | str, width: int) -> Column:
    """Pad with zeros to ``width``; longer numbers keep all their digits."""
    number = _col(number)
    return F.when(number.isNotNull(), F.format_string(f"%0{width}d", number))


def without(text: Column | str, piece: str) -> Column:
    return F.replace(_col(text), F.lit(piece), F.lit(""))


def join_all(separator: str, *parts: Column | str) -> Column:
    """Join with a separator; NULL if any part is NULL (``concat_ws`` would skip it)."""
    columns = []
    for part in parts:
        if columns:
            columns.append(F.lit(separator))
        columns.append(_col(part))
    return F.concat(*columns)


def seconds_to_millis(seconds: Column | str) -> Column:
    """NULL where the seconds are no whole number or the milliseconds need more than 64 bits."""
    return F.try_multiply(_col(seconds).try_cast("bigint"), F.lit(1000).cast("bigint"))


def millis_to_timestamp(millis: Column | str) -> Column:
    return F.timestamp_millis(_col(millis).cast("bigint"))


def epoch_with_fallback(first: Column | str, second: Column | str) -> Column:
    """Epoch seconds of ``first``, or of ``second`` where ``first`` is NULL."""
    return F.unix_timestamp(F.coalesce(_col(first), _col(second)))


def prefixed(prefix: str, value: Column | str) -> Column:
    return F.concat(F.lit(prefix), _col(value).cast("string"))


def months_before(as_of: Column | str, months: int) -> Column:
    """``as_of`` is a date column, or an ISO date given as text."""
    day = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of.cast("date")
    return F.add_months(day, -months)


def parse_us_date(text: Column | str) -> Column:
    """``MM/dd/yyyy`` to DATE, NULL when malformed.

    Day 29-31 of a shorter month counts as that month's last day; day 32 is malformed.
    """
    text = _col(text)
    shaped = text.rlike(r"^(0[1-9]|1[0-2])/(0[1-9]|[12][0-9]|3[01])/(?!0000)[0-9]{4}\z")
    month, day, year = (F.substring(text, at, size).cast("int") for at, size in ((1, 2), (4, 2), (7, 4)))
    first = F.make_date(year, month, F.lit(1))
    return F.when(shaped, F.least(F.date_add(first, day - 1), F.last_day(first)))


def parse_datetime(text: Column | str) -> Column:
    return F.try_to_timestamp(_col(text), F.lit("yyyy-MM-dd HH:mm:ss"))


def ellipsize(text: Column | str, size: int) -> Column:
    """Texts shorter than ``size`` stay; others keep ``size`` characters plus three dots."""
    text = _col(text)
    return F.when(F.length(text) < size, text).otherwise(F.concat(F.left(text, F.lit(size)), F.lit("...")))


def same_text(left: Column | str, right: Column | str) -> Column:
    return F.lower(_col(left)) == F.lower(_col(right))


def row_as_json(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))


def date_path(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy/MM/dd")


def tags_to_map(tags: Column | str) -> Column:
    """``['k:v', ...]`` to a map; the value keeps any further colons."""
    def entry(tag: Column) -> Column:
        pieces = F.split(tag, ":", 2)
        return F.struct(F.get(pieces, F.lit(0)).alias("key"), F.get(pieces, F.lit(1)).alias("value"))

    return F.map_from_entries(F.transform(_col(tags), entry))


def null_if_token(column: Column | str, token: str = "null") -> Column:
    return F.nullif(_col(column), F.lit(token))


def label_values(column: Column | str, labels: dict, default: object = None) -> Column:
    """CASE column from a value-to-label mapping."""
    column = _col(column)
    branches = None
    for value, label in labels.items():
        branches = (F.when if branches is None else branches.when)(column == F.lit(value), F.lit(label))
    return branches.otherwise(F.lit(default))


def grok(text: Column | str, pattern: str) -> dict[str, Column]:
    """Named columns for ``%{PART:name}`` pieces; all NULL when the text does not match."""
    text = _col(text)
    names = re.findall(r"%\{\w+:(\w+)\}", pattern)
    regex = re.sub(r"%\{(\w+):\w+\}", lambda m: f"({GROK_PARTS[m.group(1)]})", pattern)
    regex = f"(?s)^{regex}$"
    matched = text.rlike(regex)
    return {
        name: F.when(matched, F.regexp_extract(text, regex, group))
        for group, name in enumerate(names, start=1)
    }
