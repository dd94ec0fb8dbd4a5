"""Token expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def space_tokens(line: Column | str) -> Column:
    """Tokens of a line split at every single space.

    Leading and inner empty tokens count, trailing ones do not; an empty line has one empty
    token and a line of nothing but spaces has none.
    """
    line = F.col(line) if isinstance(line, str) else line
    kept = F.rtrim(line)
    return F.when((kept == "") & (line != ""), F.array().cast("array<string>")).otherwise(F.split(kept, " "))
