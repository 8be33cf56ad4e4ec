"""Topic patterns and tag escaping."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def topic_regex(pattern: str) -> str:
    """``energy/+/data`` as a regular expression; ``+`` stands for one level."""
    levels = ("[^/]*" if level == "+" else re.escape(level) for level in pattern.split("/"))
    return "^" + "/".join(levels) + "$"


def escape_tag(value: Column) -> Column:
    """Put a backslash before blanks, commas and equals signs."""
    return F.regexp_replace(value, r"([ ,=])", r"\\$1")


def unescape_tag(value: Column) -> Column:
    return F.regexp_replace(value, r"\\([ ,=])", "$1")


def default_tag(value: Column) -> Column:
    """Absent tags group under ``unknown``."""
    return F.coalesce(value, F.lit("unknown"))
