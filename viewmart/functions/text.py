"""Column expressions for dump lines and for dates kept as text."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters other than the space that Python's ``str.split()`` takes as blanks.
CONTROL_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"
WIDE_BLANKS = (
    "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# File name of a daily dump, with year, month and day as groups.
DUMP_GLOB = "pageviews-*-user.bz2"
DUMP_DAY = r"pageviews-(\d{4})(\d{2})(\d{2})-user"


def split_fields(line: Column) -> Column:
    """Fields of a line, as Python's ``line.strip().split()`` gives them.

    Other blanks become spaces, the line is split at each space, and empty fields go.
    Most lines are plain ASCII with single spaces; a few cheap tests spare them the first
    step, and none needs a regular expression.
    """
    blanks = CONTROL_BLANKS + WIDE_BLANKS
    beyond_ascii = F.octet_length(line) != F.length(line)
    unusual = reduce(or_, [F.contains(line, F.lit(c)) for c in CONTROL_BLANKS], beyond_ascii)
    spaced = F.when(unusual, F.translate(line, blanks, " " * len(blanks))).otherwise(line)
    return F.array_remove(F.split(spaced, " "), "")


def to_count(text: Column) -> Column:
    """Text to BIGINT as Python's ``int()`` reads ASCII digits; NULL if it is no integer.

    Takes a sign (``+5``) and single underscores between digits (``1_000``).
    """
    grouped = F.when(
        text.rlike(r"^[+-]?[0-9]+(_[0-9]+)+$"), F.translate(text, "_", "").try_cast("bigint")
    )
    return F.coalesce(text.try_cast("bigint"), grouped)


def day_from_path(path: Column, pattern: str = DUMP_DAY) -> Column:
    """``YYYY-MM-DD`` from the first match of ``pattern``'s three groups; NULL if none."""
    parts = [F.regexp_extract(path, pattern, i) for i in (1, 2, 3)]
    return F.when(parts[0] != "", F.concat_ws("-", *parts))


def month_of(date: Column) -> Column:
    """``YYYY-MM-DD`` text to ``YYYY-MM`` text."""
    return F.substring(date, 1, 7)
