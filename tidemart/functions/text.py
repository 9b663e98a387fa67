"""Column helpers for free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# (?U) widens white space from ASCII to all of Unicode.
WHITESPACE_RUN = r"(?U)\s+"
VISIBLE = r"(?U)\S"


def is_blank(text: str) -> Column:
    """No character but white space; NULL is blank. Stops at the first visible one."""
    return ~F.coalesce(F.rlike(text, F.lit(VISIBLE)), F.lit(False))


def squash(text: str) -> Column:
    """Collapse each run of white space to one space and drop it at both ends."""
    return F.trim(F.regexp_replace(text, WHITESPACE_RUN, " "))


def clip(text: Column, chars: int | None) -> Column:
    """At most ``chars`` characters; ``None`` keeps the whole text."""
    return text if chars is None else F.substring(text, 1, chars)
