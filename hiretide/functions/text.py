"""Text predicates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def lowered(text: Column) -> Column:
    """Lower-cased text, NULL as the empty string."""
    return F.lower(F.coalesce(text, F.lit("")))


def like_pattern(value: str) -> str:
    """LIKE pattern "contains value"; ``%`` and ``_`` in it stay wildcards.

    A backslash makes the next character literal. Spark takes that only before
    a wildcard or another backslash, so elsewhere the backslash is dropped.
    """
    return re.sub(r"\\(.)", lambda m: m[0] if m[1] in "%_\\" else m[1], f"%{value}%",
                  flags=re.DOTALL)


def icontains(text: Column, value: str) -> Column:
    """Case-insensitive "contains", with wildcards."""
    return text.ilike(like_pattern(value))


def whole_word(text: Column, word: str) -> Column:
    # The plain search is much the cheaper one and rules most words out.
    return text.contains(word) & text.rlike(rf"(?<!\w){re.escape(word)}(?!\w)")
