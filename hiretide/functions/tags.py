"""Role label and keyword tags as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hiretide.functions.text import whole_word


def role_label(text: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first rule whose pattern stands in the text."""
    label = F.lit(default)
    for pattern, name in reversed(rules):
        label = F.when(text.contains(pattern), F.lit(name)).otherwise(label)
    return label


def keyword_tags(text: Column, keywords: Sequence[str], distinct: bool = True,
                 match: str = "substring") -> Column:
    """Keywords found in the text, in list order.

    ``distinct=False`` gives a keyword listed twice as two tags.
    """
    if match not in ("substring", "word"):
        raise ValueError(f"match must be 'substring' or 'word', not {match!r}")
    listed = list(dict.fromkeys(keywords)) if distinct else list(keywords)
    if not listed:
        return F.array().cast("array<string>")

    def hit(k: str) -> Column:
        return text.contains(k) if match == "substring" else whole_word(text, k)

    return F.array_compact(F.array(*[F.when(hit(k), F.lit(k)) for k in listed]))
