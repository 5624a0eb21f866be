"""Role category and keyword tags of parsed postings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiretide import vocab
from hiretide.functions.tags import keyword_tags, role_label

# Between the texts searched as one; no keyword holds it.
TEXT_BREAK = "\n"


def add_role_category(df: DataFrame, rules: Sequence[tuple[str, str]] = vocab.ROLE_RULES,
                      text: str = "title_l", default: str = vocab.OTHER_ROLE) -> DataFrame:
    """Add ``role_category``: the first rule found in the title, else the default."""
    return df.withColumn("role_category", role_label(F.col(text), rules, default))


def add_techs(df: DataFrame, keywords: Sequence[str] = vocab.TECH_KEYWORDS,
              text: Sequence[str] = ("title_l", "desc_l"), distinct: bool = True,
              match: str = "substring") -> DataFrame:
    """Add ``techs``: keywords found in any of the text columns, in list order.

    The texts are joined once and each keyword is searched for once in the
    whole of it, rather than once per text.
    """
    if any(TEXT_BREAK in k for k in keywords):
        raise ValueError("a keyword must not hold a line break")
    joined = df.withColumn("_text", F.concat_ws(TEXT_BREAK, *text))
    return joined.withColumn("techs", keyword_tags(F.col("_text"), keywords, distinct, match)) \
        .drop("_text")


def enrich(events: DataFrame) -> DataFrame:
    """Parsed events with both tags and without the helper texts."""
    return add_techs(add_role_category(events)).drop("title_l", "desc_l")
