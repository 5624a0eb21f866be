"""Sample postings at any size, as a pure function of an id column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hiretide import vocab

# Prime modulus and multipliers of the id mixer: with id < PRIME every product
# stays below 2**62, so it is exact under ANSI arithmetic at any id.
PRIME = 2_147_483_647
STEP = 1_103_515_245
SPREAD = 12_345_701


def text_array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def pick(values: Sequence[str], index: Column) -> Column:
    """The entry at a 0-based index."""
    return F.element_at(text_array(values), (index + 1).cast("int"))


def mixed(id_col: Column, seed: int, draw: int) -> Column:
    """A spread-out number in [0, PRIME) for one draw of one id."""
    shift = (seed * 7_919 + draw * SPREAD) % PRIME
    x = (id_col % PRIME * STEP + F.lit(shift)) % PRIME
    return x * x % PRIME


def slug(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit(" "), F.lit("-"))


def posting_url(company: Column, title: Column, id_col: Column) -> Column:
    return F.concat(F.lit(vocab.SAMPLE_URL_BASE), slug(company), F.lit("/"), slug(title),
                    F.lit("-"), id_col.cast("string"))


def generate_postings(ids: DataFrame, id_col: str = "id", seed: int = 0) -> DataFrame:
    """One posting per id: the same id and seed always give the same posting.

    Row-local, so any number of ids is generated without a shuffle.
    """
    i = F.col(id_col).cast("long")

    def draw(values, n):
        return pick(values, mixed(i, seed, n) % len(values))

    techs = [", ".join(g) for g in vocab.SAMPLE_TECH_GROUPS]
    drawn = ids.select(
        i.alias("id"),
        draw(vocab.SAMPLE_COMPANIES, 1).alias("company"),
        draw(vocab.SAMPLE_TITLES, 2).alias("title"),
        draw(vocab.SAMPLE_LOCATIONS, 3).alias("location"),
        F.replace(draw(vocab.SAMPLE_DESCRIPTIONS, 5), F.lit("{techs}"), draw(techs, 4))
        .alias("description"),
    )
    return drawn.withColumn("url", posting_url(F.col("company"), F.col("title"), F.col("id")))


def generate_n_postings(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    """``n`` postings with ids 0..n-1."""
    return generate_postings(spark.range(n), "id", seed)
