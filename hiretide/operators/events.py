"""Postings to events, and events back to typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from hiretide.functions.text import lowered
from hiretide.functions.times import clock_iso_text, iso_text
from hiretide.schemas import EVENT, POSTING


def to_events(postings: DataFrame, source: str = "jsonl", id_col: str | None = None,
              time_col: str | None = None) -> DataFrame:
    """Wrap postings as keyed events: ``key`` (the event id) and ``value`` (JSON text).

    Without ``id_col`` ids are random; without ``time_col`` the time is that of
    the run. Random ids differ on every run of the plan, so write events once
    and read them back. A ``line`` column, as ``read_postings`` gives, goes into
    the event unchanged, with fields this package does not know.
    """
    event_id = F.col(id_col).cast("string") if id_col else F.uuid()
    if time_col and isinstance(postings.schema[time_col].dataType, TimestampNTZType):
        at = clock_iso_text(F.col(time_col))  # wall-clock columns are UTC
    else:
        at = iso_text(F.col(time_col) if time_col else F.current_timestamp())
    keep_line = "line" in postings.columns
    body = ["line"] if keep_line else [F.struct(*POSTING.fieldNames()).alias("posting")]
    # The id stands in a column of its own first: a random one must not be drawn twice.
    event = postings.select(event_id.alias("event_id"), at.alias("ingested_at"),
                            F.lit(source).alias("source"), *body)
    if not keep_line:
        return event.select(F.col("event_id").alias("key"), F.to_json(
            F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    head = F.to_json(F.struct("event_id", "ingested_at", "source"))
    value = F.concat(F.rtrim(head, F.lit("}")), F.lit(',"posting":'), F.col("line"), F.lit("}"))
    return event.select(F.col("event_id").alias("key"), value.alias("value"))


def parse_events(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed, flat rows of raw events (a ``value`` column of text or bytes); columns to ``keep`` ride along.

    Never fails on bad input: what cannot be read is NULL, and ``raw`` keeps the
    text of a row without id or time. ``title_l`` and ``desc_l`` are the
    lower-cased texts the tags are searched in.
    """
    text = raw.select(F.col("value").cast("string").alias("value"), *keep)
    # Exploding a list of one keeps later filters (no time, no id) above the JSON
    # reader; pushed below it they would read every event a second time.
    read = text.select("value", *keep, F.explode(F.array(F.from_json("value", EVENT))).alias("e"))
    flat = read.select(
        "e.event_id",
        F.try_to_timestamp(F.col("e.ingested_at")).alias("ingested_at"),
        "e.posting.*",
        "value", *keep)
    bad = F.col("event_id").isNull() | F.col("ingested_at").isNull()
    return flat.select(
        "event_id", "ingested_at", *POSTING.fieldNames(),
        lowered(F.col("title")).alias("title_l"),
        lowered(F.col("description")).alias("desc_l"),
        F.when(bad, F.coalesce("value", F.lit(""))).alias("raw"), *keep)


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows a table can hold, and rows without id or time."""
    return parsed.where(F.col("raw").isNull()), parsed.where(F.col("raw").isNotNull())
