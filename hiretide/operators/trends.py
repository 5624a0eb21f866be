"""Tumbling-window counts of tags and roles, batch or streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tech_trend(df: DataFrame, window_sec: int = 300, time_col: str = "ingested_at",
               watermark: str | None = None) -> DataFrame:
    """Postings per window and tag; a posting without tags or time counts nowhere.

    ``explode_outer`` keeps Catalyst from adding a "tags are not empty" filter
    below it, which would work out all tags of a row a second time.
    """
    timed = _windowed(df, window_sec, time_col, watermark)
    tagged = timed.select("window", F.explode_outer("techs").alias("tech"))
    return _count(tagged.where(F.col("tech").isNotNull()), "tech", window_sec)


def role_trend(df: DataFrame, window_sec: int = 300, time_col: str = "ingested_at",
               watermark: str | None = None) -> DataFrame:
    """Postings per window and role category; a posting without time counts nowhere."""
    return _count(_windowed(df, window_sec, time_col, watermark), "role_category", window_sec)


def _windowed(df: DataFrame, window_sec: int, time_col: str, watermark: str | None) -> DataFrame:
    if window_sec < 1:
        raise ValueError("window_sec must be at least 1")
    timed = df.withWatermark(time_col, watermark) if watermark else df
    return timed.withColumn("window", F.window(time_col, f"{window_sec} seconds"))


def _count(windowed: DataFrame, key: str, window_sec: int) -> DataFrame:
    # Counted within each task before the shuffle, so a window or key that holds
    # most rows sends one row per task.
    return windowed.groupBy("window", key).count().select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        F.lit(window_sec).cast("int").alias("window_size_sec"), key, "count")


def roll_up(trend: DataFrame, key: str, sizes: Sequence[int]) -> DataFrame:
    """Counts of wider windows out of stored counts, without the events: for each of ``sizes`` (seconds) that
    the windows of ``trend`` divide, one row per wider window and key, in the columns of a trend, with
    ``of_size_sec``, the size it was made of."""
    wide = trend.where("count <> 0").withColumn("size", F.explode(F.array(*(F.lit(s) for s in sizes)))) \
        .where((F.col("size") > F.col("window_size_sec")) & (F.col("size") % F.col("window_size_sec") == 0))
    start = F.unix_seconds("window_start") - F.pmod(F.unix_seconds("window_start"), F.col("size"))
    summed = wide.groupBy(start.alias("start"), F.col("size").cast("int").alias("window_size_sec"), key,
                          F.col("window_size_sec").alias("of_size_sec")).agg(F.sum("count").alias("count"))
    return summed.select(F.timestamp_seconds("start").alias("window_start"),
                         F.timestamp_seconds(F.col("start") + F.col("window_size_sec")).alias("window_end"),
                         "window_size_sec", key, "count", "of_size_sec")
