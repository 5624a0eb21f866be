"""Replace a time range of a trend by a complete recount of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replace_range(existing: DataFrame, new: DataFrame, window_size_sec: int = 300,
                  times: DataFrame | None = None, time_col: str = "ingested_at") -> DataFrame:
    """Drop rows of this window size that start between the first and last new window, add the new.

    ``new`` must be a complete count of its range: groups it leaves out vanish. With ``times``, the
    rows that were counted, the range is that of their windows, found from the time column alone;
    else ``new`` is worked out once more for its first and last window.
    """
    start = F.col("window_start")
    if times is None:
        bounds = new.agg(F.struct(F.min(start).alias("lo"), F.max(start).alias("hi")).alias("span"))
    else:
        ends = times.agg(F.min(time_col).alias("lo"), F.max(time_col).alias("hi"))
        size = f"{window_size_sec} seconds"
        # Two steps: one row has one window column only.
        low = ends.withColumn("lo", F.window("lo", size)["start"])
        bounds = low.withColumn("hi", F.window("hi", size)["start"]).select(
            F.struct("lo", "hi").alias("span"))
    span = bounds.scalar()
    replaced = ((F.col("window_size_sec") == window_size_sec)
                & start.between(span.getField("lo"), span.getField("hi")))
    # No new rows give a NULL span: nothing is replaced.
    kept = existing.where(~F.coalesce(replaced, F.lit(False)))
    return kept.unionByName(new)
