"""The frames one dashboard refresh needs."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiretide.operators.reads import newest_first, search_jobs, tech_timeseries, top_roles, top_techs
from hiretide.schemas import JOBS

if TYPE_CHECKING:
    from hiretide.streaming.tables import JobsTable

JOBS_SHOWN = 20
TOP_SHOWN = 10
POINTS_SHOWN = 100


def snapshot(jobs: DataFrame, trend_tech: DataFrame, trend_role: DataFrame,
             location: str | None = None, role: str | None = None, tech: str = "python",
             window_size_sec: int = 300) -> dict[str, DataFrame]:
    """Jobs page, top tags, top roles and the series of the chosen tag.

    Each frame is worked out when it is used, so pass trends that are stored
    (``Tables.trend_tech.read()``): counts of raw jobs would be made anew for each. For a
    drill-down call it with another ``tech`` and use ``series`` alone.
    """
    return {
        "jobs": search_jobs(jobs, location=(location or "").strip(),
                            role_category=(role or "").strip(), limit=JOBS_SHOWN),
        "top_techs": top_techs(trend_tech, window_size_sec, TOP_SHOWN),
        "top_roles": top_roles(trend_role, window_size_sec, TOP_SHOWN),
        "series": tech_timeseries(trend_tech, tech, window_size_sec, POINTS_SHOWN),
    }


def refreshed_jobs(shown: DataFrame, changes: DataFrame, location: str | None = None,
                   role: str | None = None, limit: int = JOBS_SHOWN) -> DataFrame:
    """The jobs page after ``changes`` (``JobsTable.changes``), out of the page ``shown`` before them: jobs are only
    added, so what is among the newest now was on the page or is new. Pass the page as rows that are
    stored or held, not as the search that gave it."""
    new = search_jobs(changes, location=(location or "").strip(), role_category=(role or "").strip(),
                      limit=limit)
    return newest_first(shown.unionByName(new)).limit(limit)


class LiveJobs:
    """A jobs page that is brought up to date from the batches stored since it was last, and from no others."""

    def __init__(self, jobs: JobsTable, location: str | None = None, role: str | None = None):
        self._jobs, self._terms = jobs, (location, role)
        self.batch = jobs.last_batch()
        first = search_jobs(jobs.changes(-1, self.batch), location=(location or "").strip(),
                            role_category=(role or "").strip(), limit=JOBS_SHOWN)
        self.rows = first.collect()  # a page

    def refresh(self) -> DataFrame:
        """The page as it is now."""
        spark, now = self._jobs.spark, self._jobs.last_batch()
        if now > self.batch:
            shown = spark.createDataFrame(self.rows, JOBS)
            self.rows = refreshed_jobs(shown, self._jobs.changes(self.batch, now), *self._terms).collect()
            self.batch = now
        return spark.createDataFrame(self.rows, JOBS)


def charts(frames: dict[str, DataFrame], time_format: str = "HH:mm:ss",
           clock_format: str = "yyyy-MM-dd HH:mm:ss") -> dict[str, DataFrame]:
    """The snapshot cut down to what is drawn: chart points and the jobs table."""
    def shown(name):
        return F.coalesce(F.col(name), F.lit("-")).alias(name)

    return {
        "top_techs": frames["top_techs"].select("tech", "count"),
        "top_roles": frames["top_roles"].select("role_category", "count"),
        "series": frames["series"].select(
            F.date_format("window_start", time_format).alias("window_start"), "count"),
        "jobs": frames["jobs"].select(
            F.date_format("ingested_at", clock_format).alias("ingested_at"),
            shown("company"), shown("title"), shown("location"), shown("role_category")),
    }
