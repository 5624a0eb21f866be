"""Read queries: job search, top keys of the latest window, series of one key."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hiretide.functions.text import icontains
from hiretide.functions.times import utc_day, utc_hour
from hiretide.schemas import JOBS


def newest_first(jobs: DataFrame) -> DataFrame:
    return jobs.orderBy(F.desc("ingested_at"), F.asc("event_id"))


def check_range(name: str, value: int, low: int, high: int | None = None) -> None:
    if value < low or (high is not None and value > high):
        raise ValueError(f"{name} must be in {low}..{'' if high is None else high}, not {value}")


def job_filters(company: str | None = None, location: str | None = None,
                role_category: str | None = None, seniority: str | None = None) -> list[Column]:
    """Predicates of the given search terms; an empty term is no filter."""
    given = []
    if company:
        given.append(icontains(F.col("company"), company))
    if location:
        given.append(icontains(F.col("location"), location))
    if role_category:
        given.append(F.col("role_category") == role_category)
    if seniority:
        given.append(F.col("seniority") == seniority)
    return given


def matching_jobs(jobs: DataFrame, filters: list[Column]) -> DataFrame:
    return jobs.where(reduce(Column.__and__, filters)) if filters else jobs


def check_page(limit: int, offset: int) -> None:
    check_range("limit", limit, 1, 200)
    check_range("offset", offset, 0)


def _micros(column: Column) -> Column:
    return F.unix_micros(column.cast("timestamp"))


def _at(jobs: DataFrame, micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros)).cast(jobs.schema["ingested_at"].dataType)


def cursor_of(row) -> tuple[datetime, str]:
    """The cursor behind a result row: pass it as ``after`` to get the rows that follow."""
    return row["ingested_at"], row["event_id"]


def _behind(jobs: DataFrame, after: tuple) -> DataFrame:
    at, event_id = F.lit(after[0]).cast(jobs.schema["ingested_at"].dataType), after[1]
    return jobs.where((F.col("ingested_at") < at)
                      | ((F.col("ingested_at") == at) & (F.col("event_id") > event_id)))


def _locate(counts: list, offset: int) -> tuple[object, int]:
    """The group, in the given order, an offset falls into, and the offset within it."""
    for at, count in counts:
        if offset < count:
            return at, offset
        offset -= count
    return None, 0


def _counted(rows: DataFrame, by: Column) -> list:
    """(group, rows) from the greatest group down; counted in each task before the shuffle."""
    return [tuple(r) for r in rows.groupBy(by.alias("at")).count().orderBy(F.desc("at")).collect()]


def _row_at(keys: DataFrame, offset: int) -> tuple[int, str]:
    """Time and id of the row at an offset, of rows of one second however many: these are sorted
    over many tasks, and the tasks' row counts tell where the row is."""
    order = [F.desc("ingested_at"), F.asc("event_id")]
    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = keys.select("ingested_at", "event_id").repartitionByRange(tasks, *order) \
        .withColumn("task", F.spark_partition_id()).persist()
    try:
        counts = [tuple(r) for r in placed.groupBy("task").count().orderBy("task").collect()]
        task, rest = _locate(counts, offset)
        ranked = placed.where(F.col("task") == task).withColumn(
            "place", F.row_number().over(Window.partitionBy("task").orderBy(*order)))
        row = ranked.where(F.col("place") == rest + 1).select(
            _micros(F.col("ingested_at")), "event_id").first()
        return row[0], row[1]
    finally:
        placed.unpersist()


#: Rows up to which a page is taken out of the top rows of all tasks. Behind more of them the rows before it
#: are skipped by counts; the results are the same.
TOP_ROWS = 10_000
#: Rows among which the first step of a search looks for matches; each further step looks among twice as many.
WALK_ROWS = 1 << 20


def _by_counts(rows: DataFrame, first: DataFrame, offset: int) -> DataFrame | None:
    """``rows`` from the one at an offset on, which is in ``first``, the newest of them: found by the counts
    of seconds and then of the places in one second."""
    second, rest = _locate(_counted(first, F.unix_seconds(F.col("ingested_at").cast("timestamp"))), offset)
    if second is None:
        return None
    micros, event_id = _row_at(first.where(
        F.unix_seconds(F.col("ingested_at").cast("timestamp")) == second), rest)
    at = _at(rows, micros)
    return rows.where((F.col("ingested_at") < at)
                      | ((F.col("ingested_at") == at) & (F.col("event_id") >= event_id)))


def _walked(rows: DataFrame, day: str, held: list, need: int) -> list:
    """(day, matching rows) of the newest days, until these have ``need`` rows or no day is left. ``held``:
    (day, all rows), newest first. Each day is counted once; few steps take in many days."""
    found, at, look = [], 0, WALK_ROWS
    while at < len(held) and sum(n for _, n in found) < need:
        end, seen = at, 0
        while end < len(held) and (end == at or seen + held[end][1] <= look):
            seen += held[end][1]
            end += 1
        inside = F.col(day).between(F.lit(held[end - 1][0]), F.lit(held[at][0]))
        found += _counted(rows.where(inside), F.col(day))
        at, look = end, 2 * look
    return found


def find_page(jobs: DataFrame, filters: list[Column], limit: int, offset: int = 0,
              after: tuple | None = None, day: str | None = None,
              summary: DataFrame | None = None) -> DataFrame:
    """One page of matching rows, newest first, all of them behind ``after`` if that is given.

    A page among the first ``TOP_ROWS`` is a top-k: no task gets more rows from another than these.
    Rows before a later page are skipped by counts: of days, then of the seconds of one day, then of the
    places in one second. The driver gets a row per day, per second of a day and per task.

    Of rows stored by ``day``, ``summary`` (that column, ``hour``, ``n``) says how many there are. Then no
    day is read that the page does not need: without filter the summary tells which these are, with one
    matches are counted from the newest day on until there are enough.
    """
    check_page(limit, offset)
    rows = matching_jobs(jobs if after is None else _behind(jobs, after), filters)
    if day is None:
        if offset + limit <= TOP_ROWS:
            return newest_first(rows).offset(offset).limit(limit)
        days = utc_day(F.col("ingested_at").cast("timestamp"))
        start, rest = _locate(_counted(rows, days), offset)
        behind = None if start is None else _by_counts(rows.where(days <= F.lit(start)),
                                                       rows.where(days == F.lit(start)), rest)
        return newest_first(jobs.limit(0) if behind is None else behind).limit(limit)
    held = [tuple(r) for r in summary.groupBy(day).agg(F.sum("n")).orderBy(F.desc(day)).collect()]
    if after is not None:
        newest = after[0].astimezone(timezone.utc).date()
        held = [(d, n) for d, n in held if d <= newest]
    plain = not filters and after is None
    counts = held if plain else _walked(rows, day, held, offset + limit)
    start, rest = _locate(counts, offset)
    if start is None:
        return newest_first(jobs.limit(0))
    end, _ = _locate(counts, offset + limit - 1)
    rows = rows.where(F.col(day) <= F.lit(start))
    rows = rows if end is None else rows.where(F.col(day) >= F.lit(end))
    if rest + limit <= TOP_ROWS:
        return newest_first(rows).offset(rest).limit(limit)
    first = rows.where(F.col(day) == F.lit(start))
    if plain:  # the summary knows the hour, too
        hours = summary.where(F.col(day) == F.lit(start)).groupBy("hour").agg(F.sum("n"))
        hour, rest = _locate([tuple(r) for r in hours.orderBy(F.desc("hour")).collect()], rest)
        first = first.where(utc_hour(F.col("ingested_at")) == F.lit(hour))
    return newest_first(_by_counts(rows, first, rest)).limit(limit)


def search_jobs(jobs: DataFrame, company: str | None = None, location: str | None = None,
                role_category: str | None = None, seniority: str | None = None,
                limit: int = 20, offset: int = 0, after: tuple | None = None) -> DataFrame:
    """One page of matching jobs, newest first.

    A top-k per task, then of the tasks: no full sort, no full shuffle. A far ``offset`` costs
    counts of what lies before it (see ``find_page``); ``after``, a (time, id) pair as ``cursor_of`` gives
    it, goes on behind a row without them.
    """
    terms = job_filters(company, location, role_category, seniority)
    return find_page(jobs.select(*JOBS.fieldNames()), terms, limit, offset, after)


def top_techs(trend: DataFrame, window_size_sec: int = 300, limit: int = 10) -> DataFrame:
    """Most counted tags of the latest window."""
    return _top_of_latest(trend, "tech", window_size_sec, limit)


def top_roles(trend: DataFrame, window_size_sec: int = 300, limit: int = 10) -> DataFrame:
    """Most counted roles of the latest window."""
    return _top_of_latest(trend, "role_category", window_size_sec, limit)


def tech_timeseries(trend: DataFrame, tech: str, window_size_sec: int = 300, limit: int = 100,
                    newest: bool = False) -> DataFrame:
    """First windows of one tag in time order, or the last ones."""
    return _series(trend, "tech", tech, window_size_sec, limit, newest)


def role_timeseries(trend: DataFrame, role_category: str, window_size_sec: int = 300,
                    limit: int = 100, newest: bool = False) -> DataFrame:
    """First windows of one role in time order, or the last ones."""
    return _series(trend, "role_category", role_category, window_size_sec, limit, newest)


def _columns(key: str) -> list[str]:
    return ["window_start", "window_end", "window_size_sec", key, "count"]


def _top_of_latest(trend: DataFrame, key: str, size: int, limit: int) -> DataFrame:
    # Latest window first makes its top rows the first rows overall, so one pass
    # finds both. A join with the latest start would read the trend twice, and
    # count it twice where it is not stored.
    check_range("window_size_sec", size, 1)
    check_range("limit", limit, 1, 100)
    rows = trend.where(F.col("window_size_sec") == size)
    if "window_date" in trend.columns:  # stored by day: the newest one is read, the others are not
        newest = rows.agg(F.max("window_date").alias("newest")).scalar()
        rows = rows.where(F.col("window_date") == newest)
    rows = rows.select(*_columns(key))
    first = rows.orderBy(F.desc("window_start"), F.desc("count"), F.asc(key)).limit(limit)
    # At most ``limit`` rows are left here, so one task is enough.
    latest = first.withColumn("_latest", F.max("window_start").over(Window.partitionBy()))
    return latest.where(F.col("window_start") == F.col("_latest")).drop("_latest") \
        .orderBy(F.desc("count"), F.asc(key)).limit(limit)


def _series(trend: DataFrame, key: str, value: str, size: int, limit: int,
            newest: bool) -> DataFrame:
    check_range("window_size_sec", size, 1)
    check_range("limit", limit, 1, 1000)
    rows = trend.where((F.col(key) == value) & (F.col("window_size_sec") == size)) \
        .select(*_columns(key))
    if not newest:
        return rows.orderBy("window_start").limit(limit)
    return rows.orderBy(F.desc("window_start")).limit(limit).orderBy("window_start")
