from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from hiretide.operators import dashboard
from hiretide.operators.reads import (role_timeseries, search_jobs, tech_timeseries, top_roles,
                                      top_techs)
from hiretide.schemas import JOBS, TREND_ROLE, TREND_TECH

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def jobs(spark):
    rows = [(f"e{i:02d}", START + timedelta(minutes=i // 2), f"Acme {i}" if i % 2 else "50% Off_Co",
             "t", "Chicago, IL" if i % 3 else None, None, "Other" if i % 5 else "Data Engineer",
             "d", "u", ["go"]) for i in range(30)]
    return spark.createDataFrame(rows, JOBS)


def ids(df):
    return [r["event_id"] for r in df.collect()]


def test_newest_first_with_ties_by_id(jobs):
    assert ids(search_jobs(jobs, limit=4)) == ["e28", "e29", "e26", "e27"]
    assert ids(search_jobs(jobs, limit=2, offset=3)) == ["e27", "e24"]
    assert ids(search_jobs(jobs, limit=5, offset=28)) == ["e00", "e01"]
    assert search_jobs(jobs).columns == JOBS.fieldNames()


@pytest.mark.parametrize("company, n", [("acme", 15), ("ACME 1", 6), ("50%", 15), (r"50\%", 15),
                                        (r"50\% off\_co", 15), ("_cme", 15), ("", 30), (None, 30),
                                        (r"\acme", 15), ("nope", 0), ("co\\", 0)])
def test_company(jobs, company, n):
    assert search_jobs(jobs, company=company, limit=200).count() == n


def test_all_terms_hold(jobs):
    got = search_jobs(jobs, company="acme", location="chicago", role_category="Other", limit=200)
    wanted = jobs.where("company LIKE 'Acme%' AND location IS NOT NULL "
                        "AND role_category = 'Other'")
    assert sorted(ids(got)) == sorted(ids(wanted))
    assert search_jobs(jobs, seniority="senior").isEmpty()
    assert search_jobs(jobs, role_category="other").isEmpty()


@pytest.mark.parametrize("bad", [{"limit": 0}, {"limit": 201}, {"offset": -1}])
def test_page_bounds(jobs, bad):
    with pytest.raises(ValueError):
        search_jobs(jobs, **bad)


def frame(spark, rows, schema=TREND_TECH):
    return spark.createDataFrame(
        [(START + timedelta(seconds=s * w), START + timedelta(seconds=s * (w + 1)), s, k, n)
         for w, s, k, n in rows], schema)


def test_top_of_latest(spark):
    trend = frame(spark, [(0, 300, "go", 99), (1, 300, "sql", 2), (1, 300, "java", 2),
                          (1, 300, "go", 5), (9, 60, "dbt", 7)])
    got = [(r["tech"], r["count"]) for r in top_techs(trend).collect()]
    assert got == [("go", 5), ("java", 2), ("sql", 2)]
    assert [r["tech"] for r in top_techs(trend, limit=2).collect()] == ["go", "java"]
    assert [r["tech"] for r in top_techs(trend, 60).collect()] == ["dbt"]
    assert top_techs(trend, 77).isEmpty()
    assert top_techs(trend.limit(0)).isEmpty()


def test_top_roles(spark):
    trend = frame(spark, [(0, 300, "Other", 9), (1, 300, "Data Engineer", 1)], TREND_ROLE)
    assert [r["role_category"] for r in top_roles(trend).collect()] == ["Data Engineer"]


def test_series(spark):
    trend = frame(spark, [(w, 300, "go", w + 1) for w in range(6)] + [(1, 300, "sql", 9)])

    def points(**options):
        return [r["count"] for r in tech_timeseries(trend, "go", **options).collect()]

    assert points() == [1, 2, 3, 4, 5, 6]
    assert points(limit=2) == [1, 2]
    assert points(limit=2, newest=True) == [5, 6]
    assert points(window_size_sec=60) == []
    roles = frame(spark, [(0, 300, "Other", 3)], TREND_ROLE)
    assert [r["count"] for r in role_timeseries(roles, "Other").collect()] == [3]


@pytest.mark.parametrize("call", [
    lambda t: top_techs(t, 0), lambda t: top_techs(t, limit=0), lambda t: top_techs(t, limit=101),
    lambda t: tech_timeseries(t, "go", 0), lambda t: tech_timeseries(t, "go", limit=1001)])
def test_trend_bounds(spark, call):
    with pytest.raises(ValueError):
        call(frame(spark, [(0, 300, "go", 1)]))


def test_snapshot(spark, jobs):
    tech = frame(spark, [(0, 300, "go", 1), (0, 300, "python", 2)])
    role = frame(spark, [(0, 300, "Other", 3)], TREND_ROLE)
    shown = dashboard.snapshot(jobs, tech, role, location="  chicago ", role=" ")
    assert {k: v.count() for k, v in shown.items()} == {
        "jobs": 20, "top_techs": 2, "top_roles": 1, "series": 1}
    points = dashboard.charts(shown)
    assert points["series"].first().asDict() == {"window_start": "00:00:00", "count": 2}
    assert points["top_roles"].columns == ["role_category", "count"]
    other = dashboard.snapshot(jobs, tech, role, tech="go")["series"]
    assert other.first()["tech"] == "go"
    empty = dashboard.charts(dashboard.snapshot(jobs.where(F.col("location").isNull()), tech, role))
    assert {r["location"] for r in empty["jobs"].collect()} == {"-"}
