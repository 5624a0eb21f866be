"""Counts worked out beforehand for the derived postings at sf 0.01."""

from pyspark.sql import functions as F

from hiretide.operators.reads import search_jobs, top_techs
from hiretide.operators.tagging import add_techs
from hiretide.operators.trends import role_trend, tech_trend
from hiretide.plans import fixture as fx

SF = "/root/testdata/sf0.01"


def test_tag_counts(spark):
    jobs = fx.jobs(spark, SF)
    got = jobs.agg(F.count("*"), F.count_if(F.col("role_category") == "Other"),
                   F.count_if(F.size("techs") == 0), F.count_if(F.col("title").isNull())).first()
    assert tuple(got) == (10_000, 1_380, 527, 589)


def test_trend_sizes(spark):
    jobs = fx.jobs(spark, SF)
    assert tech_trend(jobs).count() == 32_453
    assert tech_trend(jobs, 86_400).count() == 510
    assert role_trend(jobs).count() == 7_907
    assert role_trend(jobs, 86_400).count() == 330


def test_top_of_last_day(spark):
    first = top_techs(tech_trend(fx.jobs(spark, SF), 86_400), 86_400).first()
    assert (first["tech"], first["count"]) == ("docker", 169)


def test_search_matches(spark):
    jobs = fx.jobs(spark, SF)
    role = "Data Engineer"
    matches = jobs.where(F.col("location").ilike("%chicago%") & (F.col("role_category") == role))
    assert matches.count() == 123
    assert search_jobs(jobs, location="chicago", role_category=role, limit=20,
                       offset=110).count() == 13


def test_counts_agree_with_their_rows(spark):
    jobs = fx.jobs(spark, SF)
    role_sum = role_trend(jobs).agg(F.sum("count")).first()[0]
    tech_sum = tech_trend(jobs).agg(F.sum("count")).first()[0]
    assert role_sum == jobs.where("ingested_at IS NOT NULL").count()
    assert tech_sum == jobs.agg(F.sum(F.size("techs"))).first()[0]
    keys = ["window_start", "window_size_sec", "tech"]
    assert tech_trend(jobs).groupBy(keys).count().where("count > 1").isEmpty()


def test_duplicate_keyword_counts_twice(spark):
    rows = fx.with_texts(fx.postings(spark, SF))
    once = add_techs(rows).where(F.array_contains("techs", "docker")).count()
    twice = tech_trend(add_techs(rows, distinct=False)).where("tech = 'docker'")
    assert twice.agg(F.sum("count")).first()[0] == 2 * once
