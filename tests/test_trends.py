from datetime import datetime, timedelta, timezone

import pytest

from hiretide.operators.replace import replace_range
from hiretide.operators.trends import role_trend, tech_trend

ROW = "ingested_at timestamp, role_category string, techs array<string>"


def utc(*args):
    return datetime(*args, tzinfo=timezone.utc)


def counts(df, key):
    return {(r["window_start"], r[key]): r["count"] for r in df.collect()}


def test_windows_are_half_open_and_aligned(spark):
    at = [utc(2024, 1, 1, 12, 0), utc(2024, 1, 1, 12, 5) - timedelta(microseconds=1),
          utc(2024, 1, 1, 12, 5), utc(1969, 12, 31, 23, 59), None]
    df = spark.createDataFrame([(t, "Other", ["go"]) for t in at], ROW)
    wanted = {(datetime(2024, 1, 1, 12, 0), "Other"): 2, (datetime(2024, 1, 1, 12, 5), "Other"): 1,
              (datetime(1969, 12, 31, 23, 55), "Other"): 1}
    assert counts(role_trend(df), "role_category") == wanted
    assert counts(tech_trend(df), "tech") == {(w, "go"): n for (w, _), n in wanted.items()}


def test_no_tags_no_count(spark):
    df = spark.createDataFrame([(utc(2024, 1, 1), "Other", []), (utc(2024, 1, 1), "Other", None),
                                (utc(2024, 1, 1), "Other", ["go", "sql"])], ROW)
    assert counts(tech_trend(df), "tech") == {(datetime(2024, 1, 1), "go"): 1,
                                              (datetime(2024, 1, 1), "sql"): 1}


@pytest.mark.parametrize("sec", [1, 300, 86_400])
def test_window_sizes(spark, sec):
    df = spark.createDataFrame([(utc(2024, 1, 1, 12, 0, 7), "Other", ["go"])], ROW)
    row = role_trend(df, sec).first()
    assert row["window_end"] - row["window_start"] == timedelta(seconds=sec)
    assert row["window_size_sec"] == sec
    assert [f.dataType.simpleString() for f in role_trend(df, sec).schema] == [
        "timestamp", "timestamp", "int", "string", "bigint"]


def test_bad_window(spark):
    with pytest.raises(ValueError):
        role_trend(spark.createDataFrame([], ROW), 0)


TREND = "window_start timestamp, window_end timestamp, window_size_sec int, tech string, count long"


def trend(spark, *rows):
    return spark.createDataFrame(
        [(utc(2024, 1, 1, 12, m), utc(2024, 1, 1, 12, m) + timedelta(seconds=s), s, k, n)
         for m, s, k, n in rows], TREND)


def test_replace_range(spark):
    old = trend(spark, (0, 300, "go", 1), (5, 300, "go", 2), (5, 300, "sql", 3), (10, 300, "go", 4),
                (15, 300, "go", 5), (5, 60, "go", 9))
    new = trend(spark, (5, 300, "java", 7), (10, 300, "go", 8))
    got = {(r["window_start"].minute, r["window_size_sec"], r["tech"], r["count"])
           for r in replace_range(old, new, 300).collect()}
    assert got == {(0, 300, "go", 1), (5, 300, "java", 7), (10, 300, "go", 8), (15, 300, "go", 5),
                   (5, 60, "go", 9)}


def test_replace_by_nothing(spark):
    old = trend(spark, (0, 300, "go", 1))
    assert replace_range(old, old.limit(0), 300).count() == 1
