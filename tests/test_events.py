from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hiretide.operators.events import parse_events, split_rejects, to_events
from hiretide.operators.tagging import enrich
from hiretide.sources.postings import parse_postings, read_postings

TIME = "2024-01-01T10:03:00+00:00"


def parsed(spark, *values):
    return parse_events(spark.createDataFrame([(v,) for v in values], "value string"))


def event(more='"posting": {"title": "t"}', event_id='"e"', at=f'"{TIME}"'):
    return f'{{"event_id": {event_id}, "ingested_at": {at}, {more}}}'


@pytest.mark.parametrize("value", ["not json", None, ""])
def test_unreadable_is_kept_as_reject(spark, value):
    row = enrich(parsed(spark, value)).first()
    assert (row["event_id"], row["ingested_at"], row["title"]) == (None, None, None)
    assert (row["role_category"], row["techs"], row["raw"]) == ("Other", [], value or "")


def test_posting_missing(spark):
    row = parsed(spark, event('"source": "x"')).first()
    assert row["event_id"] == "e" and row["title"] is None and row["raw"] is None


@pytest.mark.parametrize("json, text", [("5", "5"), ('["a"]', '["a"]'), ('{"b": 1}', '{"b":1}')])
def test_other_types_become_their_text(spark, json, text):
    assert parsed(spark, event(f'"posting": {{"title": {json}}}')).first()["title"] == text


def test_unknown_fields_are_ignored(spark):
    row = parsed(spark, event('"posting": {"title": "t", "techs": ["x"], "role": 1}, "y": 2'))
    assert row.columns == ["event_id", "ingested_at", "company", "title", "location",
                           "description", "url", "title_l", "desc_l", "raw"]


@pytest.mark.parametrize("at, clock", [
    ("2024-01-01T12:03:00+02:00", datetime(2024, 1, 1, 10, 3)),
    ("2024-01-01T10:03:00Z", datetime(2024, 1, 1, 10, 3)),
    ("2024-01-01T10:03:00.25+00:00", datetime(2024, 1, 1, 10, 3, 0, 250000)),
    ("bad", None)])
def test_times(spark, at, clock):
    assert parsed(spark, event(at=f'"{at}"')).first()["ingested_at"] == clock


def test_split(spark):
    good, bad = split_rejects(parsed(spark, event(), event(event_id="null"), event(at='"x"'), None))
    assert good.count() == 1 and bad.count() == 3


def test_bytes(spark):
    df = spark.createDataFrame([(event().encode(),)], "value binary")
    assert parse_events(df).first()["event_id"] == "e"


def test_round_trip_of_any_text(spark):
    rows = [("1", datetime(2024, 1, 1, 0, 0), 'a "quoted" \\ text', "Zürich\n\t日本"),
            ("2", datetime(2024, 1, 1, 0, 0, 0, 5), None, "")]
    df = spark.createDataFrame(rows, "id string, at timestamp, title string, location string")
    df = df.selectExpr("*", "CAST(NULL AS STRING) company", "title description", "title url")
    events = to_events(df, id_col="id", time_col="at")
    got = parse_events(events).orderBy("event_id").collect()
    assert [(r["event_id"], r["ingested_at"], r["title"], r["location"]) for r in got] == rows
    assert events.where("value LIKE '%2024-01-01T00:00:00+00:00%'").count() == 1
    assert events.where("value LIKE '%2024-01-01T00:00:00.000005+00:00%'").count() == 1


def test_random_ids_and_present_time(spark):
    good, _ = parse_postings(spark.createDataFrame([('{"title": "x"}',)] * 50, "value string"))
    got = parse_events(to_events(good)).select("event_id", "ingested_at").collect()
    assert len({r["event_id"] for r in got}) == 50
    assert all(len(r["event_id"]) == 36 and r["ingested_at"] is not None for r in got)


def test_lines(spark, tmp_path):
    lines = ['{"title": "ok", "company": "é"}', "", "   ", " 　", '{"title": "open"',
             '  {"title": "padded"}\t', "5", "null", "[1, 2]", '"text"', '{"title": "a"} more',
             '{"title": "a"}, {"title": "b"}', "{'title': 'single'}", "{}", "plain"]
    (tmp_path / "a.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
    good, bad = read_postings(spark, str(tmp_path))
    assert sorted(r["line"] for r in good.collect()) == sorted(
        ['{"title": "ok", "company": "é"}', '{"title": "padded"}', "5", "null", "[1, 2]", '"text"',
         "{}"])
    assert sorted(r["title"] for r in good.where("title IS NOT NULL").collect()) == ["ok", "padded"]
    assert sorted(r["line"] for r in bad.collect()) == sorted(
        ['{"title": "open"', '{"title": "a"} more', '{"title": "a"}, {"title": "b"}',
         "{'title': 'single'}", "plain"])


def test_line_goes_into_the_event_unchanged(spark):
    good, _ = parse_postings(spark.createDataFrame([('{"title": "x", "own": [1]}',)], "value string"))
    value = to_events(good.withColumn("id", F.lit("7")), id_col="id").first()["value"]
    assert value.endswith(',"posting":{"title": "x", "own": [1]}}')
    assert '"event_id":"7"' in value and '"source":"jsonl"' in value
