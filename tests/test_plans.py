"""The plans are the ones that hold at scale."""

import re

import pytest

from hiretide.operators.events import parse_events
from hiretide.operators.tagging import add_techs
from hiretide.operators.trends import tech_trend
from hiretide.plans import fixture as fx
from hiretide.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
PLAIN = [n for n in QUERIES if not n.startswith(("stream", "read_postings", "drawn"))]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAIN)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name].run(spark, SF))
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", text)


@pytest.mark.parametrize("name", ["search_jobs_default_page", "search_jobs_location_role"])
def test_search_is_a_top_k_without_shuffle(spark, name):
    text = plan(QUERIES[name].run(spark, SF))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_top_of_latest_counts_once(spark):
    text = plan(QUERIES["top_techs_latest"].run(spark, SF))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1
    assert "TakeOrderedAndProject" in text


def test_trend_is_counted_before_the_shuffle_and_tagged_once(spark):
    text = plan(tech_trend(fx.jobs(spark, SF)))
    assert "partial_count" in text and text.count("Exchange") == 1
    assert text.count("Contains(") == len(fx.KEYWORDS)


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["role_trend_300s"].run(spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_events_are_read_once(spark, tmp_path):
    (tmp_path / "a").write_text("{}\n")
    trend = tech_trend(add_techs(parse_events(spark.read.text(str(tmp_path)))))
    assert plan(trend).count("from_json") == 1


def test_trend_reads_are_filtered_at_the_file(spark, tmp_path):
    from hiretide.operators.reads import tech_timeseries
    from hiretide.streaming.tables import init_tables
    table = init_tables(spark, str(tmp_path)).trend_tech
    table.append_batch(tech_trend(fx.jobs(spark, SF)).selectExpr(
        "CAST(window_start AS TIMESTAMP) window_start", "CAST(window_end AS TIMESTAMP) window_end",
        "window_size_sec", "tech", "count"), 0)
    text = plan(tech_timeseries(table.read(), "python"))
    assert "EqualTo(tech,python)" in text and "EqualTo(window_size_sec,300)" in text
    table.merge()
    text = plan(tech_timeseries(table.read(), "python"))
    assert "EqualTo(tech,python)" in text
    assert "window_size_sec" in text.split("PartitionFilters: ")[1].split("]")[0]


def test_a_recount_is_worked_out_once(spark):
    df = QUERIES["replace_range_backfill"].run(spark, SF)
    df.collect()
    text = plan(df)
    final = text[:text.index("\n+- == Initial Plan")]
    # Existing counts, stale ones and the recount read postings; the range comes from times alone.
    assert final.count("ReadSchema: struct<event_id") <= 3
    assert "ReadSchema: struct<ts:timestamp_ntz>" in final and "ReusedSubquery" in final


def test_no_intermediate_data_in_machine_folders():
    import pathlib

    import hiretide
    for source in pathlib.Path(hiretide.__file__).parent.rglob("*.py"):
        assert "tempfile" not in source.read_text() and "localCheckpoint" not in source.read_text()
