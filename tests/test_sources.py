import json
import random

import pytest
from pyspark.sql import functions as F

from hiretide import vocab
from hiretide.sources.event_stream import EventFiles, KafkaTopic, read_event_stream
from hiretide.operators.events import parse_events, to_events
from hiretide.sources.generate import generate_n_postings
from hiretide.sources.jdbc import JdbcSink, Split, export_table, postgres_options
from hiretide.sources.postings import parse_postings


def test_kafka_options():
    topic = KafkaTopic.from_env({"KAFKA_BOOTSTRAP": "b:1"}, max_per_batch=5,
                                options={"failOnDataLoss": "false"})
    assert topic.read_options() == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "job_postings_raw",
        "startingOffsets": "earliest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "5"}
    assert KafkaTopic("b:2").write_options()["topic"] == "job_postings_raw"
    assert KafkaTopic("b:2").write_options()["kafka.bootstrap.servers"] == "b:2"
    with pytest.raises(KeyError):
        KafkaTopic.from_env({})


def test_postgres_options():
    options = postgres_options({"POSTGRES_HOST": "h", "POSTGRES_DB": "d", "POSTGRES_USER": "u",
                                "POSTGRES_PASSWORD": "p"})
    assert options["url"] == "jdbc:postgresql://h:5432/d"
    assert Split("id", "0", "9", 3).options() == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "3"}
    with pytest.raises(KeyError):
        postgres_options({})


def test_event_files_stream(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\n")
    df = read_event_stream(spark, EventFiles(str(tmp_path), 2))
    assert df.isStreaming and df.columns == ["value"]


def test_generated_postings(spark):
    rows = generate_n_postings(spark, 2000, seed=3).collect()
    assert rows == generate_n_postings(spark, 2000, seed=3).collect()
    assert rows != generate_n_postings(spark, 2000, seed=4).collect()
    for name, values in (("company", vocab.SAMPLE_COMPANIES), ("title", vocab.SAMPLE_TITLES),
                         ("location", vocab.SAMPLE_LOCATIONS)):
        share = [sum(r[name] == v for r in rows) * len(values) / len(rows) for v in values]
        assert min(share) > .7 and max(share) < 1.3
    assert len({r["description"] for r in rows}) == 40
    first = rows[0]
    assert first["url"] == (f"https://jobs.example.com/{first['company'].lower().replace(' ', '-')}/"
                            f"{first['title'].lower().replace(' ', '-')}-0")


def test_generated_postings_of_huge_ids(spark):
    ids = spark.range(9_000_000_000_000_000_000, 9_000_000_000_000_000_010)
    from hiretide.sources.generate import generate_postings
    assert generate_postings(ids).where("title IS NOT NULL").count() == 10


def test_jdbc_writers_deal_rows_to_their_connections(spark, monkeypatch):
    """What reaches the writer; there is no database to write to."""
    from pyspark.sql import DataFrameWriter

    seen = {}
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, k, v: seen.update({k: v}) or self)
    monkeypatch.setattr(DataFrameWriter, "options", lambda self, **o: seen.update(o) or self)
    monkeypatch.setattr(DataFrameWriter, "mode", lambda self, m: seen.update(mode=m) or self)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: seen.update(
        parts=self._df.rdd.getNumPartitions(), columns=self._df.columns))
    rows = spark.range(100).withColumn("bucket", F.lit(1))
    export_table(rows, "t", {"url": "u"}, 3)
    assert seen == {"url": "u", "numPartitions": "3", "dbtable": "t", "mode": "overwrite",
                    "truncate": "true", "parts": 3, "columns": ["id", "bucket"]}
    seen.clear()
    JdbcSink({"url": "u"}, "x_", 2).append(rows, "jobs", 7)
    assert seen == {"url": "u", "numPartitions": "2", "dbtable": "x_jobs", "mode": "append",
                    "parts": 2, "columns": ["id", "batch_id"]}


def test_a_line_is_one_whole_value_or_a_reject(spark):
    """Against a strict reader, on lines that try to end the wrappers early."""
    chosen = random.Random(6)
    parts = ['{"title":"x"}', "]", "[", "}", "{", ",", "1", '"]"', '"}"', ' garbage', '"a":', ":", "[2]",
             '{"title":"a ]} b"}', "null", '"v":1', " "]
    lines = ['{"title":"x"}] garbage', '{"title":"x"}],[{"title":"y"}', "1],[2", '1},{"v":2',
             '{"title":"a ]} b"}', '{"title":"[{"}', "[]", "{}", '"text"', '{"title":"x"}}', "]", "}"]
    lines += ["".join(chosen.choice(parts) for _ in range(chosen.randint(1, 6))) for _ in range(1500)]

    def whole(line):
        try:
            json.loads(line)
            return True
        except ValueError:
            return False

    lines = [x for x in lines if x.strip()]
    good, rejects = parse_postings(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted(r["line"] for r in good.collect()) == sorted(x.strip() for x in lines if whole(x))
    assert sorted(r["line"] for r in rejects.collect()) == sorted(
        x.strip() for x in lines if not whole(x))
    events = parse_events(to_events(good))
    assert events.where("raw IS NULL").count() == sum(map(whole, lines))
    assert {r["title"] for r in good.collect()} >= {"x", "a ]} b", "[{"}


def test_name_uuid_is_that_of_the_standard_library(spark):
    import uuid

    from pyspark.sql import functions as F

    from hiretide.functions.ids import name_uuid
    names = ["", "python.org", "漢字", "a\nb", *(f"n{i}" for i in range(200)), None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    for space in (uuid.NAMESPACE_DNS, uuid.NAMESPACE_URL):
        got = df.select("name", name_uuid(space, F.col("name")).alias("id")).collect()
        assert all(r["id"] == (None if r["name"] is None else str(uuid.uuid5(space, r["name"]))) for r in got)


def test_a_folder_read_twice_gives_the_same_ids(spark, tmp_path):
    from hiretide.operators.events import parse_events, to_events
    from hiretide.sources.postings import named_postings, read_postings
    from hiretide.streaming.tables import init_tables

    lines = ['{"title":"a"}'] * 40 + ['{"title":"b"}', " {\"title\":\"b\"} ", "broken"]
    for name in ("x", "y"):
        (tmp_path / name).write_text("\n".join(lines))

    def ids(partitions):
        good, _ = read_postings(spark, str(tmp_path), files=True)
        return named_postings(good.repartition(partitions))

    first, second = ids(1), ids(7)
    assert sorted(r["event_id"] for r in first.collect()) == sorted(r["event_id"] for r in second.collect())
    assert first.select("event_id").distinct().count() == 2 * 42
    jobs = init_tables(spark, str(tmp_path / "tables")).jobs
    for n, named in enumerate((first, second)):
        events = to_events(named.drop("file"), id_col="event_id")
        fixed = events.selectExpr("regexp_replace(value, 'ingested_at\":\"[^\"]*', "
                                  "'ingested_at\":\"2024-01-01T00:00:00Z') AS value")
        from hiretide.operators.tagging import enrich
        jobs.append_batch(enrich(parse_events(fixed)), n)
    assert jobs.read().count() == 84 and jobs.brought(1).isEmpty()


def test_offset_audit(spark):
    from hiretide.sources.offsets import RANGES, offset_audit, offset_ranges

    ranges = spark.createDataFrame([
        ("t", 0, 0, 9, 10), ("t", 0, 12, 19, 8), ("t", 0, 18, 25, 8), ("t", 0, 20, 22, 3), ("t", 1, 5, 9, 4),
        ("t", 1, 10, 10, 2), ("u", 0, 0, 0, 1)], RANGES)
    assert sorted(tuple(r) for r in offset_audit(ranges).collect()) == [
        ("gap", "t", 0, 10, 11, 2), ("long", "t", 1, 10, 10, 1), ("overlap", "t", 0, 18, 19, 2),
        ("overlap", "t", 0, 20, 22, 3), ("short", "t", 1, 5, 9, 1)]
    rows = spark.range(100).selectExpr("'t' AS topic", "CAST(id % 3 AS INT) AS partition", "id AS offset")
    assert sorted(tuple(r) for r in offset_ranges(rows).collect()) == [
        ("t", 0, 0, 99, 34), ("t", 1, 1, 97, 33), ("t", 2, 2, 98, 33)]
    assert offset_audit(ranges.limit(0)).collect() == []


@pytest.mark.parametrize("counts, wanted", [("totals", 5), ("deltas", 8), ("first", 3)])
def test_upsert_statements_apply_a_batch_once(counts, wanted):
    """The statements in a database of this process; PostgreSQL, for which they are, was not run."""
    import duckdb

    from hiretide.sources.jdbc import upsert_statements
    con = duckdb.connect()
    con.execute("CREATE TABLE trend (window_start INT, tech TEXT, window_end INT, count BIGINT, "
                "PRIMARY KEY (window_start, tech))")
    con.execute("CREATE TABLE applied_batches (name TEXT, batch_id BIGINT, PRIMARY KEY (name, batch_id))")
    con.execute("CREATE TABLE trend_stage AS SELECT 0 AS window_start, 'go' AS tech, 5 AS window_end, 3 AS count")
    columns, keys = ["window_start", "tech", "window_end", "count"], ["window_start", "tech"]

    def apply(batch, broken=False):
        con.execute("BEGIN")
        for i, statement in enumerate(upsert_statements("trend", "trend_stage", columns, keys, batch, counts)):
            if broken and i:
                con.execute("ROLLBACK")
                return
            con.execute(statement)
        con.execute("COMMIT")

    apply(0, broken=True)
    assert con.execute("SELECT count(*) FROM trend").fetchone() == (0,)
    apply(0)
    apply(0)
    con.execute("UPDATE trend_stage SET count = 5")
    con.execute("INSERT INTO trend_stage VALUES (5, 'sql', 10, 1)")
    for _ in range(2):
        apply(1)
    assert con.execute("SELECT * FROM trend ORDER BY 1").fetchall() == [(0, "go", 5, wanted), (5, "sql", 10, 1)]


def test_what_an_upsert_stages_and_runs(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from hiretide.sources.jdbc import JdbcUpsert
    seen, ran = [], []
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: seen.append(self._df.columns))
    monkeypatch.setattr(JdbcUpsert, "execute", lambda self, session, statements: ran.extend(statements))
    df = spark.createDataFrame([("a", 1, 2)], "event_id string, ingest_date int, batch_id long")
    JdbcUpsert({"url": "jdbc:none"}, "x_").append(df, "jobs", 4)
    assert seen == [["event_id"]]
    assert ran[0].startswith("INSERT INTO x_jobs (event_id) SELECT event_id FROM x_jobs_stage WHERE NOT EXISTS")
    assert ran[0].endswith("ON CONFLICT (event_id) DO NOTHING") and "x_applied_batches" in ran[1]
