"""Every query by name: the Spark plan and, beside it, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiretide import vocab
from hiretide.functions.ids import POSTINGS
from hiretide.functions.text import lowered
from hiretide.functions.times import utc_clock
from hiretide.operators import dashboard
from hiretide.operators.events import parse_events, to_events
from hiretide.operators.reads import (cursor_of, role_timeseries, search_jobs, tech_timeseries, top_roles,
                                      top_techs)
from hiretide.operators.replace import replace_range
from hiretide.operators.rules import find_patterns, first_of, tags_of
from hiretide.operators.tagging import add_role_category, add_techs, enrich
from hiretide.operators.trends import role_trend, tech_trend
from hiretide.plans import fixture as fx
from hiretide.schemas import JOBS
from hiretide.sources.event_stream import EventFiles
from hiretide.sources.generate import PRIME, SPREAD, STEP, generate_postings
from hiretide.sources.postings import named_postings, parse_postings, read_postings
from hiretide.streaming.publish import publish
from hiretide.streaming.tables import init_tables, reset

DAY = 86_400
SEED = 7


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None):
    """Register a function under its name, with the SQL it must agree with."""
    def register(run):
        QUERIES[run.__name__] = Query(run, sql)
        return run
    return register


def flat(jobs: DataFrame) -> DataFrame:
    """Job rows with the tags as one text, so that they can be compared."""
    return jobs.select("event_id", "ingested_at", "company", "title", "location", "seniority",
                       "role_category", "description", "url",
                       F.array_join("techs", ",").alias("techs"))


def clocked(df: DataFrame, *names: str) -> DataFrame:
    """Instants as UTC wall-clock times, as the given tables hold them."""
    return df.withColumns({n: utc_clock(F.col(n)) for n in names or ("window_start", "window_end")})


FLAT = """SELECT event_id, ingested_at, company, title, location, seniority, role_category,
  description, url, array_to_string(techs, ',') AS techs FROM tagged"""
TAGGED = f"WITH {fx.tagged_sql()}"
TREND = "SELECT window_start, window_end, window_size_sec, {key}, count FROM trend"


def trend(key: str, sec: int, select: str | None = None) -> str:
    return f"{TAGGED}, {fx.trend_sql(key, sec)} {select or TREND.format(key=key)}"


# --- tags ------------------------------------------------------------------------------------

@query(f"{TAGGED} SELECT event_id, title, role_category FROM tagged")
def tag_role_category(spark, sf):
    rows = fx.with_texts(fx.postings(spark, sf))
    return add_role_category(rows).select("event_id", "title", "role_category")


@query(f"{TAGGED} SELECT event_id, array_to_string(techs, ',') AS techs FROM tagged")
def tag_techs(spark, sf):
    rows = add_techs(fx.with_texts(fx.postings(spark, sf)))
    return rows.select("event_id", F.array_join("techs", ",").alias("techs"))


@query(f"""{TAGGED}, words AS (SELECT event_id, regexp_split_to_array(
    lower(coalesce(title, '') || ' ' || coalesce(description, '')), '[^a-z0-9_]+') AS found
  FROM postings)
SELECT event_id, array_to_string(list_filter({fx.text_list(fx.KEYWORDS)},
  lambda k: list_contains(found, k)), ',') AS techs FROM words""")
def tag_techs_whole_words(spark, sf):
    rows = add_techs(fx.with_texts(fx.postings(spark, sf)), match="word")
    return rows.select("event_id", F.array_join("techs", ",").alias("techs"))


@query(f"""WITH tagged AS (
  SELECT lang, {fx.techs_sql("lower(coalesce(text, ''))")} AS techs FROM documents)
SELECT lang, tech, count(*) AS count FROM (SELECT lang, unnest(techs) AS tech FROM tagged)
GROUP BY lang, tech""")
def tag_techs_documents(spark, sf):
    """Keyword tags over the long texts of the documents table."""
    docs = fx.table(spark, sf, "documents").select("lang", lowered(F.col("text")).alias("text_l"))
    tagged = add_techs(docs, text=("text_l",))
    return tagged.select("lang", F.explode_outer("techs").alias("tech")) \
        .where("tech IS NOT NULL").groupBy("lang", "tech").count()


@query(f"{TAGGED} SELECT event_id, array_to_string(techs, ',') AS techs FROM tagged WHERE len(techs) > 0")
def tag_techs_by_rules(spark, sf):
    """The keywords as a table of patterns; postings without any have no row."""
    rows = fx.with_texts(fx.postings(spark, sf))
    texts = rows.select("event_id", F.concat_ws("\n", "title_l", "desc_l").alias("text"))
    keywords = spark.createDataFrame(list(enumerate(fx.KEYWORDS)), "place int, pattern string")
    tags = tags_of(find_patterns(texts, keywords, "text"), ["event_id"], "pattern", "place")
    return tags.select("event_id", F.array_join("tags", ",").alias("techs"))


@query(f"""{TAGGED}
SELECT event_id, role_category FROM tagged WHERE role_category <> {fx.text(vocab.OTHER_ROLE)}""")
def tag_roles_by_rules(spark, sf):
    """The role rules as a table: the first that stands in the title."""
    rows = fx.with_texts(fx.postings(spark, sf)).select("event_id", "title_l")
    rules = spark.createDataFrame([(i, p, label) for i, (p, label) in enumerate(vocab.ROLE_RULES)],
                                  "place int, pattern string, role_category string")
    return first_of(find_patterns(rows, rules, "title_l"), ["event_id"], "role_category", "place")


BENCHMARK_WORDS = """words AS (SELECT DISTINCT pattern FROM (
  SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS pattern FROM benchmark) WHERE length(pattern) > 3)"""


def benchmark_words(spark, sf):
    words = fx.table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all(
        F.lower("text"), F.lit("([a-z]+)"), F.lit(1))).alias("pattern"))
    return words.where("length(pattern) > 3").distinct()


@query(f"""WITH {BENCHMARK_WORDS} SELECT pattern, lang, count(*) AS documents
FROM documents JOIN words ON contains(lower(text), pattern) GROUP BY pattern, lang""")
def find_benchmark_words(spark, sf):
    """Patterns out of one table, each word of the benchmark texts, in the long texts of another."""
    docs = fx.table(spark, sf, "documents").select("lang", F.lower("text").alias("text_l"))
    found = find_patterns(docs, benchmark_words(spark, sf), "text_l")
    return found.groupBy("pattern", "lang").agg(F.count("*").alias("documents"))


@query(f"""WITH {BENCHMARK_WORDS}, found AS (SELECT lang, list_distinct(regexp_extract_all(
    lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS own FROM documents)
SELECT pattern, lang, count(*) AS documents FROM (SELECT lang, unnest(own) AS pattern FROM found)
JOIN words USING (pattern) GROUP BY pattern, lang""")
def find_benchmark_whole_words(spark, sf):
    """The same as whole words, with patterns too many to be sent to every task: joined by key."""
    docs = fx.table(spark, sf, "documents").select("lang", F.lower("text").alias("text_l"))
    found = find_patterns(docs, benchmark_words(spark, sf), "text_l", match="word", most_broadcast=0)
    return found.groupBy("pattern", "lang").agg(F.count("*").alias("documents"))


# --- trends ----------------------------------------------------------------------------------

@query(trend("tech", 300))
def tech_trend_300s(spark, sf):
    return tech_trend(fx.jobs(spark, sf))


@query(trend("tech", DAY))
def tech_trend_day(spark, sf):
    return tech_trend(fx.jobs(spark, sf), DAY)


@query(trend("role_category", 300))
def role_trend_300s(spark, sf):
    return role_trend(fx.jobs(spark, sf))


@query(trend("role_category", DAY))
def role_trend_day(spark, sf):
    return role_trend(fx.jobs(spark, sf), DAY)


@query(f"""WITH {fx.tagged_sql(vocab.TECH_KEYWORDS)}, {fx.trend_sql("tech", 300)}
{TREND.format(key="tech")}""")
def tech_trend_duplicate_keyword(spark, sf):
    """A keyword listed twice counts twice."""
    return tech_trend(add_techs(fx.with_texts(fx.postings(spark, sf)), distinct=False))


# --- reads -----------------------------------------------------------------------------------

@query(trend("tech", DAY, fx.latest_sql("tech")))
def flagship_top_techs_latest_day(spark, sf):
    return top_techs(tech_trend(fx.jobs(spark, sf), DAY), DAY)


@query(trend("tech", 300, fx.latest_sql("tech")))
def top_techs_latest(spark, sf):
    return top_techs(tech_trend(fx.jobs(spark, sf)))


@query(trend("role_category", 300, fx.latest_sql("role_category")))
def top_roles_latest(spark, sf):
    return top_roles(role_trend(fx.jobs(spark, sf)))


@query(trend("role_category", DAY, fx.latest_sql("role_category", 5)))
def top_roles_latest_day(spark, sf):
    return top_roles(role_trend(fx.jobs(spark, sf), DAY), DAY, 5)


@query(trend("tech", 300, f"""{TREND.format(key='tech')} WHERE tech = 'python'
ORDER BY window_start LIMIT 100"""))
def tech_series(spark, sf):
    return tech_timeseries(tech_trend(fx.jobs(spark, sf)), "python")


@query(trend("role_category", 300, f"""{TREND.format(key='role_category')}
WHERE role_category = 'Devops Engineer' ORDER BY window_start DESC LIMIT 50"""))
def role_series_newest(spark, sf):
    return role_timeseries(role_trend(fx.jobs(spark, sf)), "Devops Engineer", limit=50, newest=True)


@query(trend("role_category", DAY, f"""{TREND.format(key='role_category')}
WHERE role_category = 'Data Engineer' ORDER BY window_start LIMIT 1000"""))
def role_series_day(spark, sf):
    return role_timeseries(role_trend(fx.jobs(spark, sf), DAY), "Data Engineer", DAY, 1000)


@query(f"{TAGGED} {FLAT} ORDER BY ingested_at DESC, event_id LIMIT 20")
def search_jobs_default_page(spark, sf):
    return flat(search_jobs(fx.jobs(spark, sf)))


@query(f"""{TAGGED} {FLAT} WHERE location ILIKE '%chicago%' AND role_category = 'Data Engineer'
ORDER BY ingested_at DESC, event_id LIMIT 20 OFFSET 5""")
def search_jobs_location_role(spark, sf):
    return flat(search_jobs(fx.jobs(spark, sf), location="chicago", role_category="Data Engineer",
                            limit=20, offset=5))


@query(f"""{TAGGED} {FLAT} WHERE company ILIKE '%s_ark%LAB%'
ORDER BY ingested_at DESC, event_id LIMIT 200""")
def search_jobs_company_wildcard(spark, sf):
    return flat(search_jobs(fx.jobs(spark, sf), company="s_ark%LAB", limit=200))


SENIOR = """SELECT event_id, ingested_at, company, title, location,
  CASE WHEN title LIKE 'Senior %' THEN 'senior' WHEN title IS NOT NULL THEN 'regular' END
    AS seniority, role_category, description, url, array_to_string(techs, ',') AS techs
FROM tagged"""


@query(f"{TAGGED} SELECT * FROM ({SENIOR}) WHERE seniority = 'senior' "
       "ORDER BY ingested_at DESC, event_id LIMIT 20")
def search_jobs_seniority(spark, sf):
    """The column is empty in the pipeline's own tables, so it is filled from the titles here."""
    jobs = fx.jobs(spark, sf).withColumn(
        "seniority", F.when(F.col("title").startswith("Senior "), "senior")
        .when(F.col("title").isNotNull(), "regular"))
    return flat(search_jobs(jobs, seniority="senior"))


@query(f"""{TAGGED}, {fx.trend_sql("tech", 300)}, wide AS (
  SELECT time_bucket(INTERVAL '1 day', window_start) AS window_start, tech, sum(count)::BIGINT AS count
  FROM trend GROUP BY ALL)
SELECT window_start, window_start + INTERVAL '1 day' AS window_end, 86400 AS window_size_sec, tech, count FROM wide""")
def stream_rolled_days(spark, sf):
    """Day counts that merges have rolled up, with those of the batches that no merge has taken yet."""
    tables = fx.streamed(spark, sf, "stream_rolled_days", "single_pass", redelivered=True)
    return clocked(tables.trend_tech.rolled(DAY).drop("window_date"))


@query(f"{TAGGED}, {fx.trend_sql('tech', 3600)} {TREND.format(key='tech')}")
def stream_rolled_hours_recounted(spark, sf):
    """Hour counts of a stream that saw wrong tags for ten days, after a recount of these."""
    return clocked(recounted(spark, sf, "stream_rolled_hours_recounted").trend_tech.rolled(3600).drop(
        "window_date"))


DEEP = 900


@query(f"{TAGGED} {FLAT} ORDER BY ingested_at DESC, event_id LIMIT 50 OFFSET {DEEP}")
def search_jobs_deep_page(spark, sf):
    """A page behind many others, among the top rows of the tasks."""
    return flat(search_jobs(fx.jobs(spark, sf), limit=50, offset=DEEP))


VERY_DEEP = 9_970


@query(f"{TAGGED} {FLAT} ORDER BY ingested_at DESC, event_id LIMIT 50 OFFSET {VERY_DEEP}")
def search_jobs_counted_page(spark, sf):
    """A page behind so many others that it is found by counts."""
    return flat(search_jobs(fx.jobs(spark, sf), limit=50, offset=VERY_DEEP))


@query(f"""{TAGGED} {FLAT} WHERE location ILIKE '%remote%'
ORDER BY ingested_at DESC, event_id LIMIT 30 OFFSET 15""")
def search_jobs_next_page(spark, sf):
    """The page that follows a row, without counting what lies before it."""
    jobs = fx.jobs(spark, sf)
    last = search_jobs(jobs, location="remote", limit=15).orderBy(
        "ingested_at", F.desc("event_id")).first()
    return flat(search_jobs(jobs, location="remote", limit=30, after=cursor_of(last)))


# --- dashboard -------------------------------------------------------------------------------

def charts(spark, sf, **choice):
    jobs = fx.jobs(spark, sf)
    shown = dashboard.snapshot(jobs, tech_trend(jobs), role_trend(jobs), **choice)
    return dashboard.charts(shown)


@query(trend("tech", 300, """SELECT strftime(window_start, '%H:%M:%S') AS window_start, count
FROM (SELECT * FROM trend WHERE tech = 'kafka' ORDER BY window_start LIMIT 100)"""))
def dashboard_series(spark, sf):
    return charts(spark, sf, tech="kafka")["series"]


@query(trend("tech", 300, f"SELECT tech, count FROM ({fx.latest_sql('tech')})"))
def dashboard_top_techs(spark, sf):
    return charts(spark, sf)["top_techs"]


@query(trend("role_category", 300,
             f"SELECT role_category, count FROM ({fx.latest_sql('role_category')})"))
def dashboard_top_roles(spark, sf):
    return charts(spark, sf)["top_roles"]


@query(f"""{TAGGED} SELECT strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested_at,
  coalesce(company, '-') AS company, coalesce(title, '-') AS title,
  coalesce(location, '-') AS location, coalesce(role_category, '-') AS role_category
FROM (SELECT * FROM tagged WHERE location ILIKE '%remote%' AND role_category = 'Other'
      ORDER BY ingested_at DESC, event_id LIMIT 20)""")
def dashboard_jobs(spark, sf):
    return charts(spark, sf, location=" Remote ", role="Other")["jobs"]


# --- events ----------------------------------------------------------------------------------

@query(f"""WITH {fx.POSTINGS_SQL}
SELECT event_id, ingested_at, company, title, location, description, url FROM postings""")
def parse_events_roundtrip(spark, sf):
    """Postings wrapped as JSON events and parsed back."""
    events = to_events(fx.postings(spark, sf), id_col="event_id", time_col="ingested_at")
    return clocked(parse_events(events), "ingested_at").drop("title_l", "desc_l", "raw")


MALFORMED_CASES = 10


@query(f"""WITH c AS (SELECT *, event_id % {MALFORMED_CASES} AS c, CAST(event_id AS VARCHAR) AS id
  FROM events)
SELECT CASE WHEN c IN (3, 4, 8) THEN NULL ELSE id END AS event_id,
  CASE WHEN c IN (2, 3, 4) THEN NULL WHEN c = 6 THEN ts - INTERVAL '2 hours' ELSE ts END
    AS ingested_at,
  CASE WHEN c IN (1, 3, 4) THEN NULL WHEN c = 5 THEN id WHEN c = 7 THEN '["' || id || '"]'
    WHEN c = 9 THEN NULL ELSE 'Backend Engineer / Data Engineer ' || id END AS title,
  CASE WHEN c IN (0, 2, 6, 8) THEN 'Backend Engineer' ELSE 'Other' END AS role_category,
  CASE WHEN c IN (1, 3, 4, 9) THEN '' ELSE 'sql,postgres,java,node,go,scala' END AS techs,
  c IN (2, 3, 4, 8) AS rejected
FROM c""")
def parse_events_malformed(spark, sf):
    """What becomes of broken, incomplete and oddly typed events; one kind per id modulo 10."""
    i = F.col("event_id").cast("string")
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    title = F.concat(F.lit('"Backend Engineer / Data Engineer '), i, F.lit('"'))
    desc = ',"description":"JavaScript, MongoDB, PostgreSQL, nodejs, Scalable"'

    def event(time=F.concat(at, F.lit("Z")), title=title, more=""):
        return F.concat(F.lit('{"event_id":"'), i, F.lit('","ingested_at":"'), time,
                        F.lit('","posting":{"title":'), title, F.lit(desc + more + "}}"))

    kinds = [
        event(),
        F.concat(F.lit('{"ingested_at":"'), at, F.lit('+00:00","event_id":"'), i, F.lit('"}')),
        event(time=F.lit("bad")),
        F.concat(F.lit("not JSON "), i),
        F.lit(None).cast("string"),
        event(title=i),
        event(time=F.concat(at, F.lit("+02:00"))),
        event(title=F.concat(F.lit('["'), i, F.lit('"]')), more=',"seniority":"x"'),
        F.concat(F.lit('{"ingested_at":"'), at, F.lit('Z","posting":{"title":'), title,
                 F.lit(desc + "}}")),
        F.concat(F.lit('{"event_id":"'), i, F.lit('","ingested_at":"'), at,
                 F.lit('Z","posting":5}')),
    ]
    value = kinds[-1]
    for n, kind in enumerate(kinds[:-1]):
        value = F.when(F.col("event_id") % MALFORMED_CASES == n, kind).otherwise(value)
    raw = fx.table(spark, sf, "events").select(F.encode(value, "UTF-8").alias("value"))
    rows = enrich(parse_events(raw)).withColumn("rejected", F.col("raw").isNotNull())
    return clocked(rows, "ingested_at").select(
        "event_id", "ingested_at", "title", "role_category",
        F.array_join("techs", ",").alias("techs"), "rejected")


@query(f"""WITH {fx.POSTINGS_SQL}
SELECT 'posting' AS kind, company, title, location, description, url, CAST(NULL AS VARCHAR) AS line
FROM postings
UNION ALL SELECT 'posting', NULL, NULL, NULL, NULL, NULL, '[' || event_id || ']'
FROM events WHERE event_id % 41 = 0
UNION ALL SELECT 'reject', NULL, NULL, NULL, NULL, NULL, '{{"title": "broken ' || event_id
FROM events WHERE event_id % 29 = 0
UNION ALL SELECT 'reject', NULL, NULL, NULL, NULL, NULL, '{{"title": "x"}} ' || event_id
FROM events WHERE event_id % 37 = 0
UNION ALL SELECT 'reject', NULL, NULL, NULL, NULL, NULL, '{{"title":"x"}}] garbage ' || event_id
FROM events WHERE event_id % 43 = 0
UNION ALL SELECT 'reject', NULL, NULL, NULL, NULL, NULL,
  '{{"title":"' || event_id || '"}}],[{{"title":"y"}}' FROM events WHERE event_id % 47 = 0
UNION ALL SELECT 'reject', NULL, NULL, NULL, NULL, NULL, event_id || '],[2'
FROM events WHERE event_id % 53 = 0
UNION ALL SELECT 'posting', NULL, 'a ]}} b ' || event_id, NULL, NULL, NULL, NULL
FROM events WHERE event_id % 59 = 0""")
def read_postings_rejects(spark, sf):
    """JSON-lines files with blank, broken and non-object lines among the postings."""
    rows = fx.postings(spark, sf)
    n = F.col("event_id").cast("long")

    def every(k, line):
        return F.when(n % k == 0, line)

    body = F.to_json(F.struct("company", "title", "location", "description", "url"))
    lines = rows.select(F.explode(F.array_compact(F.array(
        F.concat(F.lit(" \t"), body, F.lit("  ")),
        every(41, F.concat(F.lit("["), n.cast("string"), F.lit("]"))),
        every(31, F.lit("   ")),
        every(29, F.concat(F.lit('{"title": "broken '), n.cast("string"))),
        every(37, F.concat(F.lit('{"title": "x"} '), n.cast("string"))),
        every(43, F.concat(F.lit('{"title":"x"}] garbage '), n.cast("string"))),
        every(47, F.concat(F.lit('{"title":"'), n.cast("string"), F.lit('"}],[{"title":"y"}'))),
        every(53, F.concat(n.cast("string"), F.lit("],[2"))),
        every(59, F.concat(F.lit('{"title":"a ]} b '), n.cast("string"), F.lit('"}')))
    ))).alias("value"))
    path = fx.shared_folder(spark, "read_postings_rejects")
    lines.write.text(path)
    good, rejects = read_postings(spark, path)
    good = good.withColumn("line", F.when(F.col("line").startswith("["), F.col("line")))
    return good.withColumn("kind", F.lit("posting")).unionByName(
        rejects.withColumn("kind", F.lit("reject")), allowMissingColumns=True)


# --- streams and tables ----------------------------------------------------------------------

def tech_rows(tables):
    return clocked(tables.trend_tech.read().drop("window_date"))


def role_rows(tables):
    return clocked(tables.trend_role.read().drop("window_date"))


@query(trend("tech", 300))
def stream_tech_trend(spark, sf):
    """The tag trend as a stateful stream leaves it in its table."""
    return tech_rows(fx.streamed(spark, sf, "stream_tech_trend", "queries", ["trend_tech"]))


@query(trend("role_category", 300))
def stream_role_trend(spark, sf):
    """The role trend as a stateful stream leaves it in its table."""
    return role_rows(fx.streamed(spark, sf, "stream_role_trend", "queries", ["trend_role"]))


@query(f"{TAGGED} {FLAT}")
def stream_jobs(spark, sf):
    """The jobs table after a stream in which some events came again in a later batch."""
    tables = fx.streamed(spark, sf, "stream_jobs", "queries", ["jobs"], redelivered=True)
    return clocked(flat(tables.jobs.read()), "ingested_at")


@query("""SELECT '{"event_id": "broken-' || event_id AS raw FROM events WHERE event_id % 29 = 0""")
def stream_rejects(spark, sf):
    """Lines of the stream that hold no event."""
    return fx.streamed(spark, sf, "stream_rejects", "queries", ["jobs"]).rejects.read()


@query(trend("tech", 300))
def stream_single_pass_tech_trend(spark, sf):
    """The tag trend of the one-query pipeline: events that come again count once."""
    return tech_rows(fx.streamed(spark, sf, "stream_single_pass_tech_trend", "single_pass",
                                 redelivered=True))


@query(f"""{TAGGED}, {fx.trend_sql("tech", 300, name="by_tech")},
{fx.trend_sql("role_category", 300, name="by_role")}
SELECT 'tech' AS what, window_start, tech AS key, count FROM by_tech
UNION ALL SELECT 'role', window_start, role_category, count FROM by_role""")
def stream_feed_trends(spark, sf):
    """Both trends as followers of the jobs table leave them: events that come again count once."""
    tables = fx.streamed(spark, sf, "stream_feed_trends", "feed", redelivered=True)
    return clocked(tables.trend_tech.read().select(
        F.lit("tech").alias("what"), "window_start", F.col("tech").alias("key"), "count").unionByName(
        tables.trend_role.read().select(F.lit("role").alias("what"), "window_start",
                                        F.col("role_category").alias("key"), "count")), "window_start")


@query(f"""{TAGGED} {FLAT} WHERE location ILIKE '%austin%'
ORDER BY ingested_at DESC, event_id LIMIT 50 OFFSET 10""")
def stream_single_pass_search(spark, sf):
    """A search of the jobs table of the one-query pipeline, of which a part is merged."""
    jobs = fx.streamed(spark, sf, "stream_single_pass_search", "single_pass").jobs
    return clocked(flat(jobs.search(location="austin", limit=50, offset=10)), "ingested_at")


@query(trend("tech", 300, fx.latest_sql("tech")))
def stream_top_techs(spark, sf):
    """The top of the latest window out of the stored trend, of which one day is read."""
    tables = fx.streamed(spark, sf, "stream_top_techs", "single_pass")
    return clocked(top_techs(tables.trend_tech.read()))


@query(f"""{TAGGED}, {fx.trend_sql("tech", 300, name="by_tech")},
{fx.trend_sql("role_category", 300, name="by_role")}
SELECT 'jobs' AS what, role_category AS key, count(*) AS n FROM tagged GROUP BY role_category
UNION ALL SELECT 'tech', tech, sum(count)::BIGINT FROM by_tech GROUP BY tech
UNION ALL SELECT 'windows', tech, count(*) FROM by_tech GROUP BY tech
UNION ALL SELECT 'role', role_category, sum(count)::BIGINT FROM by_role GROUP BY role_category""")
def stream_three_queries(spark, sf):
    """All three queries at once over one source, each with its own checkpoint."""
    tables = fx.streamed(spark, sf, "stream_three_queries", "queries")
    trend_tech, trend_role = tables.trend_tech.read(), tables.trend_role.read()
    return tables.jobs.read().groupBy(F.col("role_category").alias("key")).agg(
        F.count("*").alias("n")).select(F.lit("jobs").alias("what"), "key", "n").unionByName(
        trend_tech.groupBy(F.col("tech").alias("key")).agg(F.sum("count").alias("n")).withColumn(
            "what", F.lit("tech"))).unionByName(
        trend_tech.groupBy(F.col("tech").alias("key")).agg(F.count("*").alias("n")).withColumn(
            "what", F.lit("windows"))).unionByName(
        trend_role.groupBy(F.col("role_category").alias("key")).agg(
            F.sum("count").alias("n")).withColumn("what", F.lit("role")))


@query(trend("role_category", 300))
def stream_reset_and_rerun(spark, sf):
    """Tables and checkpoints reset after a first run, then filled again from the same source."""
    source = fx.published_events(spark, sf, "stream_reset_and_rerun")
    root = fx.shared_folder(spark, "stream_reset_and_rerun/tables")
    fx.piped(spark, source, root, "queries", ["trend_role"])
    reset(spark, root, "queries")
    return role_rows(fx.piped(spark, source, root, "queries", ["trend_role"]))


@query("""SELECT count(*) AS events, count(*) AS ids, count(*) AS uuids, count(*) AS timed
FROM events""")
def drawn_event_ids(spark, sf):
    """Events without given id and time, published and read back: ids are random UUIDs that differ,
    the time is that of the run."""
    events = to_events(fx.postings(spark, sf).drop("event_id", "ingested_at"))
    path = fx.shared_folder(spark, "drawn_event_ids")
    publish(events, EventFiles(path))
    rows = parse_events(spark.read.text(path))
    uuid = F.col("event_id").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")
    age = F.current_timestamp().cast("double") - F.col("ingested_at").cast("double")
    return rows.agg(F.count("*").alias("events"), F.countDistinct("event_id").alias("ids"),
                    F.count_if(uuid).alias("uuids"),
                    F.count_if(age.between(-60, 3600)).alias("timed"))


NAMED = """lines AS (SELECT 'part-' || event_id % 5 AS file, (event_id % 3)::VARCHAR AS line FROM events),
numbered AS (SELECT *, row_number() OVER (PARTITION BY file, line) AS again FROM lines),
digests AS (SELECT file, line, again, sha1(unhex('{ns}') || encode(
  'jsonl' || chr(10) || file || chr(10) || again || chr(10) || line)) AS d FROM numbered)"""


@query(f"""WITH {NAMED.format(ns=POSTINGS.hex)} SELECT file, line, substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-5'
  || substr(d, 14, 3) || '-' || substr('89ab', (('0x' || substr(d, 17, 1))::INT & 3) + 1, 1) || substr(d, 18, 3)
  || '-' || substr(d, 21, 12) AS event_id FROM digests""")
def named_event_ids(spark, sf):
    """Ids that follow from file, line and number of the copy, over files of very many equal lines."""
    n = F.col("event_id")
    lines = fx.table(spark, sf, "events").select(
        F.concat(F.lit("part-"), n % 5).alias("file"), (n % 3).cast("string").alias("value"))
    good, _ = parse_postings(lines)
    return named_postings(good).select("file", "line", "event_id")


@query(f"{TAGGED} {FLAT} WHERE location ILIKE '%boston%' ORDER BY ingested_at DESC, event_id LIMIT 20")
def stream_live_jobs(spark, sf):
    """A jobs page that is refreshed after each batch out of what the batch brought."""
    jobs = fx.streamed(spark, sf, "stream_live_jobs", "queries", ["jobs"], redelivered=True).jobs
    shown = None
    for n in range(jobs.last_batch() + 1):
        new = jobs.brought(n)
        page = search_jobs(new, location="boston") if shown is None else dashboard.refreshed_jobs(
            shown, new, location="boston")
        shown = spark.createDataFrame(page.collect(), JOBS)
    return clocked(flat(shown), "ingested_at")


@query(trend("tech", 300))
def replace_range_backfill(spark, sf):
    """A trend put right by a recount of ten days: it lacks postings of these days, and has groups
    there that no posting stands for."""
    jobs = fx.jobs(spark, sf)
    day = F.to_date("ingested_at")
    lost = (day >= F.lit("2024-01-10").cast("date")) & (day < F.lit("2024-01-20").cast("date"))
    existing = tech_trend(jobs.where(~(lost & (F.col("role_category") == vocab.OTHER_ROLE))))
    times = jobs.where(lost)
    stale = tech_trend(times).withColumn("tech", F.concat(F.lit("stale "), "tech"))
    return replace_range(existing.unionByName(stale), tech_trend(times), times=times)


@query(trend("tech", 300))
def stream_replace_range(spark, sf):
    """The stored form: a stream that saw wrong tags for ten days, then a recount of these."""
    return tech_rows(recounted(spark, sf, "stream_replace_range"))


def recounted(spark, sf, name):
    tables = init_tables(spark, fx.shared_folder(spark, name), "single_pass")
    jobs = fx.jobs(spark, sf).withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))
    day = F.to_date("ingested_at")
    lost = (day >= F.lit("2024-01-10").cast("date")) & (day < F.lit("2024-01-20").cast("date"))
    tables.trend_tech.append_batch(tech_trend(jobs).withColumn("tech", F.when(
        lost_window(), F.concat(F.lit("stale "), "tech")).otherwise(F.col("tech"))), 0)
    tables.trend_tech.replace_range(tech_trend(jobs.where(lost)), 300)
    return tables


def lost_window():
    day = F.to_date("window_start")
    return (day >= F.lit("2024-01-10").cast("date")) & (day < F.lit("2024-01-20").cast("date"))


# --- generated postings ----------------------------------------------------------------------

def draw_sql(values, n: int) -> str:
    shift = (SEED * 7_919 + n * SPREAD) % PRIME
    x = f"((event_id % {PRIME} * {STEP} + {shift}) % {PRIME})"
    return f"{fx.text_list(values)}[{x} * {x} % {PRIME} % {len(values)} + 1]"


GENERATED = f"""drawn AS (
  SELECT event_id AS id, {draw_sql(vocab.SAMPLE_COMPANIES, 1)} AS company,
    {draw_sql(vocab.SAMPLE_TITLES, 2)} AS title, {draw_sql(vocab.SAMPLE_LOCATIONS, 3)} AS location,
    replace({draw_sql(vocab.SAMPLE_DESCRIPTIONS, 5)}, '{{techs}}', {draw_sql(fx.TECHS, 4)})
      AS description
  FROM events),
postings AS (
  SELECT *, {fx.text(vocab.SAMPLE_URL_BASE)} || {fx.slug_sql('company')} || '/'
    || {fx.slug_sql('title')} || '-' || id AS url FROM drawn)"""


@query(f"WITH {GENERATED} SELECT * FROM postings")
def generated_postings(spark, sf):
    """One sample posting per event id."""
    return generate_postings(fx.table(spark, sf, "events"), "event_id", SEED)


@query(f"""WITH {GENERATED}, tagged AS (
  SELECT {fx.role_sql("lower(title)")} AS role_category,
    {fx.techs_sql("lower(title)", "lower(description)")} AS techs FROM postings)
SELECT role_category, count(*) AS postings, sum(len(techs))::BIGINT AS tags FROM tagged
GROUP BY role_category""")
def generated_postings_profile(spark, sf):
    """Sample postings per role, and their tags."""
    rows = generate_postings(fx.table(spark, sf, "events"), "event_id", SEED)
    tagged = add_techs(add_role_category(fx.with_texts(rows)))
    return tagged.groupBy("role_category").agg(
        F.count("*").alias("postings"), F.sum(F.size("techs").cast("long")).alias("tags"))
