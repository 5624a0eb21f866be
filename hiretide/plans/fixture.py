"""Job postings derived from the ``events`` table, in Spark and in SQL.

Every event becomes one posting: lists are indexed by its ids, every 17th has
no title, every 19th no description, and so on (see ``postings``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiretide import vocab
from hiretide.operators.events import to_events
from hiretide.operators.tagging import add_role_category, add_techs
from hiretide.functions.text import lowered
from hiretide.sources import folders
from hiretide.sources.generate import pick, posting_url
from hiretide.sources.event_stream import EventFiles
from hiretide.streaming.pipeline import await_all, run_pipeline
from hiretide.streaming.tables import Tables

TECHS = [", ".join(g) for g in vocab.SAMPLE_TECH_GROUPS]
DESCRIPTION = vocab.SAMPLE_DESCRIPTIONS[2]
STORES = "JavaScript, MongoDB and PostgreSQL"
KEYWORDS = tuple(dict.fromkeys(vocab.TECH_KEYWORDS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One posting per event; ``ingested_at`` is the event's UTC wall-clock time."""
    i, user = F.col("event_id"), F.col("user_id")
    before, after = DESCRIPTION.split("{techs}")
    base = table(spark, sf_dir, "events").select(
        i, F.col("ts").alias("ingested_at"),
        pick(vocab.SAMPLE_COMPANIES, user % 15).alias("company"),
        pick(vocab.SAMPLE_TITLES, F.expr("event_id div 3 % 10")).alias("base_title"),
        pick(vocab.SAMPLE_LOCATIONS, F.expr("event_id div 7 % 10")).alias("location"),
        pick(TECHS, F.expr("(event_id div 11 + user_id) % 8")).alias("techs_text"))
    return base.select(
        i.cast("string").alias("event_id"), "ingested_at", "company",
        F.when(i % 17 == 0, F.lit(None))
        .when(i % 13 == 0, F.concat(F.lit("Senior "), F.upper("base_title")))
        .when(i % 11 == 0, F.lit("Office Manager")).otherwise(F.col("base_title")).alias("title"),
        "location",
        F.when(i % 19 == 0, F.lit(None)).when(i % 23 == 0, F.lit(STORES))
        .otherwise(F.concat(F.lit(before), "techs_text", F.lit(after))).alias("description"),
        posting_url(F.col("company"), F.col("base_title"), i).alias("url"))


def with_texts(df: DataFrame) -> DataFrame:
    return df.withColumn("title_l", lowered(F.col("title"))) \
        .withColumn("desc_l", lowered(F.col("description")))


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived postings with both tags, in the columns of the jobs table."""
    tagged = add_techs(add_role_category(with_texts(postings(spark, sf_dir))))
    return tagged.withColumn("seniority", F.lit(None).cast("string"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """An empty folder for one use. The next use of the name takes it over, so that runs do not
    pile up; ``clean`` removes all of them."""
    path = f"{folders.scratch(spark)}/{name}"
    folders.remove(spark, path)
    return path


def clean(spark: SparkSession) -> None:
    """Remove what queries of this application have written; their results cannot be read then."""
    folders.clear_scratch(spark)


#: Files a micro-batch of the derived stream reads, however many there are.
FILES_PER_BATCH = 4


def published_events(spark: SparkSession, sf_dir: str, name: str,
                     redelivered: bool = False) -> EventFiles:
    """The derived postings published as event files, with one broken line per 29 events.

    With ``redelivered`` every 43rd event comes once more, in files that are read after the others,
    so in a later batch.
    """
    rows = postings(spark, sf_dir)
    n = F.col("event_id").cast("long")
    events = to_events(rows, id_col="event_id", time_col="ingested_at")
    broken = rows.where(n % 29 == 0).select(
        F.col("event_id").alias("key"),
        F.concat(F.lit('{"event_id": "broken-'), "event_id").alias("value"))
    path = shared_folder(spark, f"{name}/events")
    # Neighbouring events go to different files, so the batches share windows.
    slices = (F.col("key").cast("long") % 6).alias("slice")
    events.unionByName(broken).select("value", slices).write.partitionBy("slice").text(path)
    if redelivered:
        again = events.where(F.col("key").cast("long") % 43 == 0)
        again.select("value", F.lit("again").alias("slice")).write.mode("append") \
            .partitionBy("slice").text(path)
    return EventFiles(path, files_per_batch=FILES_PER_BATCH)


def streamed(spark: SparkSession, sf_dir: str, name: str, mode: str, only: Sequence[str] = (),
             redelivered: bool = False, window_sec: int = 300, merge_every: int = 2) -> Tables:
    """The tables after the pipeline has read all published events, in several batches; the last
    ones are not merged."""
    source = published_events(spark, sf_dir, name, redelivered)
    return piped(spark, source, shared_folder(spark, f"{name}/tables"), mode, only, window_sec,
                 merge_every)


def piped(spark: SparkSession, source: EventFiles, root: str, mode: str, only: Sequence[str] = (),
          window_sec: int = 300, merge_every: int = 2) -> Tables:
    more = {"only": only} if only else {}
    await_all(run_pipeline(spark, source, root, mode, {"availableNow": True}, window_sec,
                           merge_every=merge_every, **more))
    return Tables(spark, root, mode)


# --- the same in SQL -------------------------------------------------------------------------

def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def text_list(values: Sequence[str]) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def slug_sql(column: str) -> str:
    return f"replace(lower({column}), ' ', '-')"


POSTINGS_SQL = f"""
base AS (
  SELECT event_id AS n, ts, {text_list(vocab.SAMPLE_COMPANIES)}[user_id % 15 + 1] AS company,
    {text_list(vocab.SAMPLE_TITLES)}[event_id // 3 % 10 + 1] AS base_title,
    {text_list(vocab.SAMPLE_LOCATIONS)}[event_id // 7 % 10 + 1] AS location,
    {text_list(TECHS)}[(event_id // 11 + user_id) % 8 + 1] AS techs_text
  FROM events),
postings AS (
  SELECT CAST(n AS VARCHAR) AS event_id, ts AS ingested_at, company,
    CASE WHEN n % 17 = 0 THEN NULL WHEN n % 13 = 0 THEN 'Senior ' || upper(base_title)
         WHEN n % 11 = 0 THEN 'Office Manager' ELSE base_title END AS title,
    location,
    CASE WHEN n % 19 = 0 THEN NULL WHEN n % 23 = 0 THEN {text(STORES)}
         ELSE replace({text(DESCRIPTION)}, '{{techs}}', techs_text) END AS description,
    {text(vocab.SAMPLE_URL_BASE)} || {slug_sql('company')} || '/' || {slug_sql('base_title')}
      || '-' || n AS url
  FROM base)"""


def role_sql(title: str) -> str:
    whens = " ".join(f"WHEN contains({title}, {text(p)}) THEN {text(label)}"
                     for p, label in vocab.ROLE_RULES)
    return f"CASE {whens} ELSE {text(vocab.OTHER_ROLE)} END"


def techs_sql(*texts: str, keywords: Sequence[str] = KEYWORDS) -> str:
    hit = " OR ".join(f"contains({t}, k)" for t in texts)
    return f"list_filter({text_list(keywords)}, lambda k: {hit})"


def tagged_sql(keywords: Sequence[str] = KEYWORDS) -> str:
    title, desc = "lower(coalesce(title, ''))", "lower(coalesce(description, ''))"
    return f"""{POSTINGS_SQL},
tagged AS (
  SELECT *, CAST(NULL AS VARCHAR) AS seniority, {role_sql(title)} AS role_category,
    {techs_sql(desc, title, keywords=keywords)} AS techs
  FROM postings)"""


def trend_sql(key: str, sec: int, rows: str = "tagged", name: str = "trend") -> str:
    source = f"(SELECT ingested_at, unnest(techs) AS tech FROM {rows})" if key == "tech" else rows
    bucket = f"time_bucket(INTERVAL '{sec} seconds', ingested_at)"
    return f"""{name} AS (
  SELECT {bucket} AS window_start, {bucket} + INTERVAL '{sec} seconds' AS window_end,
    {sec} AS window_size_sec, {key}, count(*) AS count
  FROM {source} GROUP BY {bucket}, {key})"""


def latest_sql(key: str, limit: int = 10) -> str:
    return f"""SELECT window_start, window_end, window_size_sec, {key}, count FROM trend
WHERE window_start = (SELECT max(window_start) FROM trend)
ORDER BY count DESC, {key} LIMIT {limit}"""
