"""The running pipeline: raw events in, tables kept up to date."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.util import inheritable_thread_target

from hiretide.operators.events import parse_events, split_rejects
from hiretide.operators.tagging import add_role_category, add_techs, enrich
from hiretide.operators.trends import role_trend, tech_trend
from hiretide.sources import folders
from hiretide.sources.event_stream import EventFiles, KafkaTopic, read_event_stream
from hiretide.sources.jdbc import JdbcSink
from hiretide.sources.offsets import PLACE, offset_ranges
from hiretide.streaming.follow import Follower, catch_up
from hiretide.streaming.tables import Tables, init_tables

QUERIES = ("jobs", "trend_tech", "trend_role")


COUNTS = ("events", "deliveries")


def run_pipeline(spark: SparkSession, source: KafkaTopic | EventFiles, root: str,
                 mode: str = "queries", trigger: dict | None = None, window_sec: int = 300,
                 watermark: str | None = None, only: Iterable[str] = QUERIES,
                 any_day: bool = False, count: str | None = None, merge_every: int = 100,
                 database: JdbcSink | None = None) -> list[StreamingQuery | Follower]:
    """Start the queries that fill the tables under ``root``.

    ``mode="queries"``: one query per table. Trends are stateful counts in update mode;
    without ``watermark`` late events always count and state is kept for good, with it older
    windows are dropped and so are events for them. The source is read once per query.

    ``mode="single_pass"``: one stateless query reads, parses and tags each event once
    and stores its batch's own counts, which reads add up. No state, no lost late events.

    ``mode="feed"``: one query fills the jobs table; trends follow that table, each in a thread of its own
    (``Follower``), and count what it took. Exact as a single pass is, and a trend that is
    slow, or fails, holds up neither the jobs nor the other one.

    ``count``: what trends count. ``"events"``: an event that is delivered again counts once; a single
    pass counts the rows new to the jobs table, queries drop copies within the watermark, which
    they need for it. ``"deliveries"``: every copy counts. Unset: events, where that can be had.

    Every ``merge_every`` batches a table's batches go into its base. ``database`` gets the rows of
    each batch as well. ``trigger`` is passed on, e.g. ``{"availableNow": True}``; unset, a batch
    follows the last.
    """
    if count is None:
        count = "events" if mode != "queries" or watermark else "deliveries"
    if count not in COUNTS:
        raise ValueError(f"count must be one of {COUNTS}, not {count!r}")
    if merge_every < 1:
        raise ValueError("merge_every must be at least 1")
    tables = init_tables(spark, root, mode, any_day)
    if mode == "single_pass":
        if watermark:
            raise ValueError("single_pass keeps no state, so it takes no watermark")
        raw = read_event_stream(spark, source)
        events = enrich(parse_events(raw, [c for c in PLACE if c in raw.columns]))
        store = _kept_small(tables, list(tables.all()), merge_every, _copied(
            tables, ("jobs", "trend_tech", "trend_role"), database,
            _store_all(tables, window_sec, count)))
        return [_start(tables, "single_pass", list(tables.all()), events, store, "append", trigger)]
    if mode == "feed":
        if watermark or count != "events":
            raise ValueError("feed counts each event of the jobs table once: it takes no watermark and no copies")
        return _feed(tables, source, trigger, window_sec, merge_every, database)
    unknown = set(only) - set(QUERIES)
    if unknown:
        raise ValueError(f"no such query: {sorted(unknown)}")
    if count == "events" and not watermark:
        raise ValueError("stateful queries need a watermark to count each event once; mode=\"feed\" does not")
    started = []
    for name in QUERIES:
        if name not in only:
            continue
        events = parse_events(read_event_stream(spark, source))
        touched, output = ["jobs", "rejects"], "append"
        if name == "jobs":
            rows, store = enrich(events), _store_jobs(tables)
        else:
            touched, output = [name], "update"
            if count == "events":
                events = events.withWatermark("ingested_at", watermark) \
                    .dropDuplicatesWithinWatermark(["event_id"])
            late = watermark if count == "deliveries" else None
            if name == "trend_tech":
                rows = tech_trend(add_techs(events), window_sec, watermark=late)
            else:
                rows = role_trend(add_role_category(events), window_sec, watermark=late)
            store = tables.all()[name].append_batch
        store = _copied(tables, [name], database, store)
        started.append(_start(tables, name, touched, rows,
                              _kept_small(tables, touched, merge_every, store), output, trigger))
    return started


def _feed(tables: Tables, source: KafkaTopic | EventFiles, trigger: dict | None, window_sec: int,
          merge_every: int, database: JdbcSink | None) -> list[StreamingQuery | Follower]:
    events = enrich(parse_events(read_event_stream(tables.spark, source)))
    store = _kept_small(tables, ["jobs", "rejects"], merge_every,
                        _copied(tables, ["jobs"], database, _store_jobs(tables)))
    leader = _start(tables, "jobs", ["jobs", "rejects"], events, store, "append", trigger)

    def follower(name: str, count: Callable[[DataFrame, int], DataFrame]) -> Follower:
        # Tables of its own: nothing is shared between threads but the session.
        own = Tables(tables.spark, tables.root, "feed", tables.jobs.any_day)
        return Follower(tables.spark, leader, name, lambda: catch_up(
            own.jobs, own.all()[name], lambda rows: count(rows, window_sec), merge_every))

    return [leader, follower("trend_tech", tech_trend), follower("trend_role", role_trend)]


def await_all(queries: Iterable[StreamingQuery | Follower], every: float = 1) -> None:
    """Wait until all have ended. The first that fails stops the others and is raised."""
    running = list(queries)
    try:
        while running:
            for query in list(running):
                if query.awaitTermination(every):
                    running.remove(query)
    finally:
        for query in running:
            query.stop()


def _start(tables: Tables, name: str, touched: list[str], rows: DataFrame,
           store: Callable[[DataFrame, int], None], output: str,
           trigger: dict | None) -> StreamingQuery:
    checkpoint = tables.checkpoint(name)
    if not folders.exists(tables.spark, f"{checkpoint}/offsets"):
        filled = [t for t in touched if not tables.all()[t].is_empty()]
        if filled:
            # Batch ids would start again at 0 and new rows pass for stored ones.
            raise RuntimeError(f"{filled} hold rows but {checkpoint} does not exist: "
                               "reset the tables, or bring the checkpoint back")
    writer = rows.writeStream.queryName(name).foreachBatch(store).outputMode(output) \
        .option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def _store_jobs(tables: Tables):
    def store(batch: DataFrame, batch_id: int) -> None:
        if tables.jobs.holds(batch_id) and tables.rejects.holds(batch_id):
            return
        batch.persist()
        try:
            good, rejects = split_rejects(batch)
            tables.jobs.append_batch(good, batch_id)
            tables.rejects.append_batch(rejects, batch_id)
        finally:
            batch.unpersist()
    return store


def _store_all(tables: Tables, window_sec: int, count: str):
    def store(batch: DataFrame, batch_id: int) -> None:
        if all(t.holds(batch_id) for t in tables.all().values()):
            return
        batch.persist()
        try:
            good, rejects = split_rejects(batch)
            tables.jobs.append_batch(good, batch_id)
            # What the jobs table took of this batch is in its folder, also when this is a replay.
            counted = tables.jobs.batch_rows(batch_id) if count == "events" else batch
            if set(PLACE) <= set(batch.columns):
                tables.offsets.append_batch(offset_ranges(batch), batch_id)
            _at_once(tables.spark, [
                lambda: tables.rejects.append_batch(rejects, batch_id),
                lambda: tables.trend_tech.append_batch(tech_trend(counted, window_sec), batch_id),
                lambda: tables.trend_role.append_batch(role_trend(counted, window_sec), batch_id)])
        finally:
            batch.unpersist()
    return store


def _kept_small(tables: Tables, names: Iterable[str], every: int,
                store: Callable[[DataFrame, int], None]):
    def run(batch: DataFrame, batch_id: int) -> None:
        store(batch, batch_id)
        if (batch_id + 1) % every == 0:
            _at_once(tables.spark, [tables.all()[name].merge for name in names])
    return run


def _at_once(spark: SparkSession, tasks: list[Callable[[], None]]) -> None:
    """Run small jobs on different tables side by side; the first failure is raised."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]:
            done.result()


def _copied(tables: Tables, names: Iterable[str], database: JdbcSink | None,
            store: Callable[[DataFrame, int], None]):
    """Also appends what a batch stored to the database; a marker per batch keeps replays out, but for
    one that broke off between the two."""
    if database is None:
        return store

    def run(batch: DataFrame, batch_id: int) -> None:
        store(batch, batch_id)
        for name in names:
            marker = f"{tables.base}/_database/{name}/batch={batch_id:012d}"
            if not folders.exists(tables.spark, marker):
                database.append(tables.all()[name].batch_rows(batch_id), name, batch_id)
                folders.make(tables.spark, marker)
    return run
