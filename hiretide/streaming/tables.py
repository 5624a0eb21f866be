"""Replay-safe Parquet tables written batch by batch.

A table is a folder of plain Parquet folders and of a small list of those that count:

* ``batches/batch=N``: the rows of batch N, overwritten when the batch is replayed. A batch counts from
  the moment its ``_SUCCESS`` marker exists, which the write sets last;
* ``base/run=K``: rows of merged batches, partitioned for reading;
* ``manifest/V``: the runs that count, and the last batch they hold. The greatest V holds. It is written
  beside its place and renamed into it, so whatever a merge or a recount changes, it changes in one step.

Readers take the runs of the manifest, in one scan, and the batches after them. ``merge`` moves the batches
into a run, by one batch query; the pipeline calls it every ``merge_every`` batches. Runs have
levels: a merge that would make the ``FAN``-th run of a level takes that level in and makes a run of the
next, so that after n merges at most ``FAN - 1`` runs a level and log n levels are left, and a row has been
rewritten once a level. Folders that a manifest drops stay until the next one, for readers that began before.
"""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StructField, StructType

from hiretide import schemas
from hiretide.functions.times import utc_day, utc_hour
from hiretide.operators.reads import find_page, job_filters
from hiretide.operators.trends import roll_up
from hiretide.sources import folders
from hiretide.sources.offsets import RANGES

NUMBER = re.compile(r"=(\d+)/_SUCCESS$")
VERSION = re.compile(r"/(\d+)$")
FAN = 4
ROLLUPS = (3600, 86400)


@dataclass(frozen=True)
class Run:
    """A folder of merged rows, and the batches they came in."""

    run: int
    level: int
    first: int
    last: int


@dataclass(frozen=True)
class Hidden:
    """Days of one window size that a later run has in place of this one."""

    run: int
    size: int
    first: str
    last: str


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    up_to: int = -1
    following: int = 0
    runs: list[Run] = field(default_factory=list)
    hidden: list[Hidden] = field(default_factory=list)
    dropped: list[int] = field(default_factory=list)

    @staticmethod
    def of(text: str) -> Manifest:
        found = json.loads(text)
        return Manifest(**found | {"runs": [Run(**r) for r in found["runs"]],
                                   "hidden": [Hidden(**h) for h in found["hidden"]]})


def absorbed(runs: list[Run]) -> tuple[list[Run], int]:
    """The runs that the next merge takes in, and the level of the run that it makes."""
    taken, level = [], 0
    while len(same := [r for r in runs if r.level == level]) >= FAN - 1:
        taken, level = taken + same, level + 1
    return taken, level


class BatchTable:
    """Rows of batches, as written."""

    partition_by: tuple[str, ...] = ()
    #: What is kept for each run beside its rows: folders and the columns they are partitioned by.
    beside: dict[str, tuple[str, ...]] = {}

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _numbers(self, kind: str) -> list[int]:
        found = (NUMBER.search(m) for m in folders.matching(self.spark, f"{self.path}/{kind}=*/_SUCCESS"))
        return sorted(int(m[1]) for m in found if m)

    def _batch(self, n: int) -> str:
        return f"{self.path}/batches/batch={n:012d}"

    def _run(self, n: int, kind: str = "base") -> str:
        return f"{self.path}/{kind}/run={n}"

    def _manifests(self) -> list[int]:
        found = (VERSION.search(m) for m in folders.matching(self.spark, f"{self.path}/manifest/[0-9]*"))
        return sorted(int(m[1]) for m in found if m)

    def manifest(self) -> Manifest:
        """What counts at this moment."""
        there = self._manifests()
        return Manifest.of(folders.read_text(self.spark, f"{self.path}/manifest/{there[-1]:012d}")) \
            if there else Manifest()

    def _switch(self, old: Manifest, new: Manifest) -> None:
        """Let ``new`` hold, in one step; then remove what ``old`` had dropped already."""
        new = replace(new, version=old.version + 1)
        folders.write_text(self.spark, f"{self.path}/manifest/{new.version:012d}", json.dumps(asdict(new)))
        for n in old.dropped:
            for kind in ("base", *self.beside):
                folders.remove(self.spark, self._run(n, kind))
        for v in self._manifests():
            if v < old.version:
                folders.remove(self.spark, f"{self.path}/manifest/{v:012d}")
        for n in self._numbers("batches/batch"):
            if n <= old.up_to:
                folders.remove(self.spark, self._batch(n))

    def tail(self, held: Manifest | None = None) -> list[int]:
        """Batches that no run has yet."""
        last = (held or self.manifest()).up_to
        return [b for b in self._numbers("batches/batch") if b > last]

    def holds(self, batch_id: int) -> bool:
        return folders.exists(self.spark, f"{self._batch(batch_id)}/_SUCCESS") \
            or batch_id <= self.manifest().up_to

    def last_batch(self) -> int:
        """The newest batch stored; -1: none."""
        held = self.manifest()
        return max([held.up_to, *self.tail(held)])

    def is_empty(self) -> bool:
        return not self._numbers("batches/batch") and not self.manifest().runs

    def _read(self, paths: list[str], root: str, schema: StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", root).parquet(*paths) \
            .select(*schema.fieldNames())

    def _runs(self, held: Manifest, kind: str, schema: StructType, only: list[Run] | None = None) -> DataFrame:
        """The rows of runs, with their number ``run``: one scan, however many runs there are."""
        numbered = StructType(schema.fields + [StructField("run", IntegerType())])
        paths = [self._run(r.run, kind) for r in (held.runs if only is None else only)]
        return self._read(paths, f"{self.path}/{kind}", numbered)

    def base_rows(self, held: Manifest | None = None) -> DataFrame:
        return self._runs(held or self.manifest(), "base", self.schema).drop("run")

    def tail_rows(self, held: Manifest | None = None) -> DataFrame:
        return self._read([self._batch(n) for n in self.tail(held)], f"{self.path}/batches", self.schema)

    def rows(self) -> DataFrame:
        """All rows stored."""
        held = self.manifest()
        if not self.tail(held):
            return self.base_rows(held)
        return self.base_rows(held).unionByName(self.tail_rows(held)) if held.runs else self.tail_rows(held)

    def read(self) -> DataFrame:
        """The table's rows."""
        return self.rows()

    def batch_rows(self, batch_id: int) -> DataFrame:
        """What was stored of one batch; for batches that no merge has removed."""
        return self._read([self._batch(batch_id)], self._batch(batch_id), self.schema)

    def append_batch(self, df: DataFrame, batch_id: int) -> None:
        """Store the rows of one batch; a batch stored before is left as it is."""
        if not self.holds(batch_id):
            self._write(df.select(*self.schema.fieldNames()), self._batch(batch_id))

    def _write(self, df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
        # Static: what a failed attempt left in the folder goes.
        df.write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .partitionBy(*partition_by).parquet(path)

    def _write_run(self, rows: DataFrame, n: int) -> None:
        self._write(self._laid_out(rows.select(*self.schema.fieldNames())), self._run(n), self.partition_by)
        for kind, partition_by in self.beside.items():
            own = self._read([self._run(n)], self._run(n), self.schema)
            self._write(self._beside(kind, own), self._run(n, kind), partition_by)

    def _laid_out(self, rows: DataFrame) -> DataFrame:
        """``rows`` as a run's files hold them."""
        return rows.hint("rebalance", *map(F.col, self.partition_by)) if self.partition_by else rows

    def _beside(self, kind: str, rows: DataFrame) -> DataFrame:
        raise NotImplementedError(kind)

    def _absorbed(self, runs: list[Run]) -> tuple[list[Run], int]:
        return absorbed(runs)

    def _merged(self, held: Manifest, taken: list[Run]) -> DataFrame:
        """Rows of the next run."""
        tail = self.tail_rows(held)
        return self._runs(held, "base", self.schema, taken).drop("run").unionByName(tail) if taken else tail

    def merge(self) -> None:
        """Move the batches that no run has into one, with the runs that it takes in."""
        held = self.manifest()
        if tail := self.tail(held):
            taken, level = self._absorbed(held.runs)
            self._write_run(self._merged(held, taken), held.following)
            made = Run(held.following, level, min([tail[0], *(r.first for r in taken)]), tail[-1])
            gone = {r.run for r in taken}
            self._switch(held, replace(
                held, up_to=tail[-1], following=held.following + 1,
                runs=[*(r for r in held.runs if r.run not in gone), made],
                hidden=[h for h in held.hidden if h.run not in gone], dropped=sorted(gone)))


class TrendTable(BatchTable):
    """Windowed counts, one row per window and key when read.

    ``kind="totals"``: a batch holds the full new count of every key it changes, as
    an update-mode stream gives; the last batch of a key counts. ``kind="deltas"``: a batch
    holds what it adds, and the counts are summed.

    A merge makes one run of all, by window size and day, with one row per key: a trend has
    at most some dozen rows per window, whatever the number of events. ``adjust`` is what a recount
    adds to the counts of the stream: it stays when a running stream, which knows nothing of
    the recount, stores its next total. Beside each run stand its counts rolled up to hours and days.
    """

    partition_by = ("window_size_sec", "window_date")
    beside = {"rollup": ("window_size_sec", "window_date")}

    def __init__(self, spark: SparkSession, path: str, key: str, kind: str = "totals"):
        if kind not in ("totals", "deltas"):
            raise ValueError(f"kind must be 'totals' or 'deltas', not {kind!r}")
        date = StructField("window_date", DateType())
        more = [date, StructField("batch_id", LongType()), StructField("adjust", LongType())]
        super().__init__(spark, path, StructType(schemas.trend(key).fields + more))
        self.key, self.kind = key, kind
        self.group = ["window_start", "window_end", "window_size_sec", key, "window_date"]
        self.rolled_schema = StructType(schemas.trend(key).fields + [
            date, StructField("of_size_sec", IntegerType())])

    def _runs(self, held: Manifest, kind: str, schema: StructType, only: list[Run] | None = None) -> DataFrame:
        rows = super()._runs(held, kind, schema, only)
        size = F.col("of_size_sec" if kind == "rollup" else "window_size_sec")
        for h in held.hidden:  # on partition columns: what is hidden is not read
            days = F.col("window_date").between(*(F.lit(d).cast("date") for d in (h.first, h.last)))
            rows = rows.where(~((F.col("run") == h.run) & (size == h.size) & days))
        return rows

    def _counted(self, rows: DataFrame) -> DataFrame:
        return self._folded(rows).select(*self.group, (F.col("count") + F.col("adjust")).alias("count")) \
            .where("count > 0")

    def read(self) -> DataFrame:
        """One row per window and key; ``window_date`` lets readers leave out days."""
        return self._counted(self.rows())

    def rolled(self, size: int, of: int = 300) -> DataFrame:
        """The same in windows of ``size``, one of ``ROLLUPS``, made of those of size ``of``. Stored roll-ups
        are read as they are; windows that batches since the last merge change are made anew, out of their
        own days."""
        if size not in ROLLUPS or size <= of or size % of:
            raise ValueError(f"size must be one of {ROLLUPS} and a multiple of {of}, not {size}")
        held = self.manifest()
        stored = self._runs(held, "rollup", self.rolled_schema).where(
            (F.col("window_size_sec") == size) & (F.col("of_size_sec") == of)).drop("run", "of_size_sec")
        stored = stored.select(*self.group, "count")
        if not self.tail(held):
            return stored
        tail = self.tail_rows(held).where(F.col("window_size_sec") == of).select("window_date").distinct()
        days = [r[0] for r in tail.collect()]  # of the batches since the last merge
        old = self.base_rows(held).where(F.col("window_date").isin(days)) if held.runs else None
        rows = self.tail_rows(held) if old is None else old.unionByName(self.tail_rows(held))
        fresh = self._rolled(self._counted(rows).where(F.col("window_size_sec") == of)).where(
            F.col("window_size_sec") == size)
        return stored.where(~F.col("window_date").isin(days)).unionByName(
            fresh.select(*self.group, "count"))

    def _rolled(self, counts: DataFrame) -> DataFrame:
        wide = roll_up(counts, self.key, ROLLUPS).withColumn("window_date", utc_day(F.col("window_start")))
        return wide.select(*self.rolled_schema.fieldNames())

    def _beside(self, kind: str, rows: DataFrame) -> DataFrame:
        rolled = self._rolled(self._counted(rows))
        return rolled.hint("rebalance", "window_size_sec", "window_date")

    def append_batch(self, df: DataFrame, batch_id: int) -> None:
        rows = df.withColumns({"window_date": utc_day(F.col("window_start")),
                               "batch_id": F.lit(batch_id).cast("long"),
                               "adjust": F.lit(0).cast("long")}).select(*self.schema.fieldNames())
        # Reading the rows to the end is what saves a stream's state, so a replay
        # has to do it as well: it writes the same rows, in the place of the first.
        if batch_id <= self.manifest().up_to:
            rows.write.format("noop").mode("overwrite").save()
        elif self.kind == "totals" or not self.holds(batch_id):
            # Rebalanced: there is a state partition per shuffle partition, but few rows in each.
            self._write(rows.hint("rebalance", F.col("window_start")), self._batch(batch_id))

    def _folded(self, rows: DataFrame) -> DataFrame:
        count = F.max_by("count", "batch_id") if self.kind == "totals" else F.sum("count")
        return rows.groupBy(*self.group).agg(
            count.alias("count"), F.max("batch_id").alias("batch_id"), F.sum("adjust").alias("adjust"))

    def _absorbed(self, runs: list[Run]) -> tuple[list[Run], int]:
        return runs, 0

    def _merged(self, held: Manifest, taken: list[Run]) -> DataFrame:
        return self._folded(super()._merged(held, taken))

    def replace_range(self, new: DataFrame, window_size_sec: int) -> None:
        """Store a complete recount of a range of windows in place of what was counted.

        The days of the range go into a run of their own, which the next manifest lets hold in place of
        the same days of the others: readers see all of the recount or nothing of it, and so they do
        when a call breaks off, which leaves what was. The recount is worked out once.
        """
        self.merge()
        held = self.manifest()
        if not held.runs:
            raise RuntimeError(f"{self.path} holds no batch to replace counts of")
        work = f"{self.path}/replace"
        self._write(new.where(F.col("window_size_sec") == window_size_sec).select(
            *schemas.trend(self.key).fieldNames()), work)
        new = self.spark.read.schema(schemas.trend(self.key)).parquet(work) \
            .withColumn("window_date", utc_day(F.col("window_start")))
        start, day = F.unix_micros("window_start"), F.col("window_date")
        low, high, first, last = new.agg(F.min(start), F.max(start), F.min(day), F.max(day)).first()
        if low is not None:
            inside = start.between(low, high)
            old = self.base_rows(held).where((F.col("window_size_sec") == window_size_sec)
                                             & day.between(first, last))
            # What the stream counted in the range is taken back, and what the recount has added.
            old = old.withColumn("adjust", F.when(inside, -F.col("count")).otherwise(F.col("adjust")))
            added = new.withColumns({"adjust": F.col("count"), "count": F.lit(0).cast("long"),
                                     "batch_id": F.lit(-1).cast("long")})
            self._write_run(old.unionByName(added).groupBy(*self.group).agg(
                F.sum("count").alias("count"), F.max("batch_id").alias("batch_id"),
                F.sum("adjust").alias("adjust")), held.following)
            self._switch(held, replace(
                held, following=held.following + 1, dropped=[],
                runs=[*held.runs, Run(held.following, 0, held.runs[0].first, held.up_to)],
                hidden=[*held.hidden, *(Hidden(r.run, window_size_sec, str(first), str(last))
                                        for r in held.runs)]))
        folders.remove(self.spark, work)


class JobsTable(BatchTable):
    """Enriched postings, one row per event.

    An event's id and time are stamped together, so copies of an event share
    its day, and a batch is compared with the stored ids of its own days only.
    ``any_day=True`` drops that assumption and compares with all stored ids. Beside each run stands how many
    rows it has by day and hour, which is what pages are found by.
    """

    partition_by = ("ingest_date",)
    beside = {"summary": ()}

    def __init__(self, spark: SparkSession, path: str, any_day: bool = False):
        batch = StructField("batch_id", LongType())
        super().__init__(spark, path, StructType(schemas.STORED_JOBS.fields + [batch]))
        self.any_day = any_day
        self.summary_schema = StructType([StructField("ingest_date", DateType()),
                                          StructField("hour", IntegerType()), StructField("n", LongType())])

    def read(self) -> DataFrame:
        return self.rows().select(*schemas.JOBS.fieldNames())

    def changes(self, since: int, up_to: int | None = None) -> DataFrame:
        """The rows that batches after ``since`` brought, those up to ``up_to`` if that is given. Only the runs
        and batches that hold them are read."""
        held = self.manifest()
        last = self.last_batch() if up_to is None else up_to
        late = [r for r in held.runs if r.last > since and r.first <= last]
        rows = self._runs(held, "base", self.schema, late).drop("run").where(
            (F.col("batch_id") > since) & (F.col("batch_id") <= last))
        newer = [self._batch(n) for n in self.tail(held) if since < n <= last]
        if newer:
            tail = self._read(newer, f"{self.path}/batches", self.schema)
            rows = rows.unionByName(tail) if late else tail
        return rows.select(*schemas.JOBS.fieldNames())

    def brought(self, batch_id: int) -> DataFrame:
        """The rows one batch brought, whether merged or not."""
        return self.changes(batch_id - 1, batch_id)

    def append_batch(self, df: DataFrame, batch_id: int) -> None:
        if self.holds(batch_id):
            return
        rows = df.withColumns({
            "seniority": F.lit(None).cast("string"), "ingest_date": utc_day(F.col("ingested_at")),
            "batch_id": F.lit(batch_id).cast("long"), "row": F.monotonically_increasing_id()}).persist()
        try:
            # Which rows to keep is found out on keys; the rows themselves move once, or not at all
            # where the keys are few enough to be broadcast.
            kept = self._unseen(self._one_per_event(rows), rows).select("row")
            kept = rows.join(kept, "row", "left_semi").select(*self.schema.fieldNames())
            self._write(kept, self._batch(batch_id))
        finally:
            rows.unpersist()

    def _key(self) -> list[str]:
        return ["event_id"] if self.any_day else ["ingest_date", "event_id"]

    def _one_per_event(self, rows: DataFrame) -> DataFrame:
        # The copy of the least hash, so a replay keeps the same one. Copies are merged
        # within each task before the shuffle: many of one event are no skew.
        content = F.xxhash64(*schemas.JOBS.fieldNames())
        return rows.groupBy(*self._key()).agg(F.min_by("row", content).alias("row"))

    def _unseen(self, events: DataFrame, rows: DataFrame) -> DataFrame:
        if self.is_empty():
            return events
        stored = self.rows().select(*self._key())
        if not self.any_day:  # a value per day of the batch; read before the scan starts
            days = rows.agg(F.collect_set("ingest_date").alias("v")).scalar()
            stored = stored.where(F.array_contains(days, F.col("ingest_date")))
        # Dealt by key, however small the files are: the stored ids of some days grow with the table, and
        # broadcast they would cross the driver with every batch.
        return events.join(stored.hint("merge"), self._key(), "left_anti")

    def _laid_out(self, rows: DataFrame) -> DataFrame:
        # By time: small tables get one file a day, in large ones each file has a part of a day, and readers
        # of a page leave the others out.
        order = ("ingest_date", "ingested_at")
        return rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def _beside(self, kind: str, rows: DataFrame) -> DataFrame:
        return self._summed(rows).coalesce(1)  # a row per day and hour

    def _summed(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("ingest_date", utc_hour(F.col("ingested_at")).alias("hour")).agg(
            F.count("*").alias("n"))

    def summary(self) -> DataFrame:
        """Rows by day and hour: those of runs as stored, those of later batches counted."""
        held = self.manifest()
        stored = self._runs(held, "summary", self.summary_schema).drop("run")
        return stored.unionByName(self._summed(self.tail_rows(held))) if self.tail(held) else stored

    def search(self, company: str | None = None, location: str | None = None,
               role_category: str | None = None, seniority: str | None = None,
               limit: int = 20, offset: int = 0, after: tuple | None = None) -> DataFrame:
        """``search_jobs`` over the stored table, reading the page's days only."""
        terms = job_filters(company, location, role_category, seniority)
        return find_page(self.rows(), terms, limit, offset, after, "ingest_date", self.summary()).select(
            *schemas.JOBS.fieldNames())


MODES = ("queries", "single_pass", "feed")


class Tables:
    """The tables of one pipeline under one folder, with its checkpoints.

    The modes count differently (see ``TrendTable``) and have folders of their own.
    """

    def __init__(self, spark: SparkSession, root: str, mode: str = "queries",
                 any_day: bool = False):
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
        self.spark, self.mode, self.root, self.base = spark, mode, root, f"{root.rstrip('/')}/{mode}"
        kind = "totals" if mode == "queries" else "deltas"
        self.jobs = JobsTable(spark, f"{self.base}/jobs", any_day)
        self.trend_tech = TrendTable(spark, f"{self.base}/trend_tech", "tech", kind)
        self.trend_role = TrendTable(spark, f"{self.base}/trend_role", "role_category", kind)
        self.rejects = BatchTable(spark, f"{self.base}/rejects", schemas.REJECTS)
        # Of a topic read in a single pass; empty for files.
        self.offsets = BatchTable(spark, f"{self.base}/offsets", RANGES)

    def checkpoint(self, query: str) -> str:
        return f"{self.base}/_checkpoints/{query}"

    def all(self) -> dict[str, BatchTable]:
        return {"jobs": self.jobs, "trend_tech": self.trend_tech,
                "trend_role": self.trend_role, "rejects": self.rejects}

    def register_views(self) -> None:
        """Temporary views jobs, trend_tech and trend_role over the tables as they are now."""
        for name in ("jobs", "trend_tech", "trend_role"):
            self.all()[name].read().drop("window_date").createOrReplaceTempView(name)


def init_tables(spark: SparkSession, root: str, mode: str = "queries",
                any_day: bool = False) -> Tables:
    """The tables under a folder; made empty where they do not exist yet."""
    tables = Tables(spark, root, mode, any_day)
    for table in tables.all().values():
        folders.make(spark, table.path)
    return tables


def reset(spark: SparkSession, root: str, mode: str = "queries") -> Tables:
    """Empty the tables and forget how far their queries had read, as one step.

    Checkpoints go first: a reset that breaks off half-way leaves tables without
    checkpoint, which the pipeline refuses to start on, and can be run again.
    """
    tables = Tables(spark, root, mode)
    folders.remove(spark, f"{tables.base}/_checkpoints")
    for table in (*tables.all().values(), tables.offsets):
        folders.remove(spark, table.path)
    return init_tables(spark, root, mode)
