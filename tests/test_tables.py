import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from hiretide.functions.times import utc_day
from hiretide.operators.reads import cursor_of, search_jobs, top_techs
from hiretide.schemas import JOBS
from hiretide.sources import folders
from hiretide.streaming import tables as T

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def jobs(spark, *rows):
    """(id, minutes from start, title) as enriched postings."""
    return spark.createDataFrame(
        [(i, START + timedelta(minutes=m), "c", t, "l", None, "Other", "d", "u", ["go"])
         for i, m, t in rows], JOBS)


def counts(spark, *rows):
    """(minute, tag, count) as a trend."""
    df = spark.createDataFrame([(START + timedelta(minutes=m), k, n) for m, k, n in rows],
                               "window_start timestamp, tech string, count long")
    return df.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 5 MINUTES")) \
        .withColumn("window_size_sec", F.lit(300))


def stored(table):
    return sorted((r["event_id"], r["title"]) for r in table.read().collect())


def trend(table):
    return sorted((r["window_start"].minute, r["tech"], r["count"]) for r in table.read().collect())


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "tables")


def test_empty_tables(spark, root):
    tables = T.init_tables(spark, root)
    assert all(t.read().isEmpty() for t in tables.all().values())
    assert tables.jobs.search().isEmpty()
    assert tables.jobs.read().schema == JOBS
    tables.register_views()
    assert spark.sql("SELECT count(*) FROM jobs").first()[0] == 0


def test_batches_add_up_and_replays_change_nothing(spark, root):
    table = T.init_tables(spark, root).jobs
    table.append_batch(jobs(spark, ("a", 0, "x"), ("b", 1, "x")), 0)
    table.append_batch(jobs(spark, ("c", 2, "x")), 1)
    table.append_batch(jobs(spark, ("c", 2, "x"), ("d", 2, "x")), 1)
    assert stored(table) == [("a", "x"), ("b", "x"), ("c", "x")]


def files(folder):
    """Data files under a folder, by name, with their time of writing."""
    return {os.path.relpath(os.path.join(d, f), folder): os.path.getmtime(os.path.join(d, f))
            for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_half_written_batch_is_not_read_and_is_written_again(spark, root):
    table = T.init_tables(spark, root).jobs
    table.append_batch(jobs(spark, ("a", 0, "x")), 0)
    table.append_batch(jobs(spark, ("b", 0, "x"), ("c", 3000, "x")), 1)
    folders.remove(spark, f"{table.path}/batches/batch=000000000001/_SUCCESS")
    assert stored(table) == [("a", "x")]
    table.append_batch(jobs(spark, ("b", 0, "y")), 1)
    assert stored(table) == [("a", "x"), ("b", "y")]


def test_copies_within_and_across_batches(spark, root):
    table = T.init_tables(spark, root).jobs
    table.append_batch(jobs(spark, *[("a", 0, "x")] * 500, ("a", 0, "w"), ("b", 0, "x")), 0)
    table.append_batch(jobs(spark, ("a", 0, "v"), ("c", 0, "x"), ("c", 0, "x")), 1)
    assert stored(table) == [("a", "w"), ("b", "x"), ("c", "x")]


@pytest.mark.parametrize("any_day", [False, True])
def test_stored_ids_do_not_cross_the_driver(spark, root, any_day):
    """However small their files are: they grow with the table, and each batch would send them again."""
    table = T.init_tables(spark, root, any_day=any_day).jobs
    table.append_batch(jobs(spark, *((str(i), 0, "x") for i in range(50))), 0)
    rows = jobs(spark, ("1", 0, "x"), ("new", 0, "y")).withColumns(
        {"ingest_date": utc_day(F.col("ingested_at")), "row": F.monotonically_increasing_id()})
    unseen = table._unseen(table._one_per_event(rows), rows)
    assert [r.event_id for r in unseen.collect()] == ["new"]
    assert "Broadcast" not in unseen._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("any_day, kept", [(False, 2), (True, 1)])
def test_one_id_on_two_days(spark, root, any_day, kept):
    table = T.init_tables(spark, root, any_day=any_day).jobs
    table.append_batch(jobs(spark, ("a", 0, "x")), 0)
    table.append_batch(jobs(spark, ("a", 60 * 24, "x")), 1)
    assert table.read().count() == kept


def test_many_days_are_stored_whole(spark, root):
    rows = [(f"e{i}", i * 60 * 12, "x") for i in range(40)]
    table = T.init_tables(spark, root).jobs
    table.append_batch(jobs(spark, *rows[:30]), 0)
    table.merge()
    table.append_batch(jobs(spark, *rows), 1)
    assert stored(table) == sorted((i, t) for i, _, t in rows)
    table.merge()
    names = files(f"{table.path}/base")
    assert len({n.split("/")[1] for n in names}) == 20 and len(names) == 15 + 5  # a file a day and run


def test_a_batch_is_compared_with_its_own_days(spark, root):
    table = T.init_tables(spark, root).jobs
    table.append_batch(jobs(spark, *[(f"e{i}", i % 9 * 1440, "x") for i in range(200)]), 0)
    table.merge()
    new = jobs(spark, ("e0", 0, "y"), ("n1", 0, "y"))
    keyed = new.withColumns({"ingest_date": utc_day(F.col("ingested_at")),
                             "row": F.monotonically_increasing_id()})
    unseen = table._unseen(table._one_per_event(keyed), keyed)
    assert [r["event_id"] for r in unseen.collect()] == ["n1"]
    scan = [x for x in unseen._jdf.queryExecution().executedPlan().toString().splitlines()
            if "FileScan parquet" in x and "event_id" in x]
    assert scan and all("array_contains" in x.split("PartitionFilters")[1] for x in scan)
    partitions = _metric(unseen._jdf.queryExecution().executedPlan(), "numPartitions")
    assert partitions and max(partitions) == 1  # of 9 days


def _metric(plan, name):
    """Values of a metric of the plan's file scans."""
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if kind == "FileSourceScanExec" and node.metrics().contains(name):
            found.append(node.metrics().apply(name).value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_wide_rows_move_once(spark, root):
    table = T.init_tables(spark, root).jobs
    jobs(spark, ("a", 0, "x"), ("b", 0, "x")).repartition(2).write.parquet(f"{root}/in")
    rows = spark.read.schema(JOBS).parquet(f"{root}/in").withColumns({
        "ingest_date": utc_day(F.col("ingested_at")),
        "row": F.monotonically_increasing_id()})
    kept = table._unseen(table._one_per_event(rows), rows).select("row")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rows.join(kept, "row", "left_semi")._jdf.queryExecution().executedPlan()
        exchanged = _exchanged(plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(exchanged) > 1 and sum("description" in columns for columns in exchanged) == 1, exchanged


def _exchanged(plan):
    """Output columns of each exchange."""
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.initialPlan())
            continue
        if kind == "ShuffleExchangeExec":
            found.append(node.output().toString())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_search_equals_search_of_all_rows(spark, root):
    table = T.init_tables(spark, root).jobs
    rows = [(f"e{i:03d}", i * 97 % 6000 // 60 * 60, "x") for i in range(90)]
    for n in range(3):
        batch = jobs(spark, *rows[n * 30:n * 30 + 30])
        batch = batch.withColumn("company", F.when(F.col("event_id") < "e010", "rare").otherwise("c"))
        table.append_batch(batch, n)
        if n == 1:
            table.merge()
    every = sorted((r for r in table.read().collect()),
                   key=lambda r: (-r["ingested_at"].timestamp(), r["event_id"]))
    rare = [r for r in every if r["company"] == "rare"]
    for terms, wanted in (
            ({}, every[:20]), ({"company": "rare"}, rare), ({"limit": 7, "offset": 50}, every[50:57]),
            ({"offset": 88}, every[88:]), ({"offset": 90}, []), ({"offset": 500}, []),
            ({"offset": 1, "limit": 200}, every[1:]), ({"location": "nowhere"}, []),
            ({"company": "rare", "limit": 3, "offset": 2}, rare[2:5]),
            ({"after": cursor_of(every[33]), "limit": 9}, every[34:43]),
            ({"after": cursor_of(every[33]), "limit": 9, "offset": 4}, every[38:47]),
            ({"after": cursor_of(every[-1])}, [])):
        assert table.search(**terms).collect() == wanted
        assert search_jobs(table.read(), **terms).collect() == wanted
    with pytest.raises(ValueError):
        table.search(limit=0)


def test_deep_pages_of_one_instant(spark, root):
    """Ten thousand jobs of one instant between a few others; pages cost no sort in one task."""
    many = spark.range(10_000).select(
        F.format_string("m%05d", "id").alias("event_id"), F.lit(START).alias("ingested_at"),
        *(F.lit("x").alias(c) for c in ("company", "title", "location")),
        F.lit(None).cast("string").alias("seniority"),
        *(F.lit("x").alias(c) for c in ("role_category", "description", "url")),
        F.array(F.lit("go")).alias("techs"))
    few = jobs(spark, *[(f"f{i}", i - 3, "x") for i in range(7) if i != 3])
    table = T.init_tables(spark, root).jobs
    table.append_batch(many.unionByName(few), 0)
    order = ["f6", "f5", "f4", *(f"m{i:05d}" for i in range(10_000)), "f2", "f1", "f0"]
    for offset in (0, 2, 9_999, 10_001, 10_004, 10_006, 20_000):
        for page in (table.search(offset=offset, limit=5),
                     search_jobs(table.read(), offset=offset, limit=5)):
            assert [r["event_id"] for r in page.collect()] == order[offset:offset + 5]
            plan = page._jdf.queryExecution().executedPlan().toString()
            assert "SinglePartition" not in plan and "GlobalLimit" not in plan


@pytest.fixture
def read_rows(spark, monkeypatch):
    """The numbers of rows that were looked at to find a page, call by call of the tables' rows."""
    from hiretide.operators import reads
    asked = []
    real = reads._counted

    def counted(rows, by):
        asked.append(rows.count())
        return real(rows, by)

    monkeypatch.setattr(reads, "_counted", counted)
    return asked


def test_pages_without_filter_count_no_history(spark, root, read_rows, monkeypatch):
    table = T.init_tables(spark, root).jobs
    rows = [(f"e{i:03d}", i * 60, "x") for i in range(24 * 9)]
    table.append_batch(jobs(spark, *rows[:200]), 0)
    table.merge()
    table.append_batch(jobs(spark, *rows[200:]), 1)
    newest = [r[0] for r in rows[::-1]]
    for top_rows in (10_000, 8):  # on both sides of the bound the page is the same
        monkeypatch.setattr("hiretide.operators.reads.TOP_ROWS", top_rows)
        for offset in (0, 5, 30, 100, 215, 216):
            page = table.search(offset=offset, limit=5)
            assert [r["event_id"] for r in page.collect()] == newest[offset:offset + 5]
            assert len(read_rows) <= (top_rows < 10) and sum(read_rows) <= 1  # the seconds of one hour
            read_rows.clear()


def test_a_search_looks_at_the_newest_days_until_it_has_enough(spark, root, read_rows, monkeypatch):
    monkeypatch.setattr("hiretide.operators.reads.WALK_ROWS", 24)
    table = T.init_tables(spark, root).jobs
    table.append_batch(jobs(spark, *[(f"e{i:03d}", i * 60, "x") for i in range(24 * 9)]), 0)
    table.merge()
    assert table.search(company="c", limit=5).count() == 5
    assert read_rows == [24]  # one day
    read_rows.clear()
    assert table.search(company="c", limit=20, offset=30).count() == 20
    assert read_rows == [24, 48]
    read_rows.clear()
    assert table.search(company="none").count() == 0
    assert len(read_rows) <= 4  # 1, 2, 4 and the last days


def test_default_page_reads_the_newest_day_only(spark, root):
    table = T.init_tables(spark, root).jobs
    table.append_batch(jobs(spark, *[(f"e{i:03d}", i * 60, "x") for i in range(24 * 9)]), 0)
    table.merge()
    page = table.search(limit=5)
    assert [r["event_id"] for r in page.collect()] == [f"e{i}" for i in (215, 214, 213, 212, 211)]
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and ">= 2024-01-09" in plan
    assert _metric(page._jdf.queryExecution().executedPlan(), "numPartitions") == [1]


def test_totals_keep_untouched_groups(spark, root):
    table = T.init_tables(spark, root).trend_tech
    table.append_batch(counts(spark, (0, "python", 1), (0, "airflow", 1)), 0)
    table.append_batch(counts(spark, (0, "python", 2)), 1)
    assert trend(table) == [(0, "airflow", 1), (0, "python", 2)]


def test_deltas_add_up(spark, root):
    table = T.init_tables(spark, root, "single_pass").trend_tech
    table.append_batch(counts(spark, (0, "python", 1), (0, "airflow", 1)), 0)
    table.append_batch(counts(spark, (0, "python", 2), (5, "go", 4)), 1)
    assert trend(table) == [(0, "airflow", 1), (0, "python", 3), (5, "go", 4)]


@pytest.mark.parametrize("mode", T.MODES)
def test_merges_change_no_row(spark, root, mode):
    tables = T.init_tables(spark, root, mode)
    for n in range(7):
        tables.trend_tech.append_batch(counts(spark, (0, "go", n + 1), (n, f"k{n % 2}", 1)), n)
        tables.jobs.append_batch(jobs(spark, (f"e{n}", n * 900, "x"), ("same", 0, "x")), n)
        tables.rejects.append_batch(spark.createDataFrame([(f"r{n}",)], "raw string"), n)
        for table, rows in ((tables.trend_tech, trend), (tables.jobs, stored)):
            before = rows(table)
            if n % 3 == 2:
                table.merge()
                assert table.tail() == [] and rows(table) == before
                assert table.holds(n) and table.holds(0) and not table.holds(n + 1)
    assert [r.level for r in tables.jobs.manifest().runs] == [0, 0]
    assert [(r.first, r.last) for r in tables.trend_tech.manifest().runs] == [(0, 5)]
    tables.rejects.merge()
    assert sorted(r[0] for r in tables.rejects.read().collect()) == [f"r{n}" for n in range(7)]
    for table in (tables.trend_tech, tables.jobs):
        table.merge()
        table.merge()
        # Batches of the merge before are gone, those of the last one stay for readers.
        assert table._numbers("batches/batch") == [6]


def test_the_tail_stays_short_over_many_batches(spark, root):
    table = T.init_tables(spark, root, "single_pass").trend_tech
    row = counts(spark, (0, "go", 1)).persist()
    every, most = 50, 0
    for n in range(200):
        table.append_batch(row, n)
        if (n + 1) % every == 0:
            table.merge()
        most = max(most, len(table.tail()))
    assert most <= every and len(table._numbers("batches/batch")) <= every
    assert trend(table) == [(0, "go", 200)]


@pytest.mark.parametrize("mode", T.MODES)
def test_replay_of_a_merged_batch(spark, root, mode):
    table = T.init_tables(spark, root, mode).trend_tech
    batches = [counts(spark, (0, "go", n + 1), (n, "sql", 2)) for n in range(2)]
    for n, batch in enumerate(batches):
        table.append_batch(batch, n)
    before = trend(table)
    table.merge()
    table.append_batch(batches[1], 1)
    assert trend(table) == before


def test_a_merge_that_breaks_off_changes_nothing(spark, root, monkeypatch):
    tables = T.init_tables(spark, root)
    for table, rows, read in ((tables.trend_tech, lambda n: counts(spark, (n, "go", 1)), trend),
                              (tables.jobs, lambda n: jobs(spark, (f"e{n}", n, "x")), stored)):
        for n in range(2):
            table.append_batch(rows(n), n)
        before = read(table)
        for step in ("_write", "_switch", "write_text"):
            broken = _broken_at(monkeypatch, step)
            with pytest.raises(OSError):
                table.merge()
            broken.undo()
            assert table.tail() == [0, 1] and read(table) == before
        table.merge()
        assert table.tail() == [] and read(table) == before
        table.append_batch(rows(1), 1)
        assert read(table) == before


def _broken_at(monkeypatch, step):
    """The step that fails from now on, when it is half done."""
    patch = pytest.MonkeyPatch()

    def broken(*args, **more):
        raise OSError("lost")

    if step == "write_text":
        patch.setattr(folders, step, broken)
    else:
        patch.setattr(T.BatchTable, step, broken)
    return patch


def test_runs_are_few_after_a_thousand_merges():
    runs, moved = [], 0
    for n in range(1000):
        taken, level = T.absorbed(runs)
        moved += sum(r.last - r.first + 1 for r in taken)
        gone = {r.run for r in taken}
        first = min([n, *(r.first for r in taken)])
        runs = [r for r in runs if r.run not in gone] + [T.Run(n, level, first, n)]
        assert len(runs) <= 15 and max(r.level for r in runs) <= 4
        assert sorted(b for r in runs for b in range(r.first, r.last + 1)) == list(range(n + 1))
    assert moved <= 5 * 1000  # a batch is rewritten once a level


def test_levelled_runs_hold_every_row_in_one_scan(spark, root):
    table = T.init_tables(spark, root).jobs
    for n in range(21):
        table.append_batch(jobs(spark, (f"e{n:02d}", n, "x"), ("same", 0, "x")), n)
        table.merge()
    held = table.manifest()
    assert [r.level for r in held.runs] == [2, 1, 0] and held.up_to == 20
    assert [r[0] for r in stored(table)] == [f"e{n:02d}" for n in range(21)] + ["same"]
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Union" not in plan
    table.append_batch(jobs(spark, ("e00", 0, "y"), ("new", 5, "x")), 21)
    assert len(stored(table)) == 23
    # Folders that no manifest names are removed by the merge after; so are old manifests.
    table.merge()
    there = {int(m.split("run=")[1]) for m in folders.matching(spark, f"{table.path}/base/run=*")}
    held = table.manifest()
    assert there == {r.run for r in held.runs} | set(held.dropped)
    assert len(table._manifests()) <= 2


def test_readers_that_began_before_a_merge_read_on(spark, root):
    table = T.init_tables(spark, root).jobs
    for n in range(4):
        table.append_batch(jobs(spark, (f"e{n}", n, "x")), n)
        before = table.read()
        table.merge()
        assert before.count() == n + 1


def test_changes_read_new_batches_only(spark, root):
    table = T.init_tables(spark, root).jobs
    for n in range(6):
        table.append_batch(jobs(spark, (f"e{n}", n, "x"), (f"f{n}", n, "x")), n)
        if n in (1, 3):
            table.merge()
    for since in range(-1, 6):
        got = sorted(r["event_id"] for r in table.changes(since).collect())
        assert got == sorted(f"{k}{n}" for k in "ef" for n in range(since + 1, 6))
    assert [sorted(r["event_id"] for r in table.brought(n).collect()) for n in range(6)] == [
        [f"e{n}", f"f{n}"] for n in range(6)]
    files_ = table.changes(3).inputFiles()
    assert files_ and not any("/base/" in f for f in files_)
    assert not any("run=0" in f for f in table.changes(1).inputFiles())
    assert table.last_batch() == 5


def test_two_writers_cannot_both_switch(spark, root):
    table = T.init_tables(spark, root).jobs
    table.append_batch(jobs(spark, ("a", 0, "x")), 0)
    held = table.manifest()
    table.merge()
    with pytest.raises(FileExistsError):
        table._switch(held, held)


@pytest.mark.parametrize("mode", T.MODES)
def test_recount_of_a_range(spark, root, mode):
    table = T.init_tables(spark, root, mode).trend_tech
    with pytest.raises(RuntimeError):
        table.replace_range(counts(spark, (0, "go", 9)), 300)
    table.append_batch(counts(spark, (0, "go", 9)), 0)
    table.append_batch(counts(spark, (5, "go", 1), (10, "go", 1), (15, "sql", 1)), 1)
    table.replace_range(counts(spark, (5, "java", 4), (10, "go", 6)), 300)
    assert trend(table) == [(0, "go", 9), (5, "java", 4), (10, "go", 6), (15, "sql", 1)]
    table.replace_range(counts(spark, (0, "go", 10)), 300)
    assert trend(table)[0] == (0, "go", 10)
    table.append_batch(counts(spark, (20, "go", 1)), 2)
    assert len(trend(table)) == 5
    # The stream goes on from its own counts: one more "go" at 5 minutes, two more at 10.
    more = [(5, "go", 2), (10, "go", 3)] if mode == "queries" else [(5, "go", 1), (10, "go", 2)]
    table.append_batch(counts(spark, *more), 3)
    wanted = [(0, "go", 10), (5, "go", 1), (5, "java", 4), (10, "go", 8), (15, "sql", 1), (20, "go", 1)]
    assert trend(table) == wanted
    table.merge()
    assert trend(table) == wanted


def test_recount_changes_the_days_of_its_range_only(spark, root):
    table = T.init_tables(spark, root, "single_pass").trend_tech
    day = 24 * 60
    table.append_batch(counts(spark, *[(d * day, k, 1) for d in range(6) for k in ("go", "sql")]), 0)
    table.merge()
    base = f"{table.path}/base"
    before = files(base)
    table.replace_range(counts(spark, (2 * day, "go", 7), (3 * day, "go", 8)), 300)
    after = files(base)
    added = {n.split("/")[2] for n in after.keys() - before.keys()}
    assert added == {"window_date=2024-01-03", "window_date=2024-01-04"}
    assert all(before[n] == after[n] for n in before)
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "run" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert sorted((r["window_start"].day, r["tech"], r["count"]) for r in table.read().collect()) == [
        (1, "go", 1), (1, "sql", 1), (2, "go", 1), (2, "sql", 1), (3, "go", 7), (4, "go", 8),
        (5, "go", 1), (5, "sql", 1), (6, "go", 1), (6, "sql", 1)]


@pytest.mark.parametrize("mode", T.MODES)
def test_a_reader_sees_all_of_a_recount_or_nothing(spark, root, mode):
    """Broken off before each thing that it writes, renames or removes; a reader lists at that moment."""
    table = T.init_tables(spark, root, mode).trend_tech
    table.append_batch(counts(spark, (0, "go", 1), (5, "go", 1), (5, "sql", 2)), 0)
    table.append_batch(counts(spark, (1500, "go", 3)), 1)
    old = trend(table)
    new = sorted([(0, "go", 1), (5, "go", 4), (0, "go", 3)])
    days = sorted((r["window_start"].day, r["count"]) for r in table.rolled(86400).collect())
    for at in range(40):
        patch, steps = pytest.MonkeyPatch(), []

        def stepped(real):
            def run(*args, **more):
                steps.append(1)
                if len(steps) > at:
                    raise OSError("lost")
                return real(*args, **more)
            return run

        patch.setattr(T.BatchTable, "_write", stepped(T.BatchTable._write))
        for name in ("write_text", "remove"):
            patch.setattr(folders, name, stepped(getattr(folders, name)))
        try:
            table.replace_range(counts(spark, (5, "go", 4)), 300)
            done = True
        except OSError:
            done = False
        patch.undo()
        seen = trend(table)
        assert seen in (old, new)
        by_day = sorted((r["window_start"].day, r["count"]) for r in table.rolled(86400).collect())
        assert (by_day == days) == (seen == old)
        if done:
            break
    assert done and at > 3 and trend(table) == new
    table.merge()
    assert trend(table) == new


@pytest.mark.parametrize("mode", T.MODES)
def test_roll_ups_follow_batches_merges_and_recounts(spark, root, mode):
    table = T.init_tables(spark, root, mode).trend_tech

    def wanted(size):
        found = {}
        for r in table.read().collect():
            at = int(r["window_start"].timestamp()) // size * size
            found[at, r["tech"]] = found.get((at, r["tech"]), 0) + r["count"]
        return sorted((*k, n) for k, n in found.items())

    def check():
        for size in T.ROLLUPS:
            got = table.rolled(size).collect()
            assert sorted((int(r["window_start"].timestamp()), r["tech"], r["count"]) for r in got) == wanted(size)
            assert all((r["window_end"] - r["window_start"]).total_seconds() == size for r in got)

    check()
    for n in range(5):
        table.append_batch(counts(spark, (0, "go", n + 1), (n * 35, "sql", 2), (1440 + n, "go", 1)), n)
        check()
        if n % 2:
            table.merge()
            check()
    table.replace_range(counts(spark, (35, "java", 9), (70, "go", 1)), 300)
    check()
    table.append_batch(counts(spark, (65, "go", 4)), 5)
    check()
    table.merge()
    check()
    with pytest.raises(ValueError):
        table.rolled(7000)


def test_a_day_of_a_roll_up_is_read_alone(spark, root):
    table = T.init_tables(spark, root, "single_pass").trend_tech
    table.append_batch(counts(spark, *[(d * 1440, "go", d + 1) for d in range(5)]), 0)
    table.merge()
    top = top_techs(table.rolled(86400), 86400)
    assert [r["count"] for r in top.collect()] == [5]
    assert "/base/" not in "".join(table.rolled(86400).inputFiles())
    assert 1 in _metric(top._jdf.queryExecution().executedPlan(), "numPartitions")


def test_the_latest_window_is_read_from_one_day(spark, root):
    table = T.init_tables(spark, root, "single_pass").trend_tech
    table.append_batch(counts(spark, *[(d * 1440, "go", d + 1) for d in range(5)]), 0)
    table.merge()
    top = top_techs(table.read())
    assert [r["count"] for r in top.collect()] == [5]
    plan = top._jdf.queryExecution().executedPlan()
    filters = [x.split("PartitionFilters: ")[1].split("]")[0] for x in plan.toString().splitlines()
               if "FileScan" in x]
    assert any("window_size_sec" in f and "window_date" in f for f in filters)
    assert 1 in _metric(plan, "numPartitions")


def test_reset(spark, root):
    tables = T.init_tables(spark, root)
    tables.jobs.append_batch(jobs(spark, ("a", 0, "x")), 0)
    folders.make(spark, tables.checkpoint("jobs"))
    assert T.init_tables(spark, root).jobs.read().count() == 1
    T.reset(spark, root)
    assert tables.jobs.read().isEmpty()
    assert not folders.exists(spark, tables.checkpoint("jobs"))


def test_utc_day_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 30, tzinfo=timezone.utc),),
                                    (datetime(1969, 12, 31, 23, 59, 59, 5, tzinfo=timezone.utc),)],
                                   "t timestamp")
        assert [str(r[0]) for r in df.select(utc_day(F.col("t"))).collect()] == [
            "2024-01-01", "1969-12-31"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_bad_names(spark, root):
    with pytest.raises(ValueError):
        T.Tables(spark, root, "other")
    with pytest.raises(ValueError):
        T.TrendTable(spark, root, "tech", "other")
