import random

import pytest
from oracle import connect, difference
from pyspark.sql import functions as F

from hiretide.llm import line_dedup, queries


def pairs(lines):
    """(first place, last place, text) of neighbouring lines with a word."""
    solid = [i for i, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
    return [(i, j, "\n".join(lines[i:j + 1])) for i, j in zip(solid, solid[1:])]


def brute(rows):
    """Texts and numbers of lines that went of (id, text) rows; equal rows are one document."""
    places = {}
    for ident, text in {r for r in rows if r[0] is not None and r[1] is not None}:
        for k, (_, _, pair) in enumerate(pairs(text.split("\n"))):
            places.setdefault(pair, set()).add((ident, k))
    out = []
    for ident, text in rows:
        gone = set()
        lines = [] if ident is None or text is None else text.split("\n")
        for k, (i, j, pair) in enumerate(pairs(lines)):
            if min(places[pair]) != (ident, k):
                gone |= set(range(i, j + 1))
        out.append((ident, "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text, len(gone)))
    return sorted(out, key=str)


def spark_rows(df):
    return sorted(((r[0], r[1], r[2]) for r in line_dedup.dedup_lines(
        df, count_col="gone").select("doc_id", "text", "gone").collect()), key=str)


def test_equals_brute_force(spark):
    chosen = random.Random(11)
    passages = [[f"shared {p} line {i}" for i in range(chosen.randint(2, 12))] for p in range(6)]
    rows = []
    for i in range(300):
        lines = [f"own {i} {k}" for k in range(chosen.randint(0, 5))]
        for _ in range(chosen.randint(0, 3)):
            at = chosen.randint(0, len(lines))
            lines[at:at] = chosen.choice(passages) if chosen.random() < 0.8 else passages[0]
        rows.append((i, "\n".join(lines)))
    got = spark_rows(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute(rows) and sum(r[2] for r in got) > 100


def test_bounds_move_with_the_passage(spark):
    passage = "\n".join(f"line {i} of a long passage" for i in range(60))
    rows = [(1, passage), (2, "other start\n" + passage + "\nother end"), (3, "x\ny\nz\n" + passage)]
    left = {r[0]: r[1] for r in spark_rows(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert left == {1: passage, 2: "other start\nother end", 3: "x\ny\nz"}


@pytest.mark.parametrize("n", [2, 3, 5])
def test_short_passages_go_whole_wherever_they_stand(spark, n):
    passage = [f"sentence {i} of it has some words" for i in range(n)]
    rows = [(1, "\n".join(passage))]
    for i in range(2, 30):
        own = [f"own {i} {k}" for k in range(i % 5)]
        gaps = ["", "  "][:i % 3]  # lines without a word inside, which make it another passage
        rows.append((i, "\n".join(own[:2] + passage[:1] + gaps + passage[1:] + own[2:])))
    for i, text, gone in spark_rows(spark.createDataFrame(rows, "doc_id long, text string")):
        if i > 1 and i % 3 == 0:
            assert gone == n and all(line.startswith("own") for line in text.split("\n") if line)
        assert i > 1 or not gone


def test_what_goes_stands_in_an_earlier_text(spark, docs):
    left = {r[0]: r[1] for r in spark_rows(docs.select("doc_id", "text"))}
    lines = {x for t in left.values() if t for x in t.split("\n")}
    assert {x for r in docs.collect() if r.text for x in r.text.split("\n") if x.strip()} <= lines


def test_few_repeated_pairs_are_left(spark):
    """Later copies of two neighbouring lines that both are still there, of those there were."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    left = {r[0]: set((r[1] or "").split("\n")) for r in spark_rows(docs)}
    first, later, stay = {}, 0, 0
    for ident, text in sorted(tuple(r) for r in docs.collect()):
        lines = (text or "").split("\n")
        for i, j, pair in pairs(lines):
            if first.setdefault(pair, ident) != ident:
                later += 1
                stay += lines[i] in left[ident] and lines[j] in left[ident]
    assert later > 500 and stay < 0.01 * later


def test_hashes_that_meet_take_nothing_else_out(spark, monkeypatch):
    """Equal hashes of different lines in rows of one id: the hash at the place decides."""
    rows = [(1, "a b\nc d\ne f"), (2, "a b\nc d"), (2, "x y\nz w"), (2, "q r\na b\nc d")]
    got = spark_rows(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute(rows) and ("2", 0) not in got
    assert {r[1] for r in got} == {"a b\nc d\ne f", "", "x y\nz w", "q r"}


def test_chunks_are_bounded_by_their_own_lines(spark):
    """Chunks inside a passage are the same whatever stands around it, and longer than a pair."""
    passage = [f"line {i} of a long passage" for i in range(200)]
    rows = [(1, "\n".join(passage)), (2, "\n".join(["other", "start", *passage, "end"]))]
    df = spark.createDataFrame(rows, "id long, text string")
    found = {r.id: [bytes(c.hash) for c in r["__chunks"]]
             for r in line_dedup.with_chunks(df, df.text).collect()}
    assert 20 < len(found[1]) < 100
    assert set(found[1][1:-1]) <= set(found[2])
    again = line_dedup.repeated_places(df.toDF("__id", "__text")).collect()
    assert {r["__id"] for r in again} == {2} and max(r["__size"] for r in again) > 1
    assert sum(r["__size"] for r in again) == len(passage) - 1


def test_bytes_decide_under_an_equal_hash(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "_digest", lambda text: F.sha2(F.substring(text, 1, 0), 256))
    rows = [(1, "a b\nc d"), (2, "x y\nz w"), (3, "a b\nc d"), (4, "q r\na b\nc d\ne f")]
    got = {r[0]: r[1:] for r in spark_rows(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert got[1] == ("a b\nc d", 0) and got[2] == ("x y\nz w", 0) and got[3] == ("", 2)


def test_edges(edge_docs, no_docs):
    assert spark_rows(edge_docs) == brute([(r.doc_id, r.text) for r in edge_docs.collect()])
    out = line_dedup.dedup_lines(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == edge_docs.count()
    assert line_dedup.dedup_lines(no_docs, drop_emptied=True).collect() == []


def test_emptied_rows_go_on_demand(spark):
    text = "\n".join(f"the same words {i}" for i in range(40))
    df = spark.createDataFrame([(1, text), (2, text), (3, ""), (4, "one")], "doc_id long, text string")
    left = {r.doc_id: r.text for r in line_dedup.dedup_lines(df, drop_emptied=True).collect()}
    assert left[1] == text and left[3] == "" and left[4] == "one"
    assert 2 not in left or len(left[2]) < len(text) // 2


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_agrees(spark, name):
    for sf in ("sf0.001", "sf0.01"):
        sf_dir = f"/root/testdata/{sf}"
        assert difference(queries.QUERIES[name](spark, sf_dir), connect(sf_dir),
                          queries.ORACLE_SQL[name]) is None


def test_no_python_in_the_plans(spark, docs):
    from hiretide.llm import licenses

    for df in (line_dedup.dedup_lines(docs), licenses.find_licenses(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct"))
