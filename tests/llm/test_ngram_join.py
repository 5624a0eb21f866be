import collections
import random
import re

import pytest

from hiretide.llm import ngram_join
from hiretide.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n=5):
    own = [w.encode().lower() for w in WORD.findall(text or "")]
    if not own:
        return frozenset()
    return frozenset(tuple(own[i:i + n]) for i in range(len(own) - n + 1)) or frozenset([tuple(own)])


def brute(rows):
    """(id, set size, component) of (id, text) rows with ids of their own."""
    sets = {i: shingles(t) for i, t in rows}
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    common = collections.Counter((a, b) for own in holders.values()
                                 for k, a in enumerate(sorted(own)) for b in sorted(own)[k + 1:])
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), o in common.items():
        if 100 * o >= 75 * (len(sets[a]) + len(sets[b]) - o):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return sorted((i, len(s), find(i)) for i, s in sets.items())


def joined(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id)
                  for r in ngram_join.near_duplicates(df).collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    assert joined(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_groups_passages_and_chains(spark, monkeypatch):
    """A large group of near copies, some out of reach of most; a passage in a third of all texts;
    copies; chains in which each text is like the next alone; short texts."""
    chosen = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: [chosen.choice(vocabulary) for _ in range(n)]
    seed, passage, rows = text(80), text(20), []
    for _ in range(250):
        own = list(seed)
        for _ in range(chosen.randint(0, 5)):
            own[chosen.randrange(len(own))] = chosen.choice(vocabulary)
        rows.append(own)
    for _ in range(150):
        rows.append(text(chosen.randint(1, 60)) + passage + text(chosen.randint(0, 60)))
    chain = text(100)
    for k in range(30):
        rows.append(chain[k * 5:] + text(k * 5))
        chain = rows[-1] if chosen.random() < 0.5 else chain
    rows += [list(chosen.choice(rows)) for _ in range(60)]
    rows += [text(chosen.randint(0, 6)) for _ in range(40)] + [["a", "B"], ["A", "b"], ["a"], []]
    rows = [(i * 3, " ".join(w)) for i, w in enumerate(rows)]
    chosen.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    wanted = brute(rows)
    assert joined(df) == wanted
    # The same with shingles known as frequent, and in one fragment after another.
    monkeypatch.setattr(ngram_join, "FREQUENT_LEAST", 20)
    monkeypatch.setattr(ngram_join, "FRAGMENT_TOKENS", 500)
    assert joined(df) == wanted


def test_edges(spark, edge_docs, no_docs):
    rows = ngram_join.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    of = collections.defaultdict(set)
    for r in rows:
        of[r.doc_id].add((r.n_shingles, r.component_id))
    assert of[1] == {(6, 1)} and of[8] == {(6, 1)}  # copies, and a tie under another id
    assert of[2] == {(0, 2)} and of[3] == {(0, 3)} and of[4] == {(0, 4)}
    assert of[6] == {(1, 6)} and {c for _, c in of[None]} == {None}
    assert ngram_join.near_duplicates(no_docs).collect() == []


def test_one_of_each_group_stays(spark, edge_docs, no_docs):
    kept = ngram_join.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == [
        "1", "2", "3", "4", "5", "6", "7", "None", "None"]
    assert ngram_join.drop_near_duplicates(no_docs).collect() == []
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    wanted = {i for i, _, c in brute([(r.doc_id, r.text) for r in docs.collect()]) if i == c}
    assert sorted(ngram_join.drop_near_duplicates(docs).collect()) == sorted(
        r for r in docs.collect() if r.doc_id in wanted)


def test_components_of_paths_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 50)] + [
        (200, 201), (201, 202), (202, 200), (300, 300)]
    chosen = random.Random(1)
    links = [p if chosen.random() < 0.5 else p[::-1] for p in links]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(1, 50)} == {1}
    assert {got[i] for i in (200, 201, 202)} == {200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
