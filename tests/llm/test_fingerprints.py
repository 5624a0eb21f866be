import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hiretide.llm import fingerprints as fp


def changed(text, edits, chosen):
    out = list(text)
    for _ in range(edits):
        at = chosen.randrange(len(out))
        out[at] = chosen.choice(["", "q", out[at] + "z"])
    return "".join(out)


def test_equal_texts_have_equal_fingerprints_and_near_ones_are_near(docs):
    chosen = random.Random(7)
    texts = [r.text for r in docs.collect() if len(r.text) > 500]
    own = fp.fingerprint_texts(texts)
    assert np.array_equal(own, np.concatenate([fp.fingerprint_texts([t]) for t in texts]))
    near = [(own == fp.fingerprint_texts([changed(t, max(1, len(t) // rate), chosen)
                                          for t in texts])).mean() for rate in (500, 100, 30)]
    assert near[0] > 0.8 and near[0] > near[1] > near[2] > 0.15
    assert np.median((own[1:] == own[:-1]).mean(axis=1)) < 0.05


def test_walk_is_the_stepwise_walk():
    rng = np.random.default_rng(2)
    texts = ["".join(chr(97 + c) for c in rng.integers(0, 26, n)) for n in (1, 5, 40, fp.MOST)]
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    size = np.array([len(t) for t in texts])
    got = fp.walk(codes, np.cumsum(size) - size, size)
    for k, text in enumerate(texts):
        seen, place = [0] * fp.BANDS, 0
        for j in range(3 * len(text)):
            here = ord(text[place]) if place < len(text) else None
            for band in fp._SAMPLES[j]:
                x = (seen[band] * int(fp._MUL) + (here + 1 if here else 0)) % 2**64
                seen[band] = x ^ (x >> 29)
            place += int(fp._MOVE[j][here % 256]) if here is not None else int(fp._MOVE[j][0])
        wanted = fp.mix(np.array(seen, np.uint64) ^ fp._SALT)
        assert got[:, k].tolist() == wanted.tolist()


def check_pairs(rows, docs):
    order = sorted(docs, key=lambda r: -r.doc_id)
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs)
    for i, r in enumerate(order):
        following = order[(i + 1) % len(order)].text or ""
        text = r.text or ""
        cut = len(text) // 3
        new = text[:len(text) - cut] + following[:cut]
        a, b, c = fp.fingerprint_texts([text, new, following])
        got = by_id[r.doc_id]
        assert got.n_chars == len(text)
        assert got.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert got.fingerprint == fp.as_text([a])[0] and got.edited_fingerprint == fp.as_text([b])[0]
        assert got.near_edited == (a == b).mean() and got.near_next == (a == c).mean()


@pytest.mark.parametrize("partitions", ["1", "4", "60"])
def test_each_row_meets_the_next(spark, docs, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = fp.edit_likeness(docs.repartition(3)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    check_pairs(rows, docs.collect())
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.95


def test_few_rows_and_edges(spark, edge_docs, no_docs):
    for rows in ([(5, "only one text here, nothing follows it")], [(-3, "a" * 50), (2**62, "b" * 50)]):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        check_pairs(fp.edit_likeness(df).collect(), df.collect())
    rows = fp.edit_likeness(edge_docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in edge_docs.collect())
    assert {r.fingerprint for r in rows if r.n_chars == 0} == {"0" * 256}
    assert fp.edit_likeness(no_docs).collect() == [] and fp.fingerprints(no_docs).collect() == []


def printed(spark, rows):
    """(id, fingerprint in bytes) of (id, text) rows."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return fp.fingerprints(df).withColumn("fingerprint", F.unhex("fingerprint"))


def linked(prints):
    return {(r.a, r.b): r.near for r in fp.links(prints).collect()}


def given(spark, rows):
    return spark.createDataFrame([(i, np.array(x, ">u2").tobytes()) for i, x in rows],
                                 "doc_id long, fingerprint binary")


def test_candidates_are_verified(spark):
    chosen = random.Random(9)
    base = ["".join(chosen.choice("abcdefgh ") for _ in range(1500)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(base)] + [
        (100 + i, changed(t, 3, chosen)) for i, t in enumerate(base)] + [(200, base[0])]
    prints = printed(spark, rows)
    found, own = linked(prints), {r.doc_id: r.fingerprint for r in prints.collect()}
    assert all((i, 100 + i) in found or own[i] == own[100 + i] for i in range(20)) and len(found) > 15
    assert all(a % 100 == b % 100 and near >= fp.SIMILAR for (a, b), near in found.items())


@pytest.mark.parametrize("rate, recall", [(0.005, 0.97), (0.01, 0.9)])
def test_recall_against_texts_with_edits(spark, docs, rate, recall):
    """Pairs of a text and its copy with random edits; README has the figure for 2 %, which is low."""
    chosen = random.Random(11)
    texts = [r.text for r in docs.collect() if r.text and 1000 < len(r.text) < 8000]
    texts = [t for i, t in enumerate(texts) if t not in texts[:i]][:60]
    rows = [(i, t) for i, t in enumerate(texts)] + [
        (1000 + i, changed(t, max(1, int(len(t) * rate)), chosen)) for i, t in enumerate(texts)]
    classes = {r.doc_id: r.class_id for r in fp.with_neighbours(printed(spark, rows)).collect()}
    assert np.mean([classes[i] == classes[1000 + i] for i in range(len(texts))]) >= recall


def test_every_link_of_likeness_three_quarters_is_found(spark):
    """Against all pairs, by likeness: families of random fingerprints with a growing share of changed bands."""
    rng, rows = np.random.default_rng(3), []
    for family in range(30):
        own = rng.integers(1, 1 << 16, fp.BANDS)
        for copy in range(4):
            new = own.copy()
            at = rng.permutation(fp.BANDS)[:3 * copy + family % 3]
            new[at] = rng.integers(1, 1 << 16, len(at))
            rows.append((4 * family + copy, new))
    classes = {r.doc_id: r.class_id for r in fp.with_neighbours(given(spark, rows)).collect()}
    for i, x in rows:
        for j, y in rows:
            if i < j and (x == y).mean() >= 0.75:
                assert classes[i] == classes[j]


def test_rows_unlike_the_hub_of_their_key_meet_each_other(spark):
    chosen = random.Random(4)
    draw = lambda n: [chosen.randrange(1, 1 << 16) for _ in range(n)]
    shared, rows = draw(fp.BANDS_PER_KEY), []  # one hot key: all rows agree in it
    for family in range(40):
        own = draw(fp.BANDS)
        for copy in range(3):
            new = [chosen.randrange(1, 1 << 16) if i % 4 == (i // 4 + copy) % 4 and copy else x
                   for i, x in enumerate(own)]
            for band, x in zip(fp.KEYS[0], shared):
                new[band] = x
            rows.append((3 * family + copy, new))
    found = fp.with_neighbours(given(spark, rows)).collect()
    assert all(r.class_id == r.doc_id // 3 * 3 for r in found)
    assert all(r.link_id // 3 == r.doc_id // 3 and r.link_near >= fp.SIMILAR for r in found)


def test_a_group_of_near_copies_makes_about_a_link_a_row_and_key(spark):
    """Links, and pairs that are verified, grow with the rows of a group and not with their square."""
    made = []
    for n in (100, 200, 400):
        rng = np.random.default_rng(n)
        own = rng.integers(1, 1 << 16, fp.BANDS)
        rows = []
        for i in range(n):
            new = own.copy()
            new[rng.integers(0, fp.BANDS, 2)] = rng.integers(1, 1 << 16, 2)
            rows.append((i, new))
        prints = given(spark, rows)
        made.append(len(linked(prints)))
        assert {r.class_id for r in fp.with_neighbours(prints).collect()} == {0}
    assert made[2] < 2.6 * made[1] < 2.6 * 2.6 * made[0] and made[2] <= 400 * len(fp.KEYS)


def test_a_wide_group_has_the_classes_of_all_its_pairs_without_meeting_them(spark, monkeypatch):
    """Near copies of one text, and twice as many rows that share keys with them and with each other, and are
    not alike enough, but for chains of rows that lead from some of them into the group."""
    rng, rows, n = np.random.default_rng(8), [], 150
    base = rng.integers(1, 1 << 16, fp.BANDS)

    def drawn(of, bands):
        new = of.copy()
        at = rng.permutation(fp.BANDS)[:bands]
        new[at] = rng.integers(1, 1 << 16, len(at))
        return new

    rows = [drawn(base, rng.integers(6, 14)) for _ in range(n)]
    rows += [drawn(base, rng.integers(26, 38)) for _ in range(2 * n)]
    rows += [drawn(x, 22) for x in rows[:n // 3]]
    rows = np.unique(np.array(rows, np.uint16), axis=0)
    of = list(range(len(rows)))
    shared = 0
    for i in range(1, len(rows)):
        equal = rows[:i] == rows[i]
        of_key = equal[:, fp.KEYS].all(axis=2).any(axis=1)
        shared += of_key.sum()
        for j in np.flatnonzero(of_key & (equal.mean(axis=1) >= fp.SIMILAR)).tolist():
            low, high = sorted((of[i], of[j]))
            if low < high:
                of = [low if c == high else c for c in of]
    made, verified = [], fp._verified

    def counted(pairs, one, least):
        made.append(pairs.count())
        return verified(pairs, one, least)

    monkeypatch.setattr(fp, "_verified", counted)
    found = fp.with_neighbours(given(spark, list(enumerate(rows)))).collect()
    assert {r.doc_id: r.class_id for r in found} == dict(enumerate(of))
    assert 1 < len(set(of)) and shared > 3 * sum(made)


def test_repeated_segments_count(docs):
    """A text and its tenfold repeat are unlike; so are they by edit distance."""
    texts = [r.text for r in docs.collect() if r.text and len(r.text) > 1000][:40]
    near = (fp.fingerprint_texts(texts) == fp.fingerprint_texts([t * 10 for t in texts])).mean(axis=1)
    assert np.median(near) < 0.3


def test_links_of_odd_rows(spark, edge_docs, no_docs):
    """Null ids have no link, equal texts and repeated ids one class, unlike rows their own."""
    prints = fp.fingerprints(edge_docs).withColumn("fingerprint", F.unhex("fingerprint"))
    found = fp.with_neighbours(prints).collect()
    assert len(found) == edge_docs.count()
    for r in found:
        if r.doc_id is None:
            assert r.same_id is None and r.class_id is None and r.link_id is None
        else:
            equal = [x.doc_id for x in found if x.fingerprint == r.fingerprint and x.doc_id is not None]
            assert r.same_id == min(equal) and r.class_id <= r.same_id
    assert {r.class_id for r in found if r.doc_id in (1, 8)} == {1}
    assert {r.class_id for r in found if r.doc_id in (2, 3)} == {2}
    empty = fp.with_neighbours(fp.fingerprints(no_docs).withColumn("fingerprint", F.unhex("fingerprint")))
    assert empty.collect() == [] and linked(prints.limit(0)) == {}


def test_the_query_gives_verified_neighbours(spark):
    from hiretide.llm import queries

    rows = queries.op6_document_fingerprints(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200
    prints = {r.doc_id: np.frombuffer(bytes.fromhex(r.fingerprint), ">u2") for r in rows}
    classes = {r.doc_id: r.class_id for r in rows}
    for r in rows:
        own = prints[r.doc_id]
        assert r.same_id == min(i for i, p in prints.items() if np.array_equal(p, own))
        assert classes[r.class_id] == r.class_id <= r.same_id
        near = {i: (own == p).mean() for i, p in prints.items() if not np.array_equal(p, own)}
        # Whatever shares a key and is alike is of one class; a link is to a row that is alike.
        for i, likeness in near.items():
            if likeness >= fp.SIMILAR and any((own[k] == prints[i][k]).all() for k in fp.KEYS):
                assert classes[i] == r.class_id and r.link_id is not None
        assert r.link_id is None or (r.link_near == near[r.link_id] >= fp.SIMILAR)
