import hashlib
import zlib

import numpy as np
import pytest
from oracle import connect, difference
from pyspark.sql import functions as F

from hiretide.llm import merkle, queries

COLUMNS = queries.LEAF_COLUMNS


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def way(tree, i):
    """(earlier siblings, later siblings) per level."""
    out = []
    for nodes in tree[:-1]:
        first = i - i % 3
        out.append((nodes[first:i], nodes[i + 1:first + 3]))
        i //= 3
    return out


def brute(rows):
    """The contract's rows of (doc_id, source, lang, n_chars, text) rows."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([leaf(r) for r in sorted(
        by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    root = top[-1][0]
    out = []
    for j, s in enumerate(order):
        ordered = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        for i, r in enumerate(ordered):
            path = way(trees[s], i) + way(top, j)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            folded = leaf((*r[:4], r[4].replace("\n", ""))) if changed else leaf(r)
            for before, after in path:
                folded = sha("".join(before) + folded + "".join(after))
            out.append((r[0], leaf(r), trees[s][-1][0], root,
                        sha("".join(d for a, b in path for d in a + b)), folded, folded == root))
    return sorted(out, key=str)


def found(df):
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    claimed = F.when(changed, merkle.leaf_hash([text if c == "text" else F.col(c) for c in COLUMNS]))
    names = ("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted(map(tuple, merkle.manifest(df, COLUMNS, claimed=claimed).verified().select(*names).collect()),
                  key=str)


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert difference(queries.op12_merkle_manifest(spark, sf), connect(sf),
                      queries.ORACLE_SQL["op12_merkle_manifest"]) is None


def test_edge_rows(spark, edge_docs):
    assert found(edge_docs) == brute([tuple(r) for r in edge_docs.select(*COLUMNS).collect()])


def test_several_passes_of_blocks(spark):
    """A source of several blocks: their roots make a block of the next pass."""
    rows = [(i, "big" if i % 10 else f"s{i % 70}", "en", i, f"a\n{i}") for i in range(2400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(df) == brute(rows)


@pytest.mark.parametrize("n,height", [(1, 0), (2, 1), (3, 1), (4, 2), (729, 6), (730, 6), (10**9, 6)])
def test_heights(n, height):
    assert merkle.block_height(n) == height


@pytest.mark.parametrize("sizes", [[1], [1, 1], [3, 1, 4], [729, 730, 1, 2]])
def test_sizes_about_the_runs(spark, sizes):
    rows = [(i, f"s{k}", None, None, "x\ny") for k, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(df) == brute(rows)


def test_empty_table(spark, no_docs):
    empty = merkle.manifest(no_docs, COLUMNS)
    assert empty.root is None and empty.verified().collect() == [] and empty.proofs().collect() == []


def test_any_change_is_seen(spark, docs):
    other = docs.withColumn("lang", F.when(F.col("doc_id") == 7, F.lit("xx")).otherwise(F.col("lang")))
    root = merkle.manifest(docs, COLUMNS).root
    assert merkle.manifest(docs.repartition(5), COLUMNS).root == root
    assert merkle.manifest(other, COLUMNS).root != root
    assert merkle.manifest(docs.filter("doc_id <> 7"), COLUMNS).root != root


def test_proofs_lead_to_the_root(spark, docs):
    manifest = merkle.manifest(docs, COLUMNS)
    for r in manifest.proofs().collect():
        assert merkle.fold(bytes(r.leaf), bytes(r.path)) == manifest.root == bytes(r.root)
        assert merkle.fold(bytes(r.leaf)[::-1], bytes(r.path)) != manifest.root


@pytest.mark.parametrize("levels_", range(1, 9))
def test_addresses_are_a_permutation_and_recursive(levels_):
    every = np.concatenate([merkle.address(levels_, d, np.arange(3 ** d)) for d in range(levels_)])
    assert sorted(every.tolist()) == list(range(merkle.tree_size(levels_)))
    assert merkle.address(levels_, 0, np.zeros(1, int))[0] == 0
    if levels_ > 2:  # a lower subtree stands together, in the order of a tree of its own height
        top = levels_ // 2
        low = levels_ - top
        own = np.concatenate([merkle.address(levels_, top + d, np.arange(3 ** d) + 3 ** d) for d in range(low)])
        alone = np.concatenate([merkle.address(low, d, np.arange(3 ** d)) for d in range(low)])
        assert (own - own.min() == alone).all()


def test_a_block_gathers_no_more_than_its_rows(spark, docs):
    found_ = merkle.manifest(docs, COLUMNS).sources.passes[0]
    assert found_.agg(F.max("held")).first()[0] <= merkle.BLOCK
