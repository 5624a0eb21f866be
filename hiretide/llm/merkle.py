"""A Merkle manifest of a dataset: a tree of digests per source, and one over the sources.

A row's leaf is the SHA-256 of its columns, each framed by its length. Rows of a source stand by id; while
several nodes remain, every ``FAN`` consecutive ones (the last run: fewer, even one) become the digest of
their hexadecimal texts. What remains is the source's subroot; subroots by source (null first, by bytes) give
the root in the same way.

Trees are built in aligned blocks, subtrees of ``HEIGHT`` levels: a block is one row, its nodes one array in van
Emde Boas order (``address``: a subtree is split at half its height, the upper half stored first, each lower
subtree behind it, again and again), so that a walk from leaf to block root touches few stretches of
memory whatever their size. Block roots are the leaves of the next pass of blocks; each pass has a 729th of
the rows of the one before, and no task ever holds more of a tree than a block. Proofs come back down the same
blocks: a block hands each of its leaves the siblings on its way up, with those of the blocks above.

Places within a source come from one range partitioned sort: a row's place in its partition and the
counts per partition and source, so a source that holds most rows is spread over many tasks. Text is hashed
where it is read and goes nowhere else.

Null columns are framed as ``-``, empty texts as ``0:``. Null ids stand first in their source; repeated ids stand
by their leaf digests, equal rows are equal leaves of their own. Columns of other names do not matter. An
empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiretide.llm.common import arrow_map, stored

FAN, HEIGHT = 3, 6
BLOCK = FAN ** HEIGHT
_PLACE = (1 << 33) - 1  # of a row in its partition, in what monotonically_increasing_id gives


def tree_size(levels: int) -> int:
    return (FAN ** levels - 1) // (FAN - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Place, in van Emde Boas order, of nodes ``index`` of a depth of a full tree of ``levels`` levels."""
    at = np.zeros_like(index)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        width = FAN ** (depth - top)
        at = at + tree_size(top) + index // width * tree_size(levels - top)
        index, depth, levels = index % width, depth - top, levels - top
    return at


def height_of(n: int) -> int:
    """Levels of digests over ``n`` leaves."""
    height = 0
    while FAN ** height < n:
        height += 1
    return height


def block_height(n: int) -> int:
    """Levels of a block of a tree over ``n`` leaves."""
    return HEIGHT if n > BLOCK else height_of(n)


def node_hash(digests: Iterable[bytes]) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def build_block(leaves: Sequence[bytes], height: int) -> bytes:
    """The nodes over ``leaves``, ``height`` levels, in van Emde Boas order; places of no node are zeros."""
    nodes = np.zeros((tree_size(height + 1), 32), np.uint8)
    now = list(leaves)
    for level in range(height + 1):
        if level:
            now = [node_hash(now[i:i + FAN]) for i in range(0, len(now), FAN)]
        nodes[address(height + 1, height - level, np.arange(len(now)))] = np.frombuffer(
            b"".join(now), np.uint8).reshape(-1, 32)
    return nodes.tobytes()


def block_paths(nodes: bytes, n: int, height: int) -> list[bytes]:
    """For each of ``n`` leaves its way to the block root: per level a byte, the place in the run of siblings
    and the length of the run (16 * place + length), and then the siblings."""
    paths = [b""] * n
    count = n
    for level in range(height):
        row = address(height + 1, height - level, np.arange(count)).tolist()
        digest = [nodes[32 * a:32 * a + 32] for a in row]
        steps = []
        for i in range(count):
            first = i - i % FAN
            run = digest[first:min(first + FAN, count)]
            steps.append(bytes([16 * (i - first) + len(run)])
                         + b"".join(run[:i - first] + run[i - first + 1:]))
        width = FAN ** level
        paths = [p + steps[i // width] for i, p in enumerate(paths)]
        count = -(-count // FAN)
    return paths


def siblings(path: bytes) -> list[tuple[int, list[bytes]]]:
    """Per level of a path: the node's place in its run, and the others of the run."""
    out, at = [], 0
    while at < len(path):
        place, others = path[at] >> 4, (path[at] & 15) - 1
        out.append((place, [path[at + 1 + 32 * i:at + 33 + 32 * i] for i in range(others)]))
        at += 1 + 32 * others
    return out


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path lead to."""
    for place, others in siblings(path):
        leaf = node_hash(others[:place] + [leaf] + others[place:])
    return leaf


def proof_hash(path: bytes) -> str:
    return node_hash(d for _, others in siblings(path) for d in others).hex()


def framed(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: Sequence[Column]) -> Column:
    """Digest of the columns as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(framed, columns)), 256))


def placed(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``rows`` (``tree`` and others) with ``at``, the place in their tree, and ``n``, its rows."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.asc("tree"), *order]
    sorted_rows = rows.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    kept = stored(sorted_rows.withColumn("at", F.monotonically_increasing_id()), "placed").withColumns({
        "part": F.shiftright("at", 33), "at": F.col("at").bitwiseAND(F.lit(_PLACE))})
    # A row for each tree and each bound between tasks.
    runs = kept.groupBy("part", "tree").agg(F.min("at").alias("first"), F.count("*").alias("held"))
    own = Window.partitionBy("tree")
    earlier = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("part", "tree", F.sum("held").over(own).alias("n"), (
        F.coalesce(F.sum("held").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    found = kept.join(runs, ["part", "tree"])
    return found.withColumn("at", F.col("at") + F.col("shift")).drop("part", "shift")


def blocks_of(nodes: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """One row per block of ``nodes`` (tree, at, n, digest): ``tree``, ``block``, ``n``, the number ``held`` of
    leaves, their ``nodes`` in van Emde Boas order, the block's ``root``, and for each of ``carried`` the
    list of the leaves' values. A block gathers at most ``BLOCK`` rows."""
    rows = nodes.groupBy("tree", F.floor(F.col("at") / BLOCK).cast("long").alias("block")).agg(
        F.min("n").alias("n"),
        F.sort_array(F.collect_list(F.struct("at", "digest", *carried))).alias("leaves"))
    leaves = rows.select("tree", "block", "n", F.col("leaves.digest").alias("leaves"),
                         *(F.col(f"leaves.{c}").alias(c) for c in carried))

    def run(batch: pa.RecordBatch):
        built, roots, held = [], [], []
        for n, own in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            built.append(build_block(own, block_height(n)))
            roots.append(built[-1][:32])  # a root is the first of its block
            held.append(len(own))
        yield [*(batch.column(i) for i in range(3)), pa.array(held), pa.array(built, pa.binary()),
               pa.array(roots, pa.binary()), *(batch.column(4 + i) for i in range(len(carried)))]

    return arrow_map(leaves, run, [
        ("tree", T.StringType()), ("block", T.LongType()), ("n", T.LongType()), ("held", T.LongType()),
        ("nodes", T.BinaryType()), ("root", T.BinaryType()),
        *((c, leaves.schema[c].dataType) for c in carried)])


@dataclass
class Forest:
    """The stored blocks of some trees, pass by pass from the leaves up."""

    passes: list[DataFrame]

    def roots(self) -> DataFrame:
        """``tree`` and ``root`` of each."""
        last = [b.filter(F.col("n") <= BLOCK).select("tree", "root") for b in self.passes]
        out = last[0]
        for more in last[1:]:
            out = out.unionByName(more)
        return out

    def with_paths(self, above: DataFrame) -> DataFrame:
        """The blocks of leaves with ``path``, the way from their root on, and what else ``above`` (a row per
        ``tree``: ``path`` from its root on, and others) says of the tree."""
        others = [c for c in above.columns if c not in ("tree", "path")]
        ways = None
        for k in reversed(range(len(self.passes))):
            blocks = self.passes[k]
            top = above.join(blocks.filter(F.col("n") <= BLOCK).select("tree", "block"), "tree")
            ways = top if ways is None else top.unionByName(ways.select(*top.columns))
            found = blocks.join(ways, ["tree", "block"])
            if k:
                ways = stored(_leaf_ways(found, others), "ways")
        return found


def grown(nodes: DataFrame, carried: Sequence[str] = ()) -> Forest:
    """The forest over ``nodes`` (tree, at, n, digest, and ``carried``, which stay with the leaves)."""
    passes = [stored(blocks_of(nodes, carried), "blocks")]
    while not (more := passes[-1].filter(F.col("n") > BLOCK)).isEmpty():
        passes.append(stored(blocks_of(more.select(
            "tree", F.col("block").alias("at"), F.ceil(F.col("n") / BLOCK).cast("long").alias("n"),
            F.col("root").alias("digest"))), "blocks"))
    return Forest(passes)


def _leaf_ways(found: DataFrame, others: Sequence[str], each: Sequence[str] = ()) -> DataFrame:
    """Per leaf of blocks with ``path``: tree, the leaf's place as ``block``, its ``path`` to the root,
    ``others`` of its block, and its own elements of the lists ``each``."""
    def run(batch: pa.RecordBatch):
        table = dict(zip(batch.schema.names, batch.columns))
        paths, of, places = [], [], []
        for i, (block, n, held, nodes, way) in enumerate(zip(*(
                table[c].to_pylist() for c in ("block", "n", "held", "nodes", "path")))):
            paths += [p + way for p in block_paths(nodes, held, block_height(n))]
            of += [i] * held
            places += range(block * BLOCK, block * BLOCK + held)
        of = pa.array(of, pa.int64())
        yield [table["tree"].take(of), pa.array(places, pa.int64()), pa.array(paths, pa.binary()),
               *(table[c].take(of) for c in others), *(table[c].flatten() for c in each)]

    return arrow_map(found.select("tree", "block", "n", "held", "nodes", "path", *others, *each), run, [
        ("tree", T.StringType()), ("block", T.LongType()), ("path", T.BinaryType()),
        *((c, found.schema[c].dataType) for c in others),
        *((c, found.schema[c].dataType.elementType) for c in each)])


@dataclass
class Manifest:
    """The trees of the sources, the one over them, and the ``root`` of all (None: no rows)."""

    sources: Forest
    over: Forest
    root: bytes | None

    def proofs(self) -> DataFrame:
        """Per row: ``id``, ``leaf``, ``claimed``, ``path``, ``subroot`` and ``root``, digests as bytes."""
        return self._leaves(lambda leaf, claimed, path: (path,), [("path", T.BinaryType())])

    def verified(self) -> DataFrame:
        """Per row: ``id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` over the siblings on its way to
        the root, the ``folded_root`` that the claimed leaf leads to, and whether that is the root."""
        root = self.root

        def check(leaf, claimed, path):
            folded = fold(leaf if claimed is None else claimed, path)
            return proof_hash(path), folded.hex(), folded == root

        return self._leaves(check, [("proof_sha256", T.StringType()), ("folded_root", T.StringType()),
                                    ("verified", T.BooleanType())]).drop("claimed").withColumns(
            {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "root")})

    def _leaves(self, of_leaf, fields) -> DataFrame:
        spark = self.sources.passes[0].sparkSession
        top = spark.createDataFrame([("", b"")], "tree string, path binary")
        ways = _leaf_ways(self.over.with_paths(top), [], ["ids"])  # a row per source
        above = stored(ways.select(F.col("ids").alias("tree"), "path"), "ways").join(
            self.sources.roots().withColumnRenamed("root", "subroot"), "tree")
        blocks = self.sources.with_paths(above)
        kind = blocks.schema["ids"].dataType.elementType
        root = self.root

        def run(batch: pa.RecordBatch):
            table = dict(zip(batch.schema.names, batch.columns))
            for i, (n, held, nodes, way, claimed) in enumerate(zip(*(
                    table[c].to_pylist() for c in ("n", "held", "nodes", "path", "claimed")))):
                height = block_height(n)
                row = address(height + 1, height, np.arange(held)).tolist()
                leaves = [nodes[32 * a:32 * a + 32] for a in row]
                paths = [p + way for p in block_paths(nodes, held, height)]
                out = list(zip(*(of_leaf(a, c, p) for a, c, p in zip(leaves, claimed, paths))))
                yield [table["ids"].slice(i, 1).flatten(), leaves, claimed,
                       [table["subroot"][i].as_py()] * held, [root] * held, *map(list, out)]

        return arrow_map(blocks.select("n", "held", "nodes", "path", "claimed", "subroot", "ids"), run, [
            ("id", kind), ("leaf", T.BinaryType()), ("claimed", T.BinaryType()),
            ("subroot", T.BinaryType()), ("root", T.BinaryType()), *fields])


def manifest(df: DataFrame, columns: Sequence[str], id_col: str = "doc_id", source_col: str = "source",
             claimed: Column | None = None) -> Manifest:
    """The manifest of ``df`` over ``columns``. ``claimed``: the leaf digest (bytes) that a row is later
    said to have, null where it is the row's own."""
    # A key without null that sorts as the sources do: null first, then by bytes.
    tree = F.coalesce(F.concat(F.lit("1"), F.col(source_col).cast("string")), F.lit("0"))
    rows = df.select(tree.alias("tree"), F.col(id_col).alias("ids"),
                     leaf_hash([F.col(c) for c in columns]).alias("digest"),
                     (F.lit(None).cast("binary") if claimed is None else claimed).alias("claimed"))
    leaves = placed(rows, [F.asc_nulls_first("ids"), F.asc("digest")])
    sources = grown(leaves, ["ids", "claimed"])
    subroots = sources.roots().select(F.lit("").alias("tree"), F.col("tree").alias("ids"),
                                      F.col("root").alias("digest"))
    over = grown(placed(subroots, [F.asc("ids")]), ["ids"])
    top = over.roots().first()
    return Manifest(sources, over, bytes(top["root"]) if top else None)

