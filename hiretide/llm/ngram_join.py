"""Near duplicates by n-gram Jaccard similarity, joined in vertical fragments.

The n-grams (5-word shingles as 64-bit hashes) have one global order; documents with equal sets stand
as one set. The order is cut into fragments twice:

1. *Frequencies.* Each task sends its shingles, by ranges of the hash, to fragments. A fragment counts
   in how many sets each of its shingles occurs and gives back those that any two sets share. Per set,
   its fragments' shared shingles add up to the most that it can have in common with another one;
   sets with less than the similarity asks for are out, and these are nearly all.
2. *Overlaps.* The rest order their shingles from rare to frequent. A pair that is similar enough
   shares one among the first few of both (prefix filter), placed so that enough can follow (position
   filter). Of the sets that share one, each is first paired with the one of the greatest share of
   shared shingles; then sets that are still in different components are paired. For each pair the
   overlaps are counted fragment by fragment and summed, and the exact sum decides.

Sets of one component need no more links, so a group of a million near copies costs about as many
pairs as it has rows, and no link between sets of different components is left out: each pair that
the filters allow is counted, unless links found already join it. Shingles that a thousandth of all
documents hold (at most a thousand times the mean set size, so few enough to broadcast) bypass the
counting, which keeps fragments small; no key gathers all rows of a common passage.

A document's set: distinct 5-word shingles of its words, A-Z lowered; with fewer words the whole
sequence as one; without words, or with null text, empty and linked with nothing. Rows that repeat are
copies; rows with equal ids and different texts are judged by their texts. An id may be null: such
rows link, but give no component their name. Texts of any length are hashed whole. Sets are known by
64-bit hashes: two texts are taken for equal when these are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiretide.llm.common import arrow_map, by_bytes, code_path, stored, type_of
from hiretide.llm.components import components
from hiretide.llm.words import mix, shingle_sets, split_words, word_hashes

SHINGLE, PERCENT = 5, 75
BATCH_BYTES = 4 << 20  # of text hashed at a time
FRAGMENT_TOKENS = 2 << 20  # shingles of a fragment when frequencies are counted
FREQUENT_SHARE, FREQUENT_LEAST, FREQUENT_IN_BATCH = 1000, 256, 4
OVERLAP_FRAGMENTS = 8
FREQUENT_RANK = 1 << 40  # places known frequent shingles after all counted ones


def _sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles by text, their bounds, and the hash that stands for each set (0: empty)."""
    w = split_words(column)
    shingles, bounds = shingle_sets(word_hashes(w, lower=True), w.first, n)
    total = np.zeros(len(shingles) + 1, np.uint64)
    np.cumsum(mix(shingles), out=total[1:])
    name = total[bounds[1:]] - total[bounds[:-1]]
    size = np.diff(bounds).astype(np.uint64)
    name = np.where(size > 0, np.maximum(mix(name + size), np.uint64(1)), np.uint64(0))
    return shingles, bounds, name


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == np.uint64 else x


def set_sizes(df: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """Two kinds of rows: (0, id, size of the set, its hash) of each document, and (1, null, count,
    shingle) of shingles that several documents of a batch hold."""
    def run(batch: pa.RecordBatch):
        for part in by_bytes(batch, batch.schema.names[1], BATCH_BYTES):
            shingles, bounds, name = _sets(part.column(1), n)
            yield [pa.array(np.zeros(part.num_rows, np.int32)), part.column(0),
                   pa.array(np.diff(bounds)), pa.array(_signed(name))]
            _, first = np.unique(name, return_index=True)  # copies within a batch count once
            once = np.isin(np.repeat(np.arange(len(name)), np.diff(bounds)), first)
            value, count = np.unique(shingles[once], return_counts=True)
            value, count = value[count >= FREQUENT_IN_BATCH], count[count >= FREQUENT_IN_BATCH]
            if len(value):
                yield [pa.array(np.ones(len(value), np.int32)),
                       pa.nulls(len(value), part.column(0).type), pa.array(count),
                       pa.array(_signed(value))]

    return arrow_map(df.select(id_col, text_col), run, [
        ("kind", T.IntegerType()), ("id", type_of(df, id_col)), ("size", T.LongType()),
        ("hash", T.LongType())])


def frequent_shingles(sizes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of at least a thousandth of the documents, and their counts: no more than a thousand
    times the mean set size, whatever the corpus, so the driver and a broadcast hold them."""
    documents = sizes.filter("kind = 0").count()
    least = max(FREQUENT_LEAST, documents // FREQUENT_SHARE)
    rows = sizes.filter("kind = 1").groupBy("hash").agg(F.sum("size").alias("n")).filter(
        F.col("n") >= least).toPandas()
    value = rows["hash"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(value)
    return value[order], rows["n"].to_numpy(np.int64)[order]


def _packed(x: np.ndarray) -> bytes:
    """Numbers by byte planes, each first one subtracted from the next, which compresses well."""
    if not len(x):
        return b""
    steps = np.diff(x, prepend=x.dtype.type(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _unpacked(data: bytes, dtype: type) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(dtype).ravel(), dtype=dtype)


_PIECE = T.StructType([*(T.StructField(c, T.LongType()) for c in ("fragment", "name", "n")),
                       *(T.StructField(c, T.BinaryType()) for c in ("sets", "counts", "tokens",
                                                                    "ranks"))])
_SHARED = T.StructType([T.StructField("bucket", T.LongType()),
                        *(T.StructField(c, T.BinaryType()) for c in ("sets", "sizes", "counts",
                                                                     "tokens", "ranks"))])
_SET = T.StructType([T.StructField("name", T.LongType()), T.StructField("n", T.LongType()),
                     T.StructField("prefix", T.IntegerType()),
                     T.StructField("tokens", T.ArrayType(T.LongType()))])


def pieces(df: DataFrame, text_col: str, n: int, fragments: int, frequent) -> DataFrame:
    """Per batch and fragment: the sets with shingles there, how many each, and these in order.
    The size of each set and its frequent shingles go by themselves, in fragments below 0."""
    common, common_count = frequent
    top = np.uint64((1 << 64) // fragments + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, text_col, BATCH_BYTES):
                out = list(rows(part))
                if out:
                    columns = list(zip(*out))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, (
                            *[pa.int64()] * 3, *[pa.binary()] * 4))], names=_PIECE.names)

    def rows(part: pa.RecordBatch):
        shingles, bounds, name = _sets(part.column(0), n)
        _, first = np.unique(name, return_index=True)  # copies within a batch count once
        keep = np.zeros(len(name), bool)
        keep[first] = name[first] != 0
        size = np.diff(bounds)
        of = np.repeat(np.arange(len(name)), size)
        live = keep[of]
        shingles, of = shingles[live], of[live]
        at = np.minimum(np.searchsorted(common, shingles), max(0, len(common) - 1))
        known = common[at] == shingles if len(common) else np.zeros(len(shingles), bool)
        token, rank = shingles[known], common_count[at[known]] + FREQUENT_RANK
        cut = np.searchsorted(of[known], np.arange(len(name) + 1)).tolist()
        names = _signed(name).tolist()
        for i in np.flatnonzero(keep).tolist():
            a, b = cut[i], cut[i + 1]
            yield (-1 - names[i] % fragments, names[i], int(size[i]), None, None,
                   token[a:b].tobytes(), rank[a:b].tobytes())
        shingles, of = shingles[~known], of[~known]
        fragment = (shingles // top).astype(np.int64)
        order = np.argsort(fragment, kind="stable")  # within one, by set and then by shingle
        shingles, of, fragment = shingles[order], of[order], fragment[order]
        cut = np.flatnonzero(np.diff(fragment)) + 1
        for a, b in zip([0, *cut], [*cut, len(fragment)] if len(fragment) else []):
            edge = np.flatnonzero(np.diff(of[a:b], prepend=-1))
            yield (int(fragment[a]), None, None, name[of[a:b][edge]].tobytes(),
                   np.diff(edge, append=b - a).astype(np.uint32).tobytes(),
                   _packed(shingles[a:b]), None)

    code_path(df.sparkSession)
    return df.select(text_col).mapInArrow(run, _PIECE)


def _known(table: pa.Table) -> pa.Table:
    """Sizes and frequent shingles of the sets of one bucket, each set once: its copies say the same."""
    name = table.column("name").to_numpy()
    _, first = np.unique(name, return_index=True)
    table = table.take(pa.array(first))
    tokens, ranks = (table.column(c).to_pylist() for c in ("tokens", "ranks"))
    counts = np.array([len(t) // 8 for t in tokens], np.uint32)
    return pa.table([
        pa.array([-1 - table.column("fragment")[0].as_py()]), [name[first].tobytes()],
        [table.column("n").to_numpy().tobytes()], [counts.tobytes()], [b"".join(tokens)],
        [b"".join(ranks)]], names=_SHARED.names)


def _counted(table: pa.Table, fragments: int) -> pa.Table:
    """Of one fragment: for each set its shingles that other sets have too, with their frequency, as
    one row for each bucket of sets."""
    sets, tokens = [], []
    for s, c, t in zip(*(table.column(k).to_pylist() for k in ("sets", "counts", "tokens"))):
        sets.append(np.repeat(np.frombuffer(s, np.uint64), np.frombuffer(c, np.uint32)))
        tokens.append(_unpacked(t, np.uint64))
    name, token = np.concatenate(sets), np.concatenate(tokens)
    order = np.argsort(token, kind="stable")
    token, name = token[order], name[order]
    new = np.flatnonzero(np.diff(token, prepend=~token[:1]) != 0)
    run = np.repeat(np.arange(len(new)), np.diff(new, append=len(token)))
    several = np.diff(new, append=len(token))[run] > 1
    token, name, run = token[several], name[several], run[several]
    order = np.lexsort((name, run))
    token, name, run = token[order], name[order], run[order]
    fresh = np.ones(len(run), bool)  # copies of one set in several batches count once
    fresh[1:] = (run[1:] != run[:-1]) | (name[1:] != name[:-1])
    token, name, run = token[fresh], name[fresh], run[fresh]
    count = np.bincount(run)[run] if len(run) else run
    token, name, count = token[count > 1], name[count > 1], count[count > 1]
    # As Python's modulo of the signed name, which the sizes go by.
    bucket = name.view(np.int64) % np.int64(fragments)
    order = np.lexsort((token, name, bucket))
    token, name, count, bucket = token[order], name[order], count[order], bucket[order]
    edge = np.flatnonzero(np.diff(bucket, prepend=-1))
    rows = []
    for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(bucket)]):
        own, size = np.unique(name[a:b], return_counts=True)
        rows.append((int(bucket[a]), own.tobytes(), None, size.astype(np.uint32).tobytes(),
                     token[a:b].tobytes(), _packed(count[a:b])))
    columns = list(zip(*rows)) or [()] * 6
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), *[pa.binary()] * 5))],
                    names=_SHARED.names)


def shared_shingles(df: DataFrame, text_col: str, n: int, fragments: int, frequent) -> DataFrame:
    """The shingles that sets share with other sets, and their frequency, packed by buckets of sets."""
    def of_fragment(table: pa.Table) -> pa.Table:
        known = table.column("fragment")[0].as_py() < 0
        return _known(table) if known else _counted(table, fragments)

    return pieces(df, text_col, n, fragments, frequent).groupBy("fragment").applyInArrow(
        of_fragment, _SHARED)


def candidate_sets(shared: DataFrame, percent: int) -> DataFrame:
    """Sets that may be linked: name, ``n``, the shared shingles from rare to frequent, and how many
    of them the prefix filter takes. A bucket of sets is put together in one task; there are as many
    buckets as fragments, so one holds about as much as a fragment."""
    def sets(table: pa.Table) -> pa.Table:
        names, tokens, ranks, size_of = [], [], [], {}
        for s, z, c, t, r in zip(*(table.column(k).to_pylist() for k in _SHARED.names[1:])):
            own = np.frombuffer(s, np.int64)
            names.append(np.repeat(own, np.frombuffer(c, np.uint32)))
            tokens.append(np.frombuffer(t, np.int64))
            if z is None:
                ranks.append(_unpacked(r, np.int64))
            else:
                ranks.append(np.frombuffer(r, np.int64))
                size_of = dict(zip(own.tolist(), np.frombuffer(z, np.int64).tolist()))
        name, token, rank = map(np.concatenate, (names, tokens, ranks))
        order = np.lexsort((token, rank, name))
        name, token = name[order], token[order]
        first = np.flatnonzero(np.diff(name, prepend=~name[:1]) != 0)
        size = np.diff(first, append=len(name))
        n = np.array([size_of[x] for x in name[first].tolist()], np.int64)
        living = 100 * size >= percent * n
        token = token[np.repeat(living, size)]
        name, n, size = name[first][living], n[living], size[living]
        least = (percent * n + 99) // 100
        prefix = n - least + 1 - (n - size)  # shingles of no other set come first of all
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(token))
        return pa.table([pa.array(name), pa.array(n), pa.array(prefix, pa.int32()), lists],
                        names=_SET.names)

    return shared.groupBy("bucket").applyInArrow(sets, _SET)


def _reach(n_a: Column, n_b: Column, most: Column, percent: int) -> Column:
    """Whether sets of these sizes can have ``most`` shingles in common and be similar enough."""
    return (100 + percent) * most >= percent * (n_a + n_b)


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the size of their overlap: counted in fragments of the shingles' order,
    then summed."""
    span = 64 - (OVERLAP_FRAGMENTS - 1).bit_length()
    parts = sets.select("name", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(OVERLAP_FRAGMENTS - 1)), lambda f: F.struct(
            f.cast("long").alias("fragment"), F.filter(
                "tokens", lambda t: F.shiftrightunsigned(t, span) == f).alias("tokens"))
    )).alias("part")).select("name", "part.fragment", "part.tokens").filter(F.size("tokens") > 0)
    # The fragment is part of the key from the start: a set with very many pairs is several keys.
    split = pairs.withColumn("fragment", F.explode(F.sequence(
        F.lit(0).cast("long"), F.lit(OVERLAP_FRAGMENTS - 1).cast("long"))))
    left = split.join(parts.select(F.col("name").alias("a"), "fragment",
                                   F.col("tokens").alias("of_a")), ["a", "fragment"])
    both = left.join(parts.select(F.col("name").alias("b"), "fragment",
                                  F.col("tokens").alias("of_b")), ["b", "fragment"])
    return both.groupBy("a", "b").agg(
        F.sum(F.size(F.array_intersect("of_a", "of_b"))).alias("common"))


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of ``pairs`` (a, b, n_a, n_b) those whose Jaccard similarity reaches ``percent``."""
    counted = pairs.join(overlaps(pairs.select("a", "b"), sets), ["a", "b"])
    return counted.filter(100 * F.col("common") >= percent * (
        F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b")


def link_sets(sets: DataFrame, percent: int) -> DataFrame:
    """(name, component) of the sets that are linked with any other."""
    slots = sets.filter("prefix > 0").select("name", "n", F.size("tokens").alias("shared"), F.posexplode(
        F.slice("tokens", F.lit(1), F.col("prefix"))).alias("at", "token"))
    # What can be common when this shingle is the first common one: the ones from its place on.
    slots = slots.withColumn("most", F.col("shared") - F.col("at")).drop("at")
    best = F.max(F.struct((F.col("shared") / F.col("n")).alias("share"), "n", "name", "most"))
    hubs = slots.groupBy("token").agg(F.count("*").alias("held"), best.alias("hub")).filter(
        "held > 1").select("token", F.col("hub.name").alias("hub"), F.col("hub.n").alias("hub_n"),
                           F.col("hub.most").alias("hub_most"))
    slots = stored(slots.join(hubs, "token"), "slots")

    def pairs(rows: DataFrame, a: str, n_a: str, b: str, n_b: str) -> DataFrame:
        swap = F.col(a) > F.col(b)
        return rows.select(
            F.when(swap, F.col(b)).otherwise(F.col(a)).alias("a"),
            F.when(swap, F.col(a)).otherwise(F.col(b)).alias("b"),
            F.when(swap, F.col(n_b)).otherwise(F.col(n_a)).alias("n_a"),
            F.when(swap, F.col(n_a)).otherwise(F.col(n_b)).alias("n_b")).distinct()

    star = slots.filter((F.col("name") != F.col("hub")) & _reach(
        F.col("n"), F.col("hub_n"), F.least("most", "hub_most"), percent))
    links = stored(similar(pairs(star, "name", "n", "hub", "hub_n"), sets, percent), "links")
    found = stored(components(links), "components")

    # Sets still apart that share a prefix shingle. Those outside the hub's component look at all
    # others, and a shingle whose sets are in one component is left alone.
    def labelled(rows: DataFrame, name: str, label: str) -> DataFrame:
        own = found.select(F.col("node").alias(f"__{name}"), F.col("component").alias(label))
        return rows.join(own, F.col(name) == F.col(f"__{name}"), "left").withColumn(
            label, F.coalesce(label, name)).drop(f"__{name}")

    rows = labelled(slots, "name", "label")
    least = rows.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                      F.min("n").alias("least_n")).filter("low < high")
    home = labelled(hubs.select("token", "hub"), "hub", "hub_label").select("token", "hub_label")
    rows = rows.select("token", "name", "n", "most", "label").join(
        least.select("token", "least_n"), "token").filter(
        _reach(F.col("n"), F.col("least_n"), F.col("most"), percent)).drop("least_n")
    outside = rows.join(home, "token").filter(F.col("label") != F.col("hub_label"))
    other = rows.select("token", *(F.col(c).alias(f"{c}_b") for c in ("name", "n", "most", "label")))
    apart = outside.join(other, "token").filter(
        (F.col("label") != F.col("label_b"))
        & ((F.col("label_b") == F.col("hub_label")) | (F.col("name") < F.col("name_b")))
        & _reach(F.col("n"), F.col("n_b"), F.least("most", "most_b"), percent))
    more = similar(pairs(apart, "name", "n", "name_b", "n_b"), sets, percent)
    return components(stored(links.unionByName(more), "links")).select(
        F.col("node").alias("name"), "component")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row: the id, ``n_shingles`` and ``component_id``, the least id that links lead to."""
    sizes = stored(set_sizes(df, id_col, text_col, n), "sizes")
    frequent = frequent_shingles(sizes)
    total = sizes.filter("kind = 0").agg(F.sum("size")).first()[0] or 0
    fragments = max(2, -(-total // FRAGMENT_TOKENS),
                    int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shared = shared_shingles(df, text_col, n, fragments, frequent)
    sets = stored(candidate_sets(shared, percent), "sets")
    rows = sizes.filter("kind = 0").select("id", "size", F.when(
        F.col("hash") != 0, F.col("hash")).alias("name"))
    classes = rows.filter(F.col("name").isNotNull()).groupBy("name").agg(F.min("id").alias("id"))
    linked = stored(link_sets(sets, percent), "linked")
    least = classes.join(linked, "name").groupBy("component").agg(F.min("id").alias("least"))
    named = classes.join(linked.join(least, "component").select("name", "least"), "name", "left")
    named = named.select("name", F.coalesce("least", "id").alias("component_id"))
    return rows.join(named, "name", "left").select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each component of ``df``, the one of the least id, with all its columns. Of rows
    equal in id and text one stays; rows without an id are kept, as nothing names them."""
    found = near_duplicates(df, id_col, text_col, n, percent)
    kept = found.filter(F.col(id_col) == F.col("component_id")).select(
        F.col(id_col).alias("__kept")).distinct()
    names = df.columns
    plain = df.toDF(*(f"__c{i}" for i in range(len(names))))
    ident, text = (F.col(f"__c{names.index(c)}") for c in (id_col, text_col))
    rows = plain.join(kept.hint("shuffle_hash"), ident == F.col("__kept"), "left")
    place = F.row_number().over(Window.partitionBy(ident, F.xxhash64(text)).orderBy(F.lit(0)))
    rows = rows.filter(F.col("__kept").isNotNull()).withColumn("__place", place).filter(
        "__place = 1").select(*plain.columns)
    return rows.unionByName(plain.filter(ident.isNull())).toDF(*names)
