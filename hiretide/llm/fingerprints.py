"""Document fingerprints by a randomised edit embedding.

A text is cut where a hash of the last few characters says so, into segments of about 26 characters;
cuts depend on the characters around them alone. Every segment is embedded by one random walk that
all segments share: at step j the walk writes the character it stands on and then moves on or not, by a
random bit of (j, character). Segments a few edits apart soon walk in step again, so their walks differ
in few places: edit distance becomes Hamming distance. Each of ``BANDS`` bands samples a dozen places of the
walk, and a fingerprint holds for each band the least hash over the text's segments (a segment that comes
again counts as another one, by its number), so that the share of equal bands tells how alike two texts are.

``KEYS`` keys of four bands each, every band in two of them, name candidates (``links``): rows that agree in
a key. Each key has one of its rows as hub, which differs from key to key; all rows of the key meet it, and the
pair is verified on the whole fingerprints. Links make classes, and rows of one class need not meet.
Of a key of at most ``DIRECT`` rows, then, all rows of different classes meet, and those unlike the hub. In larger
keys very many rows may be somewhat alike, but not enough. Rows alike enough agree in 39 of 64 bands (at ``SIMILAR``),
so they have at least two of the 27 bands in common that are rarest among the rows of such keys. There rows of
different classes meet when they share a key and two of these bands, after all that have one of them have met a row of
the largest class with it. So a group of n near copies makes about n pairs a key and not n * n, no link between
classes is left out, and no key is gathered in a task. A pair of likeness s has no key in common, and may be
missed, with a chance of about (1 - s ** 4) ** 32: 1 % at ``SIMILAR``, 0.02 % at 0.7.

Null text counts as empty; the empty text's fingerprint is all zeros, equal texts have equal ones.
Each row is fingerprinted alone; texts of any length are walked whole, in memory bounded by
``BATCH_CHARS`` and the longest text. Rows without an id have a fingerprint and take part in no link; rows of
one id and different texts link each by its own text, under that id; rows of equal fingerprints stand together
as their least id. Empty tables give no rows. Only id and text are looked at, whatever other columns are called.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from hiretide.llm.common import arrow_map, by_bytes, code_path, stored, type_of
from hiretide.llm.components import components
from hiretide.llm.words import mix

BANDS, SLOT_CHARS = 64, 4
LEAST, MEAN, MOST = 10, 16, 64  # characters of a segment
GROUP, STRETCH = 8, 2  # a band samples one step of a group, in one of two stretches of 2 groups
STEPS = 3 * MOST
BATCH_CHARS = 3 << 20
BANDS_PER_KEY, SIMILAR = 4, 0.6
DIRECT = 32  # rows of a key that may be compared with each other
COMMON = 2  # of their rarest bands that rows of larger keys must have in common to be compared
#: Bands of each key: runs of four, and every sixteenth.
KEYS = [[*range(i, i + BANDS_PER_KEY)] for i in range(0, BANDS, BANDS_PER_KEY)] + [
    [*range(i, BANDS, BANDS // BANDS_PER_KEY)] for i in range(BANDS // BANDS_PER_KEY)]

_RNG = np.random.Generator(np.random.PCG64(20240607))
_MOVE = _RNG.integers(0, 2, (STEPS, 256), dtype=np.int32)  # of the shared walk
_SALT = _RNG.integers(1, 2**63, BANDS, dtype=np.uint64)
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _samples() -> list[list[int]]:
    """The bands that sample each step."""
    at: list[list[int]] = [[] for _ in range(STEPS)]
    groups = STEPS // GROUP
    for band in range(BANDS):
        for pair in range(0, groups, 2 * STRETCH):
            chosen = pair + STRETCH * int(_RNG.integers(0, 2))
            for group in {0, *range(chosen, min(groups, chosen + STRETCH))} if not pair else range(
                    chosen, min(groups, chosen + STRETCH)):
                at[group * GROUP + int(_RNG.integers(0, GROUP))].append(band)
    return at


_SAMPLES = _samples()


def segment_cuts(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where segments end, for texts that end at ``ends``."""
    n = len(codes)
    rolling = np.zeros(n, np.uint64)
    for k in range(4):
        rolling[k:] = rolling[k:] * np.uint64(31) + codes[:n - k]
    cut = mix(rolling) % np.uint64(MEAN) == 0
    at = np.union1d(np.flatnonzero(cut) + 1, ends)
    # Cuts closer than LEAST to the one before go, unless a text ends there; long rests are divided.
    is_end = np.isin(at, ends)
    kept, last = [], 0
    for place, end in zip(at.tolist(), is_end.tolist()):
        if place - last >= LEAST or end:
            if place > last:
                while place - last > MOST:
                    last += MOST
                    kept.append(last)
                kept.append(place)
                last = place
    return np.array(kept, np.int64)


def walk(codes: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of the sampled places of each segment's walk: (bands, segments)."""
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    place = start.astype(np.int64)
    stop = start + size
    seen = np.zeros((BANDS, len(start)), np.uint64)
    low = (codes % 256).astype(np.int32)
    value = codes.astype(np.uint64) + np.uint64(1)
    padded, low = np.append(value, np.uint64(0)), np.append(low, 0)
    out_of = len(codes)
    for j in range(min(STEPS, 3 * int(size[0]) if len(size) else 0)):
        live = int(np.searchsorted(-size, -(j // 3), side="left"))  # walks of 3 * size steps
        here = place[:live]
        at = np.where(here < stop[:live], here, out_of)
        for band in _SAMPLES[j]:
            row = seen[band, :live]
            row *= _MUL
            row += padded[at]
            row ^= row >> np.uint64(29)
        here += _MOVE[j][low[at]]
    out = np.empty_like(seen)
    out[:, order] = mix(seen ^ _SALT[:, None])
    return out


def fingerprint_texts(texts: list[str]) -> np.ndarray:
    """One row of ``BANDS`` 16-bit values per text."""
    out = np.zeros((len(texts), BANDS), np.uint16)
    if not any(texts):
        return out
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    joined = "".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(sizes)
    cuts = segment_cuts(codes, ends[sizes > 0])
    begin = np.concatenate([[0], cuts[:-1]])
    known: dict[str, int] = {}
    which = np.fromiter((known.setdefault(joined[a:b], len(known))
                         for a, b in zip(begin.tolist(), cuts.tolist())), np.int64, len(cuts))
    first = np.full(len(known), -1, np.int64)
    first[which[::-1]] = np.arange(len(which))[::-1]  # a distinct segment is walked once
    hashes = walk(codes, begin[first], (cuts - begin)[first])
    some = sizes > 0
    firsts = np.searchsorted(cuts, ends[some] - sizes[some], side="right")
    again, number = _repeats(which, np.searchsorted(ends, cuts, side="left"))
    for band in range(BANDS):
        values = hashes[band][which]
        values[again] = mix(values[again] + number)
        least = np.minimum.reduceat(values, firsts)
        out[some, band] = (least & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def _repeats(which: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segments that their text has had before, and the how-manieth each is, as a number to add."""
    order = np.lexsort((which, owner))
    same = np.zeros(len(order), bool)
    same[1:] = (which[order][1:] == which[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    at = np.arange(len(order))
    number = at - np.maximum.accumulate(np.where(same, 0, at))
    return order[same], number[same].astype(np.uint64) * _MUL


def as_text(prints: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in prints]


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and ``fingerprint``, 4 hexadecimal digits for each band."""

    def run(batch: pa.RecordBatch):
        for part in by_bytes(batch, batch.schema.names[1], BATCH_CHARS):
            yield [part.column(0), as_text(fingerprint_texts(
                [t or "" for t in part.column(1).to_pylist()]))]

    return arrow_map(df.select(id_col, text_col), run,
                     [(id_col, type_of(df, id_col)), ("fingerprint", T.StringType())])


def _keys(fingerprint: Column) -> Column:
    """The keys of a fingerprint in bytes."""
    return F.array(*(F.xxhash64(F.lit(k), *(
        F.substring(fingerprint, 2 * band + 1, 2) for band in bands)) for k, bands in enumerate(KEYS)))


def _verified(pairs: DataFrame, one: DataFrame, least: float) -> DataFrame:
    """Of ``pairs`` (x, y) those alike enough, with ``near``."""
    for c in ("x", "y"):
        pairs = pairs.join(one.select(F.col("row").alias(c), F.col("fingerprint").alias(f"of_{c}")), c)

    def run(batch: pa.RecordBatch):
        prints = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, BANDS)
                  for i in (2, 3)]
        near = (prints[0] == prints[1]).mean(axis=1)
        like = np.flatnonzero(near >= least)
        yield [*(batch.column(i).take(pa.array(like)) for i in (0, 1)), pa.array(near[like])]

    return arrow_map(pairs.select("x", "y", "of_x", "of_y"), run, [
        ("x", T.LongType()), ("y", T.LongType()), ("near", T.DoubleType())])


def _in_classes(classes: DataFrame, found: DataFrame) -> DataFrame:
    """``classes`` (row, class) with those as one that the links ``found`` join."""
    for c in ("x", "y"):
        found = found.join(classes.select(F.col("row").alias(c), F.col("class").alias(f"of_{c}")), c)
    return _renamed(classes, found.select(F.col("of_x").alias("a"), F.col("of_y").alias("b")))


def _renamed(classes: DataFrame, joined: DataFrame) -> DataFrame:
    return stored(classes.join(components(joined), F.col("class") == F.col("node"), "left").select(
        "row", F.coalesce("component", "class").alias("class")), "classes")


def _rarest_bands(one: DataFrame, rows: DataFrame, least: float) -> DataFrame:
    """Per row the hashes of its bands that the fewest of ``rows`` have: so many that two rows alike enough have
    ``COMMON`` of them in common. Those that no other row has are counted and left out."""
    most = BANDS - _needed(least) + min(COMMON, _needed(least))
    bands = F.array(*(F.xxhash64(F.lit(b), F.substring("fingerprint", 2 * b + 1, 2)) for b in range(BANDS)))
    bands = rows.join(one, "row").select("row", F.explode(bands).alias("band"))
    shared = bands.withColumn("n", F.count("*").over(Window.partitionBy("band"))).filter("n > 1")
    ranked = shared.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("n", "band")))["band"].alias("bands"))
    alone = BANDS - F.size("bands")  # the rarest, in no other row
    return stored(ranked.select("row", F.slice("bands", F.lit(1), F.greatest(F.lit(0), most - alone)).alias(
        "rare")), "rare")


def _needed(least: float) -> int:
    """Bands that rows so alike have in common."""
    return max(1, math.ceil(least * BANDS - 1e-9))


def _pairs_of(rows: DataFrame, by: str, met: Column) -> DataFrame:
    """Pairs (x, y) of ``rows`` of one ``by`` for which ``met`` holds of p and q."""
    p, q = rows.alias("p"), rows.alias("q")
    return p.join(q, (F.col(f"p.{by}") == F.col(f"q.{by}")) & (F.col("p.row") < F.col("q.row")) & met).select(
        F.col("p.row").alias("x"), F.col("q.row").alias("y"))


def _undecided(parts: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of the bands that rows of several classes have, with their class."""
    rows = parts.join(classes, "row")
    several = rows.groupBy("band").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    return stored(rows.join(several.filter("low <> high").select("band"), "band", "left_semi"), "parts")


def row_links(one: DataFrame, least: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """Verified links (``x`` < ``y``, ``near``) of ``one`` (row, fingerprint in bytes, each once), and the
    ``class`` of every row that they lead to."""
    keys = one.select("row", F.explode(_keys(F.col("fingerprint"))).alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    keys = stored(keys.join(shared.select("key", (F.col("n") <= DIRECT).alias("few")), "key"), "keys")
    # Another order for every key, so that a row's hubs differ.
    hubs = keys.groupBy("key").agg(F.min_by("row", F.xxhash64("key", "row", F.lit(1))).alias("hub"))
    met = keys.join(hubs, "key").filter("row <> hub").select(
        "key", "row", "few", F.least("row", "hub").alias("x"), F.greatest("row", "hub").alias("y"))
    found = [stored(_verified(met.select("x", "y").distinct(), one, least), "links")]
    classes = _renamed(one.select("row", F.col("row").alias("class")),
                       found[0].select(F.col("x").alias("a"), F.col("y").alias("b")))

    unlike = met.join(found[0].select("x", "y", F.lit(False).alias("unlike")), ["x", "y"], "left").select(
        "key", "row", "few", F.coalesce("unlike", F.lit(True)).alias("unlike")).join(classes, "row")
    several = unlike.groupBy("key").agg(
        F.min("class").alias("low"), F.max("class").alias("high"), F.count_if("unlike").alias("n"))
    rest = stored(unlike.join(several.filter("low <> high OR n > 1").select("key"), "key", "left_semi"), "keys")
    apart = F.col("p.class") != F.col("q.class")
    pairs = _pairs_of(rest.filter("few"), "key", apart | (F.col("p.unlike") & F.col("q.unlike")))

    many = rest.filter("NOT few").groupBy("row").agg(F.collect_list("key").alias("keys"))
    rare = _rarest_bands(one, many.select("row"), least)
    parts = many.join(rare, "row").select(F.explode("rare").alias("band"), "row", "keys")
    parts = _undecided(parts, classes)
    sizes = classes.groupBy("class").agg(F.count("*").alias("size"))
    hub = F.max_by(F.struct("row", "class", "keys"), F.struct("size", F.xxhash64("band", "row")))
    hubs = parts.join(sizes, "class").groupBy("band").agg(hub.alias("hub"))
    near = parts.join(hubs, "band").filter(
        (F.col("class") != F.col("hub.class")) & F.arrays_overlap("keys", "hub.keys")).select(
        F.least("row", "hub.row").alias("x"), F.greatest("row", "hub.row").alias("y"))
    found.append(stored(_verified(pairs.unionByName(near).distinct(), one, least), "links"))
    classes = _in_classes(classes, found[1])

    pairs = _pairs_of(_undecided(parts.drop("class"), classes), "band",
                      apart & F.arrays_overlap("p.keys", "q.keys"))
    pairs = pairs.groupBy("x", "y").count().filter(F.col("count") >= min(COMMON, _needed(least))).select("x", "y")
    found.append(stored(_verified(pairs, one, least), "links"))
    classes = _in_classes(classes, found[2])
    return found[0].unionByName(found[1]).unionByName(found[2]).distinct(), classes


def links(prints: DataFrame, id_col: str = "doc_id", least: float = SIMILAR) -> DataFrame:
    """Verified links (``a``, ``b``, ``near``) between ids of ``prints`` (with ``fingerprint`` in bytes); rows of
    equal fingerprint stand together as their least id."""
    one, found, _ = _named_links(prints, id_col, least)
    for c, name in (("x", "a"), ("y", "b")):
        found = found.join(one.select(F.col("row").alias(c), F.col("same_id").alias(name)), c)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "near")


def _named_links(prints: DataFrame, id_col: str, least: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = prints.filter(F.col(id_col).isNotNull()).groupBy("fingerprint").agg(F.min(id_col).alias("same_id"))
    one = stored(rows.select(F.xxhash64("fingerprint").alias("row"), "same_id", "fingerprint"), "prints")
    found, classes = row_links(one, least)
    return one, stored(found, "links"), classes


def with_neighbours(prints: DataFrame, id_col: str = "doc_id", least: float = SIMILAR) -> DataFrame:
    """``prints``, their ``fingerprint`` as bytes, with ``same_id``, the least id of the equal fingerprints;
    ``class_id``, the least id that links lead to; and the likest verified neighbour (ties: the least
    id), ``link_id`` and ``link_near``, null without links. All four are null where the id is."""
    one, found, classes = _named_links(prints, id_col, least)
    names = one.select("row", "same_id")
    ends = found.unionByName(found.select(F.col("y").alias("x"), F.col("x").alias("y"), "near"))
    ends = ends.join(names.select(F.col("row").alias("y"), F.col("same_id").alias("other")), "y")
    ends = ends.groupBy("x").agg(F.min(F.struct((-F.col("near")).alias("far"), "other")).alias("__link"))
    classes = classes.join(names, "row")
    least_id = classes.groupBy("class").agg(F.min("same_id").alias("class_id"))
    known = classes.join(least_id, "class").join(ends, F.col("row") == F.col("x"), "left").select(
        F.col("row").alias("__row"), "same_id", "class_id",
        F.col("__link.other").alias("link_id"), (-F.col("__link.far")).alias("link_near"))
    row = F.when(F.col(id_col).isNotNull(), F.xxhash64("fingerprint"))
    return prints.join(known, row == F.col("__row"), "left").drop("__row")


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the beginning of ``following``."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut] if cut else text


def _ordered(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows by descending id in buckets, each bucket with the first row after it as a last row.

    Bucket bounds are ids of the table (quantiles from a mergeable sketch), so the row after a bucket
    is known by its id; the row after the last is the first of all."""
    spark = df.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    lowest = F.lit(-(1 << 63)).cast("long")
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                     F.coalesce(F.col(id_col).cast("long"), lowest).alias("key"))
    quantiles = [(i + 1) / buckets for i in range(buckets)]
    bounds = rows.agg(F.percentile_approx("key", quantiles, 100 * buckets), F.max("key")).first()
    bounds = sorted({*(bounds[0] or []), *([bounds[1]] if bounds[1] is not None else [])})
    width = max(1, int(len(bounds) ** 0.5))
    longs = "array<bigint>"
    coarse = F.array(*(F.lit(b) for b in bounds[::width])).cast(longs)
    fine = F.array(*(F.array(*(F.lit(b) for b in bounds[i:i + width]))
                     for i in range(0, len(bounds), width))).cast(f"array<{longs}>")

    def below(values):
        return F.size(F.filter(values, lambda x: x < F.col("key")))

    part = F.greatest(below(coarse) - 1, F.lit(0))
    rows = rows.withColumn("part", part) if bounds else rows.withColumn("part", F.lit(0))
    own = F.element_at(fine, F.col("part") + 1) if bounds else F.array().cast(longs)
    rows = rows.withColumn("bucket", F.col("part") * width + below(own))
    ends = F.array_contains(F.flatten(F.array(own, F.slice(coarse, F.col("part") + 2, F.lit(1)))),
                            F.col("key")) if bounds else F.lit(False)
    copy = F.struct(F.pmod(F.col("bucket") + 1, F.lit(max(1, len(bounds)))).alias("bucket"),
                    F.lit(1).alias("after"))
    place = F.struct(F.col("bucket"), F.lit(0).alias("after"))
    rows = rows.select("id", "text", "key", F.explode(
        F.when(ends, F.array(place, copy)).otherwise(F.array(place))).alias("p"))
    return rows.select("id", "text", "key", "p.bucket", "p.after").repartition(
        max(1, buckets // 4), "bucket").sortWithinPartitions(
        "bucket", "after", F.col("key").desc(), "text")


def edit_likeness(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they are.

    Ids are whole numbers. The row after a row is that of the next lower id (nulls last, ties by
    text); after the last comes the first."""
    schema = T.StructType([T.StructField(id_col, type_of(df, id_col)),
                           T.StructField("n_chars", T.LongType()),
                           *(T.StructField(c, T.StringType()) for c in (
                               "edited_sha256", "fingerprint", "edited_fingerprint")),
                           *(T.StructField(c, T.DoubleType()) for c in (
                               "near_edited", "near_next"))])

    def done(rows: list[tuple]) -> pa.RecordBatch:
        """Of rows that each are followed in the list, the last one excepted."""
        texts = [r[1] for r in rows]
        pairs = [i for i in range(len(rows) - 1) if not rows[i][3] and rows[i][2] == rows[i + 1][2]]
        new = [edited(texts[i], texts[i + 1]) for i in pairs]
        prints = fingerprint_texts(texts + new)
        own, other = prints[:len(texts)], prints[len(texts):]
        at = np.array(pairs, np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array([rows[i][0] for i in pairs], arrow_id),
            pa.array([len(texts[i]) for i in pairs], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
            pa.array(as_text(own[at]), pa.string()), pa.array(as_text(other), pa.string()),
            pa.array((own[at] == other).mean(axis=1), pa.float64()),
            pa.array((own[at] == own[at + 1]).mean(axis=1), pa.float64())], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for ident, text, bucket, after in zip(*(c.to_pylist() for c in batch.columns)):
                # Of equal rows that stand after a bucket the first is enough.
                if after and rows and rows[-1][3] and rows[-1][2] == bucket:
                    continue
                rows.append((ident, text or "", bucket, after))
                size += len(rows[-1][1])
                if size >= BATCH_CHARS and len(rows) > 1:
                    yield done(rows)
                    rows = rows[-1:]
                    size = len(rows[0][1])
        if len(rows) > 1:
            yield done(rows)

    arrow_id = to_arrow_type(type_of(df, id_col))
    code_path(df.sparkSession)
    return _ordered(df, id_col, text_col).select("id", "text", "bucket", "after").mapInArrow(
        run, schema)
