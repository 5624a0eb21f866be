"""Importance resampling of documents towards a target distribution.

An untrained ``tokenizers`` pre-tokeniser, a Split by one regular expression over ASCII-lowered text,
returns each text's words with their offsets. Windows of one and of two consecutive offset pairs are the
features; a feature's CRC-32 over the UTF-8 bytes (of a pair: over both words and one space between) modulo
``BUCKETS`` is its bucket. Documents and target each give one histogram of buckets. A bucket's gain says how
much more common it is in the target; a document's weight is the mean gain of its features. Weights with
Gumbel noise, drawn by a hash of seed and id, are the scores, and the highest scores are the draw: a sample
without replacement, by weight, that any re-run repeats.

Texts are read once: the buckets of all features are stored, two bytes each, and both the histograms and the
weights come from these. Histograms are added up inside each task, so at most ``BUCKETS`` rows leave it; the
gains (``BUCKETS`` numbers, whatever the corpus) go to the tasks with the code. Ranks come from one range
partitioned sort: a row's place in its partition and the partitions' counts give its rank, so no task
sees more than its share and the driver gets one count per partition.

Null and empty texts have no features, weight 0. A null id is hashed as the empty text and comes first among
equal scores; rows of one id are judged each by their own text, equal rows among equal scores stand in any order.
Texts of any length are split whole, in slices that end at separators. Only id and text are looked at: other
columns and their names do not matter. Empty tables give no rows; without a target all counts there are 0.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, pre_tokenizers

from hiretide.llm.common import arrow_map, by_bytes, code_path, stored, type_of
from hiretide.llm.words import text_bytes

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"  # what is no word once A-Z are a-z
BUCKETS, LONGEST_RUN = 10_000, 2
LEAST_WORDS, DRAWN_PCT, SEED = 20, 25, 7
BATCH_BYTES, SLICE_CHARS = 2 << 20, 1 << 14
LONG_WORD = 48  # bytes; longer words are rare and hashed one by one

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CUT = re.compile(SEPARATOR)
_PLACE = (1 << 33) - 1  # of a row in its partition, in what monotonically_increasing_id gives


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def crc_on(crc: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of what gave ``crc`` and then the bytes ``data[start:start + size]``, for each word."""
    out = np.empty_like(crc)
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        out[i] = zlib.crc32(data[start[i]:start[i] + size[i]].tobytes(), int(crc[i]))
    short = np.flatnonzero(size <= LONG_WORD)
    short = short[np.argsort(-size[short], kind="stable")]
    state, place, falling = ~crc[short], start[short], -size[short]
    for j in range(int(-falling[0]) if len(short) else 0):
        live = int(np.searchsorted(falling, -j, side="left"))  # words of more than j bytes
        now = state[:live]
        state[:live] = _CRC[(now ^ data[place[:live] + j]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out[short] = ~state
    return out


def word_offsets(text: str, split: pre_tokenizers.PreTokenizer) -> np.ndarray:
    """Begins and ends, in code points, of the words of a text, in turns."""
    found, at = [], 0
    while at < len(text):
        end = len(text)
        if end - at > SLICE_CHARS:  # a slice ends behind a separator, so it cuts no word
            cut = _CUT.search(text, at + SLICE_CHARS)
            end = cut.end() if cut else end
        for _, (a, b) in split.pre_tokenize_str(text[at:end]):
            found += (at + a, at + b)
        at = end
    return np.array(found, np.int64)


def feature_buckets(column: pa.Array, split: pre_tokenizers.PreTokenizer
                    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features, text by text; the bounds of the texts in them; words of each text."""
    data, ends = text_bytes(column)
    data = _LOWER[data]
    whole = data.tobytes()
    offsets = [word_offsets(whole[a:b].decode(), split) for a, b in zip(ends.tolist(), ends[1:].tolist())]
    words = np.array([len(o) // 2 for o in offsets], np.int64)
    byte_of = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # of each code point
    begin = np.searchsorted(byte_of, ends[:-1])
    pairs = (np.concatenate(offsets) + np.repeat(begin, 2 * words)).reshape(-1, 2)
    start, stop = byte_of[pairs].T
    size = stop - start
    owner = np.repeat(np.arange(len(words)), words)
    nothing = np.zeros(len(start), np.uint32)
    crc = crc_on(nothing, data, start, size)
    buckets, owners = [crc % BUCKETS], [owner]
    space = np.full(1, 32, np.uint8)
    for run in range(1, LONGEST_RUN):  # windows one word longer, from those that the text goes on behind
        goes_on = np.flatnonzero(owner[:len(owner) - run] == owner[run:])
        wide = np.zeros(len(start), np.uint32)
        wide[goes_on] = crc_on(
            crc_on(crc[goes_on], space, np.zeros(len(goes_on), np.int64), np.ones(len(goes_on), np.int64)),
            data, start[goes_on + run], size[goes_on + run])
        buckets.append(wide[goes_on] % BUCKETS)
        owners.append(owner[goes_on])
        crc = wide
    owner, bucket = np.concatenate(owners), np.concatenate(buckets).astype(np.uint16)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.searchsorted(owner[order], np.arange(len(words) + 1)), words


def features(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: ``id``, ``n_words`` and the buckets of its features as two-byte numbers."""
    def run(batch: pa.RecordBatch):
        split = pre_tokenizers.Split(Regex(SEPARATOR + "+"), "removed")
        for part in by_bytes(batch, batch.schema.names[1], BATCH_BYTES):
            bucket, bounds, words = feature_buckets(part.column(1), split)
            cut = (2 * bounds).tolist()
            raw = bucket.astype("<u2").tobytes()
            yield [part.column(0), pa.array(words),
                   pa.array([raw[a:b] for a, b in zip(cut, cut[1:])], pa.binary())]

    # Under names of their own: id and text may be one column.
    return arrow_map(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, [
        ("id", type_of(df, id_col)), ("n_words", T.LongType()), ("buckets", T.BinaryType())])


def histogram(found: DataFrame) -> np.ndarray:
    """How many features each bucket holds: one row per bucket and task is shuffled."""
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                total += np.bincount(np.frombuffer(raw.as_py(), "<u2"), minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])],
                                         names=schema.names)

    code_path(found.sparkSession)
    rows = found.select("buckets").mapInArrow(count, schema).groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in rows.collect():  # at most BUCKETS rows
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousandth's logarithm of how much more common each bucket is in the target, smoothed by one."""
    s_all, t_all = int(source.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weights(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``id``, ``n_words``, ``n_features`` and ``weight``, the mean gain of the features, floored."""
    def run(batch: pa.RecordBatch):
        raw = batch.column(2)
        bucket = np.frombuffer(b"".join(raw.to_pylist()), "<u2")
        bounds = np.append(0, np.cumsum([len(x) // 2 for x in raw.to_pylist()])).astype(np.int64)
        total = np.append(0, np.cumsum(gain[bucket]))
        n = np.diff(bounds)
        yield [batch.column(0), batch.column(1), pa.array(n), pa.array(
            np.floor_divide(total[bounds[1:]] - total[bounds[:-1]], np.maximum(n, 1)))]

    return arrow_map(found, run, [
        ("id", type_of(found, "id")), ("n_words", T.LongType()), ("n_features", T.LongType()),
        ("weight", T.LongType())])


def noise(ident: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from a hash of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def ranked(scored: DataFrame, pct: int, least_words: int) -> DataFrame:
    """``scored`` with ``rank``, 1 for the highest score, of the rows that are drawn."""
    tasks = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("enough"), F.desc("score"), F.asc_nulls_first("id")]
    placed = scored.withColumn("enough", F.col("n_words") >= least_words) \
        .repartitionByRange(tasks, *order).sortWithinPartitions(*order) \
        .withColumn("at", F.monotonically_increasing_id())
    placed = stored(placed, "ranked").withColumn("part", F.shiftright("at", 33))
    counts = placed.groupBy("part").agg(F.count_if("enough")).collect()  # a row per partition
    drawn = pct * sum(n for _, n in counts) // 100
    before, starts = 0, []
    for part, n in sorted(map(tuple, counts)):
        starts.append((part, before))
        before += n
    spark = scored.sparkSession
    offsets = spark.createDataFrame(starts, "part long, before long")
    rank = F.col("before") + F.col("at").bitwiseAND(F.lit(_PLACE)) + 1
    return placed.join(F.broadcast(offsets), "part").withColumn(
        "rank", F.when(F.col("enough") & (rank <= drawn), rank))


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", pct: int = DRAWN_PCT, least_words: int = LEAST_WORDS,
             seed: int = SEED) -> DataFrame:
    """Per row: the id, ``n_features``, ``weight``, ``score`` and ``rank`` (null: not drawn)."""
    found = stored(features(df, id_col, text_col), "features")
    wanted = stored(features(target, target_text_col, target_text_col), "target_features")
    weighed = weights(found, gains(histogram(found), histogram(wanted)))
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    return ranked(scored, pct, least_words).select(
        F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
