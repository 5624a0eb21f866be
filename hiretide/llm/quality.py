"""Quality rules whose thresholds come from quantile sketches per language and source.

Two fixed rules fail a document outright: fewer than 20 words, or over 30 % of its words inside
8-word windows that the text holds twice or more. The others are relative: for every measure (a part of
a whole, as capitals of letters) a mergeable quantile sketch (``percentile_approx``) per language and source gives
median and quartiles, one per language those for small groups to lean on: a group of n rows counts n times,
its language ``LEAN`` times. A fence stands ``FENCE`` times the spread (the way from the median to the
quartile of its side, as a standard deviation) from the median. A document fails where it lies
beyond a fence by more than chance makes its own share vary, three times the root of fence by whole. Median
and quartiles stand nearly unmoved while less than a quarter of a group is junk.

Symbols, marks and repeated lines are absent from most texts, so that sketches of them have no spread:
``FLOORS`` keeps these three fences from falling to nothing. The other four (capitals, echoes, and word length on
both sides) are the sketches' alone.

Null text counts as empty (no words, so it fails); null language or source is a group of its own.
Each row is judged alone: repeated rows and equal ids each give one row. An empty table gives an
empty result. A group of few rows has the same rule; with equal values chance alone decides.
Only id, text, language and source columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiretide.llm.common import arrow_map, by_bytes, stored, type_of
from hiretide.llm.words import gram_hashes, split_words, word_hashes

LEAST_WORDS, MOST_REPEATED_PCT, WINDOW = 20, 30, 8
BATCH_BYTES = 8 << 20
FENCE, CHANCE, LEAN, ACCURACY = 6.0, 3.0, 50, 10_000
QUARTILE = 0.6745  # standard deviations from the median of a normal distribution to its quartiles
#: Measure: its part, its whole, and whether it is judged below and above.
MEASURES: dict[str, tuple[str, str, bool, bool]] = {
    "symbol_share": ("n_symbols", "word_chars", False, True),
    "mark_share": ("n_marks", "word_chars", False, True),
    "upper_share": ("n_upper", "n_cased", False, True),
    "dup_line_share": ("n_dup_lines", "n_lines", False, True),
    "echo_share": ("n_echoes", "n_words", False, True),
    "word_length": ("word_chars", "n_words", True, True),
}
#: The least fences of measures that most texts do not have at all.
FLOORS = {"symbol_share": 0.05, "mark_share": 0.05, "dup_line_share": 0.4}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_BLANK = " \t\n\x0b\x0c\r"


def _per_text(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[ends])


def repeated_words(hashes: np.ndarray, first: np.ndarray, n: int = WINDOW) -> np.ndarray:
    """Per text: words inside n-word windows that the text holds twice or more."""
    grams, owner = gram_hashes(hashes, first, n)
    keys = grams ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(first) - 1, np.int64)
    hit = np.flatnonzero(np.isin(keys, twice))
    rank = hit - np.searchsorted(owner, owner[hit])  # of the window within its text
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, first[owner[hit]] + rank, 1)
    np.add.at(edge, first[owner[hit]] + rank + n, -1)
    return _per_text(np.cumsum(edge[:-1]) > 0, first)


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text of a string column."""
    w = split_words(column)
    solid = np.zeros(len(w.data) + 1, np.int64)
    solid[w.start] += 1
    np.add.at(solid, w.stop, -1)
    solid = np.cumsum(solid[:-1]) > 0
    lines, dup = [], []
    for text in column.to_pylist():
        own = [x for x in (text or "").split("\n") if x.strip(_BLANK)]
        lines.append(len(own))
        dup.append(len(own) - len(set(own)))
    hashes = word_hashes(w, lower=False)
    echo = np.zeros(len(hashes), bool)
    echo[1:] = hashes[1:] == hashes[:-1]
    echo[w.first[:-1][w.counts > 0]] = False
    return {
        "n_words": w.counts,
        "word_chars": _per_text(solid & ((w.data & 0xC0) != 0x80), w.ends),
        "n_symbols": _per_text(_SYMBOL[w.data], w.ends),
        "n_dup_lines": np.array(dup, np.int64),
        "n_repeat_words": repeated_words(hashes, w.first),
        "n_lines": np.array(lines, np.int64),
        "n_echoes": _per_text(echo, w.first),
        "n_marks": _per_text(_MARK[w.data], w.ends),
        "n_upper": _per_text(_UPPER[w.data], w.ends),
        "n_cased": _per_text(_UPPER[w.data] | _LOWER[w.data], w.ends),
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_echoes", "n_marks", "n_upper", "n_cased")


def quality_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   group_cols: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Per row: id, group columns and the counts."""
    keys = (id_col, *group_cols)

    def run(batch: pa.RecordBatch):
        at = batch.num_columns - 1
        for part in by_bytes(batch, batch.schema.names[at], BATCH_BYTES):
            counts = measure(part.column(at))
            yield [*(part.column(i) for i in range(at)), *(pa.array(counts[c]) for c in COUNTS)]

    return arrow_map(df.select(*keys, text_col), run, [
        *((k, type_of(df, k)) for k in keys), *((c, T.LongType()) for c in COUNTS)])


def with_measures(counts: DataFrame) -> DataFrame:
    return counts.withColumns({
        "base_failed": (F.col("n_words") < LEAST_WORDS)
        | (100 * F.col("n_repeat_words") > MOST_REPEATED_PCT * F.col("n_words")),
        **{m: F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))
           for m, (part, whole, _, _) in MEASURES.items()}})


def thresholds(measured: DataFrame, group_cols: tuple[str, ...] = ("lang", "source"),
               fence: float = FENCE) -> DataFrame:
    """One row per group (the last of its columns within the others): the columns of the group, and
    ``<measure>_low`` and ``_high``."""
    def sketched(by: tuple[str, ...], name: str) -> DataFrame:
        return measured.groupBy(*by).agg(F.count("*").alias(f"n_{name}"), *(
            F.percentile_approx(m, [0.25, 0.5, 0.75], ACCURACY).alias(f"{m}_{name}") for m in MEASURES))

    wider = group_cols[:-1] or group_cols
    own = sketched(group_cols, "own")
    wide = sketched(wider, "wide")
    wide = wide.toDF(*(f"__wide_{c}" for c in wider), *wide.columns[len(wider):])
    on = [F.col(c).eqNullSafe(F.col(f"__wide_{c}")) for c in wider]
    both = own.join(wide, on, "left")

    def leaning(m: str, i: int) -> Column:
        n = F.col("n_own")
        return (n * F.col(f"{m}_own")[i] + LEAN * F.col(f"{m}_wide")[i]) / (n + LEAN)

    bounds = []
    for m, (_, _, below, above) in MEASURES.items():
        low, middle, high = (leaning(m, i) for i in range(3))
        if below:
            bounds.append((middle - (middle - low) * F.lit(fence / QUARTILE)).alias(f"{m}_low"))
        if above:
            bounds.append(F.greatest(middle + (high - middle) * F.lit(fence / QUARTILE),
                                     F.lit(FLOORS.get(m, 0.0))).alias(f"{m}_high"))
    return both.select(*group_cols, *bounds)


def _failed() -> Column:
    """Names of the bounds that a row lies beyond, by more than chance."""
    out = []
    for m, (_, whole, below, above) in MEASURES.items():
        for side, judged in (("low", below), ("high", above)):
            if judged:
                bound = F.col(f"{m}_{side}")
                chance = F.lit(CHANCE) * F.sqrt(F.greatest(bound, F.lit(0.0)) / F.col(whole))
                beyond = F.col(m) < bound - chance if side == "low" else F.col(m) > bound + chance
                out.append(F.when((F.col(whole) > 0) & beyond, F.lit(f"{m}_{side}")))
    return F.array_compact(F.array(*out))


def _passes() -> Column:
    return ~F.col("base_failed") & (F.size(_failed()) == 0)


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          group_cols: tuple[str, ...] = ("lang", "source"), fence: float = FENCE) -> DataFrame:
    """Per row of ``df``: id, group columns, counts, ``base_failed``, ``kept`` and ``failed_on``."""
    counts = stored(quality_counts(df, id_col, text_col, group_cols), "quality")  # texts are read once
    measured = with_measures(counts)
    limits = thresholds(measured, group_cols, fence)
    limits = limits.select(*(F.col(g).alias(f"__{g}") for g in group_cols),
                           *(c for c in limits.columns if c not in group_cols))
    on = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group_cols]
    joined = measured.join(limits, on, "left")
    return joined.select(id_col, *group_cols, *COUNTS, "base_failed", _passes().alias("kept"),
                         F.array_join(_failed(), ",").alias("failed_on"))


def keep_good(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              group_cols: tuple[str, ...] = ("lang", "source"), fence: float = FENCE) -> DataFrame:
    """The rows of ``df`` that pass, with all their columns. The measures are taken inside the row,
    so equal or null ids do no harm."""
    names = df.columns
    at = [names.index(c) for c in (*group_cols, text_col)]

    def run(batch: pa.RecordBatch):
        for part in by_bytes(batch, batch.schema.names[at[-1]], BATCH_BYTES):
            counts = measure(part.column(at[-1]))
            yield [*part.columns, *(pa.array(counts[c]) for c in COUNTS)]

    # Positions instead of names: a column of the table may be called like a count. Texts are measured once:
    # rows are stored with their counts, which the sketches read alone.
    plain = df.toDF(*(f"c{i}" for i in range(len(names))))
    measured = with_measures(stored(arrow_map(plain, run, [
        *((c, type_of(plain, c)) for c in plain.columns), *((c, T.LongType()) for c in COUNTS)]), "quality"))
    groups = tuple(f"c{i}" for i in at[:-1])
    limits = thresholds(measured, groups, fence)
    limits = limits.toDF(*(f"__{g}" for g in groups), *limits.columns[len(groups):])
    joined = measured.join(limits, [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in groups], "left")
    return joined.filter(_passes()).select(
        *(F.col(f"c{i}").alias(n) for i, n in enumerate(names)))
