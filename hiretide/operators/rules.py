"""Patterns that are a table: which of very many texts stand in which of very many others.

Each pattern is filed under one key, of the pieces it is made of the one that the fewest patterns have: of
its runs of three letters (shorter patterns: all of it), or, for whole words, of its words. A text is
broken into its distinct pieces once; those that are keys lead to the patterns filed there, and only these
are looked for in the text. So the work follows the texts and what they may hold, not texts times patterns.

A pattern that is a run of letters, digits and ``_`` stands inside one of the text's words. It is filed under
itself, and the text is broken into its distinct words, or into what these hold of the patterns' lengths: an
equal key is the pattern, so nothing is looked for in the text, which stays where it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = 3
#: Bytes of patterns, as they are, up to which they go to every task; beyond them pieces and
#: patterns are shuffled by key.
MOST_BROADCAST = 64 << 20
WORD = r"\w+"
LONG_WORD = 64


def _pieces(text: Column, match: str, sizes: list[int]) -> Column:
    """The distinct pieces of a text; runs of letters overlap, so they are read by looking ahead."""
    if match == "word":
        return _words(text)
    found = [F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in sizes]
    return F.array_distinct(F.concat(*found)) if found else F.array().cast("array<string>")


def _held(text: Column, pattern: Column, match: str) -> Column:
    found = text.contains(pattern)
    if match == "word":
        # Of a pattern as it is: what has a meaning in expressions is quoted.
        quoted = F.regexp_replace(pattern, r"([\\^$.|?*+()\[\]{}&#~\-])", r"\\$1")
        found = found & F.regexp_like(text, F.concat(F.lit(r"(?U)(?<!\w)"), quoted, F.lit(r"(?!\w)")))
    return found


def filed(patterns: DataFrame, pattern: str = "pattern", match: str = "substring") -> DataFrame:
    """``patterns`` with ``__key``, the piece each is filed under. Null and empty ones are left out, and so is
    for whole words what has no letter, digit or ``_``."""
    rows = patterns.filter(F.col(pattern) != "")
    whole = F.when(F.length(pattern) <= PIECE, F.array(F.col(pattern)))
    pieces = _pieces(F.col(pattern), match, [PIECE])
    rows = rows.withColumn("__piece", pieces if match == "word" else F.coalesce(whole, pieces))
    own = rows.select(F.col(pattern).alias("__own"), F.explode("__piece").alias("__piece")).distinct()
    rare = own.join(own.groupBy("__piece").agg(F.count("*").alias("__n")), "__piece").groupBy("__own").agg(
        F.min_by("__piece", F.struct("__n", "__piece")).alias("__key"))
    return rows.drop("__piece").join(rare, F.col(pattern) == F.col("__own")).drop("__own")


def _words(text: Column) -> Column:
    """The distinct words of a text, the runs of letters, digits and ``_``."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?U)({WORD})"), F.lit(1)))


def _runs(words: Column, sizes: list[int]) -> Column:
    """What ``words`` hold of these lengths, each once."""
    def of(n: int) -> Column:
        # A place in a word is counted from its beginning, which for long ones takes longer than reading ahead.
        ahead = F.lit(f"(?s)(?=(.{{{n}}}))")
        inside = F.transform(F.filter(words, lambda w: F.length(w) >= n), lambda w: F.when(
            F.length(w) <= LONG_WORD, F.transform(F.sequence(F.lit(1), F.length(w) - (n - 1)),
                                                  lambda i: F.substring(w, i, F.lit(n)))).otherwise(
            F.regexp_extract_all(w, ahead, F.lit(1))))
        return F.flatten(inside)

    found = [of(n) for n in sizes]
    return F.array_distinct(F.concat(*found))


def find_patterns(df: DataFrame, patterns: DataFrame, text: str, pattern: str = "pattern",
                  match: str = "substring", most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """One row for each row of ``df`` and pattern in its ``text``: the columns of ``df`` but the text, and those of
    ``patterns``, whose names must differ. Texts are compared as they are: lower both for any case.

    ``match="word"``: the pattern has no letter, digit or ``_`` before or behind it. Patterns up to
    ``most_broadcast`` bytes are sent to the tasks and nothing is shuffled; beyond, pieces are dealt by key
    and candidates of more than a word meet their texts again by row, each text crossing once.
    """
    if match not in ("substring", "word"):
        raise ValueError(f"match must be 'substring' or 'word', not {match!r}")
    if shared := {c.lower() for c in df.columns} & {c.lower() for c in patterns.columns}:
        raise ValueError(f"columns of both: {sorted(shared)}")
    is_run = F.regexp_like(F.col(pattern), F.lit(rf"(?U)\A{WORD}\z"))
    length = F.least(F.length(pattern), F.lit(PIECE))
    runs, sizes, size = patterns.filter(F.col(pattern) != "").agg(
        F.collect_set(F.when(is_run, F.length(pattern))), F.collect_set(F.when(~is_run, length)),
        F.sum(F.octet_length(F.to_json(F.struct("*"))) + PIECE)).first()
    small = (size or 0) <= most_broadcast
    kept = [c for c in df.columns if c != text]
    rows = df.select(*kept, F.col(text).alias("__text"))
    found = []
    if runs or not sizes:
        keys = _words(F.col("__text"))
        if match == "substring":
            # A step of its own: the words are used once for each length.
            keys, rows_of = _runs(F.col("__words"), sorted(runs) or [1]), rows.withColumn("__words", keys)
        else:
            rows_of = rows
        pieces = rows_of.select(*kept, F.explode(keys).alias("__key"))
        index = patterns.filter(is_run).withColumn("__key", F.col(pattern))
        met = pieces.join(F.broadcast(index) if small else index, "__key")
        found.append(met.select(*kept, *patterns.columns))
    if sizes:
        index = filed(patterns.filter(~is_run), pattern, match)
        found.append(_candidates(rows, index, kept, patterns.columns, match, sorted(sizes), pattern, small))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def _candidates(rows: DataFrame, index: DataFrame, kept: list[str], own: list[str], match: str,
                sizes: list[int], pattern: str, small: bool) -> DataFrame:
    """Patterns of ``index`` that a piece of a text leads to and that stand in it."""
    found = _held(F.col("__text"), F.col(pattern), match)
    if small:
        pieces = rows.select("*", F.explode(_pieces(F.col("__text"), match, sizes)).alias("__key"))
        return pieces.join(F.broadcast(index), "__key").where(found).select(*kept, *own)
    rows = rows.withColumn("__row", F.monotonically_increasing_id())
    pieces = rows.select("__row", F.explode(_pieces(F.col("__text"), match, sizes)).alias("__key"))
    met = pieces.join(index, "__key").select("__row", *own)
    return rows.join(met, "__row").where(found).select(*kept, *own)


def tags_of(found: DataFrame, by: list[str], tag: str, place: str) -> DataFrame:
    """Per row (``by``): ``tags``, its tags in the order of ``place``, each once."""
    first = found.groupBy(*by, tag).agg(F.min(place).alias("__place"))
    ordered = F.array_sort(F.collect_list(F.struct("__place", F.col(tag).alias("tag"))))
    return first.groupBy(*by).agg(F.transform(ordered, lambda x: x["tag"]).alias("tags"))


def first_of(found: DataFrame, by: list[str], label: str, place: str) -> DataFrame:
    """Per row (``by``): the label of the first rule by ``place``, ties by label."""
    return found.groupBy(*by).agg(F.min_by(label, F.struct(place, label)).alias(label))

