"""Repeated passages of lines, found as content-defined chunks, compared by bytes and removed but for the first.

A hash rolls over a text's lines with a word, two lines wide, and ends a chunk wherever it is 0 modulo
``MEAN_PAIRS``. So the bounds inside a passage are those of its own lines: they are the same wherever the
passage stands and whatever stands around it. Chunks that follow each other share a line, so that each pair
of neighbouring lines is inside one chunk. Of equal chunks that of the first text, by id and place, stays and
the others go. What no copy of a chunk holds, at the ends of a passage and in passages shorter than a
chunk, is then looked at in the least chunks there are, pairs of neighbouring lines, in the same way.

Chunks and pairs are dealt by the SHA-256 of their bytes; each that is to go is then compared with the first one
byte by byte, and stays if it differs. Built from DataFrame functions alone. Text crosses the network
to be put together again, once more to fetch the bytes of first ones where their places are too many to be sent
to every task, and so do the bytes that go; everything else is 32 bytes a pair and chunk, and copies of a
hash are merged inside each task first. The places that go are a table in the shared folder.

Null text has no lines and stays null; empty texts and texts of one line stay. A single line that repeats
stays, unless with a neighbour; lines without a word go with the lines about them. Rows of one id and
text are one document and lose the same lines; rows of one id and other text lose what is repeated in theirs.
Rows without an id stay as they are and make nothing a repeated one. Each line that goes stands in an earlier text, or
earlier in its own. A text of any length is one row. Only id and text are looked at; other columns ride
along, whatever their names. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hiretide.llm.common import stored

MEAN_PAIRS = 4  # pairs of neighbouring lines in a chunk
MULTIPLIER, MODULUS = 31, 1_000_003


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def _with_lines(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with ``__lines`` of ``text`` and ``__solid``, the places of lines with a word."""
    # One column a step: an array used more than once is then worked out once.
    rows = df.withColumn("__lines", F.split(text, "\n", -1))
    return rows.withColumn("__solid", F.filter(
        F.sequence(F.lit(0), F.size("__lines") - 1), lambda i: F.get("__lines", i).rlike(r"[^ \t\n\x0B\f\r]")))


def _bytes_of(at: Column, n: Column | int) -> Column:
    """The text of ``n`` pairs of lines from pair ``at`` on; null beyond the last."""
    first, last = F.get("__solid", at), F.get("__solid", at + n)
    return F.array_join(F.slice(F.col("__lines"), first + 1, last - first + 1), "\n")


def with_chunks(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with ``__chunks``: per chunk of ``text`` its first pair ``at``, its number of pairs ``n``, its
    ``hash``, and those of its ``pairs``."""
    names = df.columns
    rows = _with_lines(df, text)
    ahead = F.slice("__solid", 2, F.greatest(F.size("__solid") - 1, F.lit(0)))
    rows = rows.withColumn("__hashes", F.transform(ahead, lambda _, k: F.unhex(_digest(_bytes_of(k, 1)))))
    rows = rows.withColumn("__values", F.transform("__solid", lambda i: F.crc32(F.get("__lines", i))))
    last = F.size("__hashes") - 1
    rolling = lambda k: (F.get("__values", k) * MULTIPLIER + F.get("__values", k + 1)) % MODULUS
    rows = rows.withColumn("__ends", F.when(last >= 0, F.filter(
        F.sequence(F.lit(0), last), lambda k: (k == last) | (rolling(k) % MEAN_PAIRS == 0))))
    begin = F.transform("__ends", lambda end, k: F.when(k > 0, F.get("__ends", k - 1) + 1).otherwise(0))
    rows = rows.withColumn("__parts", F.arrays_zip(begin.alias("begin"), F.col("__ends").alias("end")))

    def chunk(part: Column) -> Column:
        at, n = part["begin"], part["end"] + 1 - part["begin"]
        return F.struct(at.alias("at"), n.alias("n"), F.unhex(_digest(_bytes_of(at, n))).alias("hash"),
                        F.slice("__hashes", at + 1, n).alias("pairs"))

    return rows.select(*names, F.transform("__parts", chunk).alias("__chunks"))


def _first_of_several(places: DataFrame) -> DataFrame:
    """``__hash`` and its first place, for hashes at several places."""
    return places.groupBy("__hash").agg(
        F.count("*").alias("__n"), F.min(F.struct("__id", "__at")).alias("__first")).filter("__n > 1").drop("__n")


def repeated_places(rows: DataFrame) -> DataFrame:
    """Of ``rows`` (__id, __text) the places of chunks and pairs with a hash that an earlier one has: ``__id``, the
    first pair ``__at``, the pairs ``__size`` and the ``__first`` place (id and pair) of the hash."""
    # The outer form: the plain one would filter on the array's size below the steps above, where
    # each element would work the arrays out again.
    chunks = with_chunks(rows, F.col("__text")).select("__id", F.explode_outer("__chunks").alias("__c")).filter(
        F.col("__c").isNotNull()).select("__id", F.col("__c.at").alias("__at"), F.col("__c.n").alias("__size"),
                                         F.col("__c.hash").alias("__hash"), F.col("__c.pairs").alias("__pairs"))
    again = F.coalesce(F.col("__first") != F.struct("__id", "__at"), F.lit(False))
    known = chunks.join(_first_of_several(chunks), "__hash", "left").withColumn("__again", again)
    # The first of equal pairs is in no copy of a chunk, so what is left has the first of each.
    pairs = known.filter(~F.col("__again")).select(
        "__id", "__at", F.posexplode_outer("__pairs").alias("__k", "__hash")).filter(
        F.col("__hash").isNotNull()).select("__id", (F.col("__at") + F.col("__k")).alias("__at"), "__hash")
    pairs = pairs.join(_first_of_several(pairs), "__hash").filter(again)
    wanted = ["__id", "__at", "__size", "__first"]
    return known.filter("__again").select(*wanted).unionByName(
        pairs.withColumn("__size", F.lit(1)).select(*wanted))


def removed_places(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``__id`` and ``__gone``, the places that go (first pair ``at`` and ``n`` pairs) with the bytes of the first one
    there (``text``), for documents that may lose any."""
    rows = df.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    # Written once: what goes is narrow, and is read here for the first ones and again for the others.
    found = stored(repeated_places(rows).select(
        "__id", "__at", "__size", F.col("__first.__id").alias("__first_id"),
        F.col("__first.__at").alias("__first_at")), "repeats")
    place = ["__first_id", "__first_at", "__size"]
    wanted = found.groupBy("__first_id").agg(F.collect_set(F.struct("__first_at", "__size")).alias("__wanted"))
    texts = df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    firsts = texts.join(wanted, F.col("__id") == F.col("__first_id"), "left")
    firsts = _with_lines(firsts, F.when(F.col("__wanted").isNotNull(), F.col("__text")))
    # Rows of one id and other text have other bytes there: any of them may be the first.
    firsts = firsts.select("__first_id", F.explode_outer(F.transform("__wanted", lambda w: F.struct(
        w["__first_at"].alias("__first_at"), w["__size"].alias("__size"),
        _bytes_of(w["__first_at"], w["__size"]).alias("text")))).alias("__w")).select(
        "__first_id", "__w.*").filter(F.col("text").isNotNull())
    return found.join(firsts, place).groupBy("__id").agg(F.collect_set(F.struct(
        F.col("__at").alias("at"), F.col("__size").alias("n"), "text")).alias("__gone"))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                count_col: str | None = None, drop_emptied: bool = False) -> DataFrame:
    """``df`` with repeated passages removed from ``text_col``; with ``count_col``, how many lines went, under
    that name; with ``drop_emptied``, without the rows of whose text only white space is left."""
    gone = removed_places(df, id_col, text_col).withColumnRenamed("__id", "__gone_id")
    plain = df.toDF(*(f"__c{i}" for i in range(len(df.columns))))
    at = df.columns.index(text_col)
    joined = plain.join(gone.hint("shuffle_hash"),
                        F.col(f"__c{df.columns.index(id_col)}") == F.col("__gone_id"), "left")
    named = F.col("__gone").isNotNull()
    kept = _with_lines(joined, F.when(named, F.col(f"__c{at}")))
    # Byte by byte: other text under an equal hash stays, and so does a row of the same id and another text.
    kept = kept.withColumn("__own", F.filter("__gone", lambda g: _bytes_of(g["at"], g["n"]) == g["text"]))
    lines = F.array_distinct(F.flatten(F.transform("__own", lambda g: F.sequence(
        F.get("__solid", g["at"]), F.get("__solid", g["at"] + g["n"])))))
    kept = kept.withColumn("__out", lines)
    changed = F.coalesce(F.size("__out") > 0, F.lit(False))
    rest = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__out"))
    text = F.when(changed, F.array_join(F.transform(rest, lambda i: F.get("__lines", i)), "\n")).otherwise(
        F.col(f"__c{at}"))
    if drop_emptied:
        # Out of a list of one, so that the filter stays above the steps that make the text: pushed
        # below, it would work their arrays out again for each element.
        kept = kept.select("*", F.explode_outer(F.array(text)).alias("__left")).filter(
            ~changed | F.col("__left").rlike(r"\S"))
        text = F.col("__left")
    count = [F.when(changed, F.size("__out")).otherwise(0).cast("long").alias(count_col)] if count_col else []
    return kept.select(*((text if i == at else F.col(f"__c{i}")).alias(n)
                         for i, n in enumerate(df.columns)), *count)
