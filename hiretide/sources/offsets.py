"""Which offsets of a topic have been taken: gaps and overlaps between batches.

A batch is summed up, inside its tasks first, as a range per topic and partition: first and last offset, and how many
rows there were. The ranges of all batches, few beside the rows, are laid end to end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

#: Columns of a row from a topic that say where it stood.
PLACE = ("topic", "partition", "offset")
RANGES = StructType([StructField("topic", StringType()), StructField("partition", IntegerType()),
                     StructField("first", LongType()), StructField("last", LongType()),
                     StructField("n", LongType())])


def offset_ranges(rows: DataFrame) -> DataFrame:
    """One row per topic and partition of ``rows`` (with the columns ``PLACE``)."""
    return rows.groupBy("topic", "partition").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.count("*").alias("n"))


def offset_audit(ranges: DataFrame) -> DataFrame:
    """What is wrong with ranges of offsets: ``kind``, topic, partition, ``first`` and ``last`` offset, and ``n`` rows.

    ``gap``: offsets between ranges that no range has; ``overlap``: offsets that a range has again;
    ``short``: a range with fewer rows than offsets (of a compacted topic, or one written in transactions, that
    is no loss); ``long``: one with more, which has some of them twice.
    """
    by = Window.partitionBy("topic", "partition").orderBy("first", "last")
    reached = F.max("last").over(by.rowsBetween(Window.unboundedPreceding, -1))
    laid = ranges.withColumn("reached", reached)
    size = F.col("last") - F.col("first") + 1
    found = F.array_compact(F.array(
        F.when(F.col("first") > F.col("reached") + 1, F.struct(
            F.lit("gap").alias("kind"), (F.col("reached") + 1).alias("first"), (F.col("first") - 1).alias("last"),
            (F.col("first") - F.col("reached") - 1).alias("n"))),
        F.when(F.col("first") <= F.col("reached"), F.struct(
            F.lit("overlap").alias("kind"), F.col("first"), F.least("last", "reached").alias("last"),
            (F.least("last", "reached") - F.col("first") + 1).alias("n"))),
        F.when(F.col("n") < size, F.struct(F.lit("short").alias("kind"), "first", "last", (size - F.col("n")).alias("n"))),
        F.when(F.col("n") > size, F.struct(F.lit("long").alias("kind"), "first", "last", (F.col("n") - size).alias("n")))))
    return laid.select("topic", "partition", F.explode(found).alias("f")).select(
        "f.kind", "topic", "partition", "f.first", "f.last", "f.n")
