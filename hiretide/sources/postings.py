"""Postings from JSON-lines files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from hiretide.functions.ids import POSTINGS, name_uuid
from hiretide.schemas import POSTING

# Characters taken off both ends of a line.
BLANKS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
          "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")

STRICT = {"allowSingleQuotes": "false"}
BROKEN = "_broken"


def _ends_well(line: Column) -> Column:
    """Whether the text is one whole JSON value.

    A reader stops behind the first value, so the text is read inside a list and inside an object. A
    bracket that closes the one too early is an error in the other, so what passes
    both closes neither, and the list must have one entry.
    """
    listed = F.from_json(F.concat(F.lit("["), line, F.lit("]")), ArrayType(StringType()), STRICT)
    wrapped = F.from_json(
        F.concat(F.lit('{"v":'), line, F.lit("}")), f"v string, {BROKEN} string",
        {**STRICT, "columnNameOfCorruptRecord": BROKEN})
    return F.coalesce((F.size(listed) == 1) & wrapped[BROKEN].isNull(), F.lit(False))


def parse_postings(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split text lines (``value``) into postings and lines that are not JSON.

    Blank lines are dropped. A line of JSON that is no object is a posting
    without fields. ``line`` is the trimmed text; other columns, as ``file``, stay.
    """
    more = [c for c in lines.columns if c != "value"]
    trimmed = lines.select(*more, F.trim("value", F.lit(BLANKS)).alias("line")).where("line <> ''")
    # A list of one exploded: the filters below do not read the JSON again.
    read = trimmed.select(*more, "line", F.explode(F.array(F.struct(
        _ends_well(F.col("line")).alias("whole"),
        F.from_json("line", POSTING, STRICT).alias("posting")))).alias("_read"))
    good = read.where("_read.whole").select(*more, "line", "_read.posting.*")
    return good, read.where("NOT _read.whole").select(*more, "line")


def read_postings(spark: SparkSession, path: str,
                  streaming: bool = False, files: bool = False) -> tuple[DataFrame, DataFrame]:
    """Postings and unreadable lines of JSON-lines files; with ``files``, the ``file`` of each."""
    lines = (spark.readStream if streaming else spark.read).text(path)
    return parse_postings(lines.select("value", F.col("_metadata.file_path").alias("file")) if files else lines)


def write_postings(postings: DataFrame, path: str) -> None:
    """Append postings to a folder as JSON-lines files."""
    postings.select(*POSTING.fieldNames()).write.mode("append").json(path)


#: Into so many parts the copies of a line are dealt before they are numbered.
DEALT = 64


def named_postings(postings: DataFrame, source: str = "jsonl") -> DataFrame:
    """``postings`` read from files (``line``, ``file``) with ``event_id``, an id that follows from source, file, line
    and the how-manieth equal line of the file it is: the same whenever and however often the file is read,
    so that an event published again is the same event. Batch only.

    Equal lines are counted, inside the tasks first, and numbered from their counts: a line that a file
    repeats without end is spread over ``DEALT`` parts.
    """
    columns = postings.columns
    dealt = postings.withColumn("_part", F.pmod(F.monotonically_increasing_id(), F.lit(DEALT)))
    counts = dealt.groupBy(*columns, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*columns).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    spread = placed.repartition(*columns, "_part").select(*columns, F.explode(
        F.sequence(F.col("_before") + 1, F.col("_before") + F.col("_n"))).alias("_again"))
    name = F.concat_ws("\n", F.lit(source), F.col("file"), F.col("_again").cast("string"), F.col("line"))
    return spread.withColumn("event_id", name_uuid(POSTINGS, name)).drop("_again")
