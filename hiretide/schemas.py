"""Declared schemas: nothing is inferred, unknown JSON fields are ignored."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DateType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType)


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


POSTING = StructType(_strings("company", "title", "location", "description", "url"))

EVENT = StructType(_strings("event_id", "ingested_at", "source")
                   + [StructField("posting", POSTING)])

JOBS = StructType(
    _strings("event_id")
    + [StructField("ingested_at", TimestampType())]
    + _strings("company", "title", "location", "seniority", "role_category", "description", "url")
    + [StructField("techs", ArrayType(StringType(), containsNull=False))])

# Columns of a stored job: the day is the partition.
STORED_JOBS = StructType(JOBS.fields + [StructField("ingest_date", DateType())])

REJECTS = StructType(_strings("raw"))


def trend(key: str) -> StructType:
    return StructType([
        StructField("window_start", TimestampType()), StructField("window_end", TimestampType()),
        StructField("window_size_sec", IntegerType()), StructField(key, StringType()),
        StructField("count", LongType())])


TREND_TECH = trend("tech")
TREND_ROLE = trend("role_category")
