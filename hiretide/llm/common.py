"""What the operators share: scratch tables in the shared folder, and typed Arrow maps."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from hiretide.llm.words import text_bytes
from hiretide.sources.folders import scratch


#: Rows of long texts go to Python workers in batches of so many bytes.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: lineage ends here, so a lost
    executor costs a read and not the work before it."""
    path = f"{scratch(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def code_path(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package from where the driver has it; a
    cluster installs it, or gets it by ``--py-files``. Batches that go to them are bounded by bytes, unless
    the session has a bound of its own."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (known, root)))
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[list]],
              fields: list[tuple[str, T.DataType]]) -> DataFrame:
    """``fn`` gives lists of columns (Arrow arrays or Python lists) for each batch."""
    code_path(df.sparkSession)
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in fn(batch):
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                     for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)


def by_bytes(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` in which ``column`` has about ``most`` bytes, one row at least."""
    if not batch.num_rows:
        return
    _, ends = text_bytes(batch.column(column))
    part = ends[:-1] // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def type_of(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType
