"""Folder listing and removal on whatever file system a path names."""

from __future__ import annotations

import atexit
import shutil
import uuid

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern; none if there are none."""
    fs, p = _hadoop(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(p) or []]


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def make(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.mkdirs(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete when it is there: written beside its place and renamed into it. Writing over
    an existing one is an error, so of two writers one fails."""
    fs, p = _hadoop(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(beside)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(p) or not fs.rename(beside, p):
        fs.delete(beside, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _hadoop(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def scratch(spark: SparkSession) -> str:
    """The application's own folder for intermediate tables, which every executor sees: inside the
    folder that ``spark.checkpoint.dir`` names. Unset, a local session takes its warehouse, and leaves
    nothing there when Python ends; elsewhere that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    own = f"hiretide-{spark.sparkContext.applicationId}"
    if root:
        return f"{root.rstrip('/')}/{own}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{own}"
    local = path.removeprefix("file:")
    if local not in _AT_EXIT:
        _AT_EXIT.add(local)
        atexit.register(shutil.rmtree, local, ignore_errors=True)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Remove the application's intermediate tables. Results that have not been written cannot be read then."""
    remove(spark, scratch(spark))


_AT_EXIT: set[str] = set()
