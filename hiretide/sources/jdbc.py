"""Tables of a database over JDBC, for readers that cannot use Parquet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def postgres_options(env: Mapping[str, str]) -> dict[str, str]:
    """Reader and writer options from the usual POSTGRES_* settings."""
    return {"url": f"jdbc:postgresql://{env['POSTGRES_HOST']}:{env.get('POSTGRES_PORT', '5432')}/"
                   f"{env['POSTGRES_DB']}",
            "user": env["POSTGRES_USER"], "password": env["POSTGRES_PASSWORD"],
            "driver": "org.postgresql.Driver"}


@dataclass(frozen=True)
class Split:
    """How a table is read by many tasks: ranges of a number, date or time column between bounds.
    Rows beyond the bounds are in the first and the last range."""

    column: str
    lower: str
    upper: str
    tasks: int

    def options(self) -> dict[str, str]:
        return {"partitionColumn": self.column, "lowerBound": self.lower,
                "upperBound": self.upper, "numPartitions": str(self.tasks)}


def read_table(spark: SparkSession, table: str, options: Mapping[str, str],
               split: Split | None) -> DataFrame:
    """A database table; ``split=None``, for small tables alone, reads it in one task."""
    more = split.options() if split else {}
    return spark.read.format("jdbc").options(**options, **more).option("dbtable", table).load()


def export_table(df: DataFrame, table: str, options: Mapping[str, str],
                 connections: int = 8) -> None:
    """Replace the rows of a database table; run again after a failure, it ends the same.

    The frame is worked out by as many tasks as it has and then dealt to the connections. Readers
    see an empty table meanwhile: export under another name and rename it where that matters.
    """
    _write(df, table, options, connections).mode("overwrite").option("truncate", "true").save()


def _write(df: DataFrame, table: str, options: Mapping[str, str], connections: int):
    return df.repartition(connections).write.format("jdbc").options(**options) \
        .option("numPartitions", str(connections)).option("dbtable", table)


@dataclass(frozen=True)
class JdbcSink:
    """Appends the rows of each batch to tables of a database, with the batch's id.

    At least once: a batch that broke off while it was written is written again, so readers take one
    row of each key (of jobs the event, of trends window and key with the last ``batch_id``).
    """

    options: Mapping[str, str]
    prefix: str = ""
    connections: int = 4

    def append(self, df: DataFrame, table: str, batch_id: int) -> None:
        rows = df.withColumn("batch_id", F.lit(batch_id).cast("long"))
        rows = rows.drop("ingest_date", "bucket", "window_date", "adjust")
        _write(rows, f"{self.prefix}{table}", self.options, self.connections).mode("append").save()


#: Keys of the tables in a database.
KEYS = {"jobs": ("event_id",), "trend_tech": ("window_start", "window_size_sec", "tech"),
        "trend_role": ("window_start", "window_size_sec", "role_category")}
APPLIED = "applied_batches"


def upsert_statements(table: str, stage: str, columns: Sequence[str], keys: Sequence[str], batch_id: int,
                      counts: str, applied: str = APPLIED) -> list[str]:
    """Statements of one transaction that bring a staged batch into its table once: the rows, unless the batch is
    marked as applied, and the mark. ``counts``: what becomes of a count that is there: ``"totals"`` replaces
    it, ``"deltas"`` adds to it, ``"first"`` leaves the row as it is."""
    listed = ", ".join(columns)
    named = f"name = '{table}' AND batch_id = {batch_id}"
    on = ", ".join(keys)
    rest = [c for c in columns if c not in keys]
    if counts == "first" or not rest:
        action = "DO NOTHING"
    else:
        added = {"totals": "excluded.{0}", "deltas": f"{table}.{{0}} + excluded.{{0}}"}[counts]
        action = "DO UPDATE SET " + ", ".join(
            f"{c} = {(added if c == 'count' else 'excluded.{0}').format(c)}" for c in rest)
    return [f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {stage} WHERE NOT EXISTS "
            f"(SELECT 1 FROM {applied} WHERE {named}) ON CONFLICT ({on}) {action}",
            f"INSERT INTO {applied} (name, batch_id) VALUES ('{table}', {batch_id}) ON CONFLICT DO NOTHING"]


@dataclass(frozen=True)
class JdbcUpsert(JdbcSink):
    """Brings each batch into tables with keys exactly once: the batch is staged, whole, in a table of its own by
    the tasks, and then one transaction takes it over and marks it as applied. A batch that is written again,
    broken off where it may, finds its mark or is staged anew. The database has the tables (with ``KEYS`` as
    primary keys) and ``applied_batches (name, batch_id)``, both its key. ``counts``: see
    ``upsert_statements``; of jobs the first row stays."""

    counts: str = "deltas"

    def append(self, df: DataFrame, table: str, batch_id: int) -> None:
        rows = df.drop("ingest_date", "window_date", "adjust", "batch_id")
        name, stage = f"{self.prefix}{table}", f"{self.prefix}{table}_stage"
        _write(rows, stage, self.options, self.connections).mode("overwrite").save()
        self.execute(df.sparkSession, upsert_statements(
            name, stage, rows.columns, KEYS[table], batch_id, "first" if table == "jobs" else self.counts,
            f"{self.prefix}{APPLIED}"))

    def execute(self, spark: SparkSession, statements: Sequence[str]) -> None:
        """Run statements as one transaction."""
        given = spark._jvm.java.util.Properties()
        for key in ("user", "password"):
            if key in self.options:
                given.setProperty(key, self.options[key])
        connection = spark._jvm.java.sql.DriverManager.getConnection(self.options["url"], given)
        try:
            connection.setAutoCommit(False)
            for statement in statements:
                connection.createStatement().execute(statement)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()
