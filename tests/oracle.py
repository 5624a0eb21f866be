"""Compare a Spark result with the rows DuckDB gives for a query's SQL."""

import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


def spark_rows(df):
    names = sorted(df.columns)
    return names, _sorted(tuple(r) for r in df.select(*names).collect())


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), _sorted(tuple(r[i] for i in order) for r in cursor.fetchall())


def difference(df, con, sql):
    """None if equal, else what differs first."""
    names, got = spark_rows(df)
    wanted_names, wanted = sql_rows(con, sql)
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if len(got) != len(wanted):
        return f"{len(got)} rows != {len(wanted)}"
    for g, w in zip(got, wanted):
        if g != w:
            return f"{g} != {w}"
    return None
