"""Compare registered queries with their SQL, value by value and type by type."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

SPARK_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def spark_rows(df):
    names = sorted(df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    types = {n: SPARK_TYPES.get(t, t.upper()) for n, t in types.items()}
    return names, types, Counter(tuple(normal(r[n]) for n in names) for r in df.collect())


def duck_rows(con, sql):
    cursor = con.execute(sql)
    described = [(d[0], str(d[1])) for d in cursor.description]
    names = sorted(n for n, _ in described)
    place = {n: i for i, (n, _) in enumerate(described)}
    rows = Counter(tuple(normal(r[place[n]]) for n in names) for r in cursor.fetchall())
    return names, dict(described), rows


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def differences(spark, con, sf_dir, build, sql):
    """None if equal, else a description; and the row count."""
    names, types, rows = spark_rows(build(spark, sf_dir))
    other_names, other_types, other_rows = duck_rows(con, sql)
    n = sum(rows.values())
    if names != other_names:
        return f"columns {names} != {other_names}", n
    wrong = {c: (types[c], other_types[c]) for c in names if types[c].replace(" ", "") != other_types[c].replace(" ", "")}
    if wrong:
        return f"types differ: {wrong}", n
    if rows != other_rows:
        only = list((rows - other_rows).items())[:2]
        missing = list((other_rows - rows).items())[:2]
        return f"rows {n} != {sum(other_rows.values())} or values differ: {names}\n  spark {only}\n  sql   {missing}", n
    return None, n


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from wickwork.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    only = sys.argv[2:]
    session = build_session(
        "parity", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    folder = f"/root/testdata/sf{sf}"
    db = connect(folder)
    sqls = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            message, count = differences(session, db, folder, build, sqls[name])
        except Exception as error:  # noqa: BLE001
            message, count = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += message is not None
        print(f"{'ok  ' if message is None else 'FAIL'} {name} rows={count} {time.time() - started:.2f}s", message or "")
    print("failed:", bad)
