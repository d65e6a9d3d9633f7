"""Run registered queries next to their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def normal(value):
    if value is None:
        return "~"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


def compare(spark, connection, folder, query, sql) -> tuple[bool, str]:
    began = time.time()
    frame = query(spark, folder)
    got = [tuple(r) for r in frame.collect()]
    took = time.time() - began
    if sql is None:
        return True, f"{len(got)} rows, no SQL ({took:.1f}s)"
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    want = result.fetchall()
    spark_types = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    if sorted(columns) != sorted(frame.columns):
        return False, f"columns {sorted(frame.columns)} != {sorted(columns)}"
    a, b = rows_of(got, frame.columns), rows_of(want, columns)
    if a == b:
        duck_types = {r[0]: r[1] for r in connection.execute(f"describe {sql}").fetchall()}
        odd = [f"{n}:{spark_types[n]}/{duck_types[n]}" for n in columns
               if PAIRS.get(spark_types[n]) != duck_types[n]]
        return not odd, f"{len(a)} rows ({took:.1f}s) {'TYPES ' + str(odd) if odd else ''}"
    only_a = [r for r in a if r not in set(b)][:2]
    only_b = [r for r in b if r not in set(a)][:2]
    return False, f"{len(a)} vs {len(b)} rows; spark only {only_a}; sql only {only_b}"


PAIRS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


if __name__ == "__main__":
    from tradewind.session import build
    import __spark_entry__ as E
    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark = build("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                 "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    sqls, failed = E.oracle_sql(), []
    for name, query in E.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            good, note = compare(spark, connection, folder, query, sqls.get(name))
        except Exception as problem:  # report and go on to the next query
            good, note = False, f"{type(problem).__name__}: {str(problem)[:700]}"
        if not good:
            failed.append(name)
        print("ok  " if good else "FAIL", name, note, flush=True)
    print("failed:", failed)
