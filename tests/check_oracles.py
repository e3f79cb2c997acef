"""Run registered queries beside their SQL twins in DuckDB and compare rows, names and types.

    python tests/check_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import importlib
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

# How DuckDB's type names read in Spark.
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DATE": "date",
}


def twin(sf_dir: str, sql: str) -> tuple[list[tuple[str, str]], list[tuple]]:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    relation = con.sql(sql)
    schema = [(c, TYPES.get(str(t), str(t))) for c, t in zip(relation.columns, relation.types)]
    return schema, relation.fetchall()


def normal(rows, names: list[str], order: list[str]) -> list[tuple]:
    places = [names.index(c) for c in order]
    return sorted((tuple(row[p] for p in places) for row in rows), key=repr)


def compare(spark, name: str, query, sql: str | None, sf_dir: str) -> str:
    started = time.monotonic()
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    seconds = time.monotonic() - started
    if sql is None:
        return f"rows  {name}: {len(rows)} rows, {seconds:.1f} s"
    schema, expected = twin(sf_dir, sql)
    if sorted(df.dtypes) != sorted(schema):
        return f"FAIL  {name}: schema {sorted(df.dtypes)} is not {sorted(schema)}"
    order = sorted(df.columns)
    got, want = normal(rows, df.columns, order), normal(expected, [c for c, _ in schema], order)
    if got != want:
        different = [(g, w) for g, w in zip(got, want) if g != w][:3]
        return f"FAIL  {name}: {len(got)} rows against {len(want)}; {different}"
    return f"ok    {name}: {len(rows)} rows, {seconds:.1f} s"


def main() -> None:
    from tabwright.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    entry = importlib.import_module("__spark_entry__")
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        try:
            print(compare(spark, name, queries[name], oracles.get(name), sf_dir), flush=True)
        except Exception as error:  # report and go on with the next query
            print(f"ERROR {name}: {type(error).__name__}: {str(error)[:400]}", flush=True)


if __name__ == "__main__":
    main()
