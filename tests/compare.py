"""Run registered queries beside their DuckDB text: python -m tests.compare [prefix ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if value is None:
        return "\0null"
    if isinstance(value, float):
        return "\0nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, (list, tuple)):
        return repr([canonical(v) for v in value])
    if isinstance(value, bool):
        return repr(value)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(canonical(row[i]) for i in order) for row in rows
    )


# DuckDB type -> Spark type, for the columns the oracles may produce.
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    started = time.time()
    df = contract.queries()[name](spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - started
    text = contract.oracle_sql().get(name)
    if text is None:
        return True, f"rows-only rows={len(got)} {took:.1f}s"
    relation = con.sql(text)
    want_cols, want = rows_of(relation.columns, relation.fetchall())
    if got_cols != want_cols:
        return False, f"columns {got_cols} != {want_cols}"
    kinds = dict(df.dtypes)
    for column, kind in zip(relation.columns, relation.types):
        if TYPES.get(str(kind), kinds[column]) != kinds[column]:
            return False, f"type of {column}: {kinds[column]} vs {kind}"
        if str(kind) == "HUGEINT" or str(kind).startswith("DECIMAL"):
            return False, f"oracle type of {column}: {kind}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        missing = [r for r in want if r not in set(got)][:3]
        return False, f"rows {len(got)} vs {len(want)}; cols {got_cols} extra {extra} missing {missing}"
    return True, f"match rows={len(got)} {took:.1f}s"


def main(argv: list[str]) -> int:
    from spotloom.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in contract.queries():
        if argv and not any(name.startswith(p) for p in argv):
            continue
        try:
            ok, note = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
