"""Compares registered queries with their SQL: python -m tests.compare FOLDER [query ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

import __spark_entry__ as entry

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
NUMBERS = {"tinyint": "int", "smallint": "int", "integer": "int", "int": "int",
           "bigint": "bigint", "hugeint": "hugeint", "double": "double", "float": "float",
           "varchar": "string", "string": "string", "boolean": "boolean"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(folder, f"{t}.parquet").exists():
            part = f"{folder}/{t}.parquet" + ("/*.parquet" if Path(folder, f"{t}.parquet").is_dir() else "")
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{part}')")
    return con


def normal(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def differences(spark, con, folder: str, name: str, show: int = 3) -> list[str]:
    """Empty if columns, types and values agree."""
    df = QUERIES[name](spark, folder)
    cur = con.execute(ORACLE[name])
    cols = sorted(df.columns)
    theirs = {d[0]: str(d[1]).lower() for d in cur.description}
    if sorted(theirs) != cols:
        return [f"columns {cols} / {sorted(theirs)}"]
    found = []
    for c, t in df.dtypes:
        if NUMBERS.get(theirs[c], theirs[c]) != t and theirs[c] != "number":
            found.append(f"type of {c}: {t} / {theirs[c]}")
    order = [d[0] for d in cur.description]
    a = sorted((tuple(normal(r[c]) for c in cols) for r in df.collect()), key=repr)
    b = sorted((tuple(normal(r[order.index(c)]) for c in cols) for r in cur.fetchall()), key=repr)
    if len(a) != len(b):
        found.append(f"rows {len(a)} / {len(b)}")
    if a != b:
        only_a, only_b = list(set(a) - set(b)), list(set(b) - set(a))
        found.append(f"values differ in {len(only_a)} / {len(only_b)} rows")
        for rows, side in ((only_a, "spark"), (only_b, "sql")):
            found += [f"  {side} {dict(zip(cols, r))}" for r in sorted(rows, key=repr)[:show]]
    return found


def main() -> None:
    from assayline.session import local_session
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    con = connect(folder)
    bad = 0
    for name in names:
        if name not in ORACLE:
            print(f"{name}: no SQL")
            continue
        start = time.time()
        try:
            found = differences(spark, con, folder, name)
        except Exception as e:
            found = [f"{type(e).__name__}: {str(e)[:800]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s", flush=True)
        for line in found:
            print("    " + line[:700], flush=True)
    print(f"{len(names)} queries, {bad} differ; without SQL: {sorted(set(QUERIES) - set(ORACLE))}")


if __name__ == "__main__":
    main()
