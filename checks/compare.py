"""Run registered queries next to their SQL twins in DuckDB: `python -m checks.compare [sf] [names...]`."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from acreage.session import build_session
from checks import registry
from checks.base import TABLES

ROOT = "/root/testdata"
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "smallint": "SMALLINT",
    "float": "FLOAT", "boolean": "BOOLEAN",
}


def local_session() -> SparkSession:
    return build_session(
        "checks", "local[8]", **{
            "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false",
            "spark.sql.codegen.cache.maxEntries": "1000",
        }
    )


def sort_key(row: tuple) -> tuple:
    return tuple((v is None, "" if v is None else (f"{v + 0.0:.9g}" if isinstance(v, float) else str(v))) for v in row)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, folder: str) -> str:
    df = registry.queries()[name](spark, folder)
    started = time.time()
    rows = [tuple(x) for x in df.collect()]
    took = time.time() - started
    twin = registry.oracles().get(name)
    if twin is None:
        return f"rows  {name}: {len(rows)} rows, {took:.2f}s"
    found = con.execute(twin)
    columns = [d[0] for d in found.description]
    kinds = {d[0]: str(d[1]) for d in found.description}
    other = found.fetchall()
    problems = []
    if sorted(df.columns) != sorted(columns):
        return f"FAIL  {name}: columns {sorted(df.columns)} / {sorted(columns)}"
    for field in df.schema.fields:
        mine = KINDS.get(field.dataType.simpleString(), field.dataType.simpleString())
        if mine != kinds[field.name]:
            problems.append(f"type of {field.name}: {mine} / {kinds[field.name]}")
    order = sorted(columns)
    mine = sorted((tuple(r[df.columns.index(c)] for c in order) for r in rows), key=sort_key)
    theirs = sorted((tuple(r[columns.index(c)] for c in order) for r in other), key=sort_key)
    if len(mine) != len(theirs):
        problems.append(f"rows {len(mine)} / {len(theirs)}")
    else:
        bad = [(a, b) for a, b in zip(mine, theirs, strict=True) if not same(a, b)]
        if bad:
            problems.append(f"{len(bad)} rows differ in {order}, first {bad[0]}")
    if problems:
        return f"FAIL  {name}: " + "; ".join(problems)
    return f"ok    {name}: {len(mine)} rows, {took:.2f}s"


def same(a: tuple, b: tuple) -> bool:
    for x, y in zip(a, b, strict=True):
        if isinstance(x, float) and isinstance(y, float):
            if x != y and not (math.isnan(x) and math.isnan(y)):
                return False
            if x == 0 and math.copysign(1, x) != math.copysign(1, y):
                return False  # a hash of the text would tell the zeros apart
        elif x != y:
            return False
    return True


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    folder = f"{ROOT}/sf{sf}"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    names = [n for n in registry.queries() if not wanted or any(w in n for w in wanted)]
    failed = 0
    for name in names:
        try:
            line = compare(spark, con, name, folder)
        except Exception as error:  # report and go on with the next query
            line = f"FAIL  {name}: {type(error).__name__} {str(error)[:600]}"
        failed += line.startswith("FAIL")
        print(line, flush=True)
    print(f"{len(names)} queries, {failed} failed")
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
