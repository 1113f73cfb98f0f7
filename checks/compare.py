"""Run registered queries next to their SQL: ``python -m checks.compare SF_DIR [names...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks import registry
from termpulse.session import make_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    started = time.time()
    df = registry.queries()[name](spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - started
    sql = registry.oracle_sql().get(name)
    if sql is None:
        return True, f"{len(mine)} rows, no SQL, {took:.1f}s"
    started = time.time()
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    theirs = rows_of(columns, cur.fetchall())
    note = f"{len(mine)}/{len(theirs)} rows, {took:.1f}s / {time.time() - started:.1f}s"
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} / {sorted(columns)}"
    if mine != theirs:
        diff = [(a, b) for a, b in zip(mine, theirs) if a != b][:2]
        return False, f"{note} differ: {diff}"
    return True, note


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(registry.queries())
    spark = make_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in names:
        try:
            ok, note = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001 - one broken query must not hide the others
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
