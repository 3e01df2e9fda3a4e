"""Runs catalogue queries next to their oracles and compares the rows.

    python tools/check_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tideguard.plans import catalogue  # noqa: E402
from tideguard.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def kind(value) -> str:
    return type(value).__name__


def compare(spark, con, name: str, sf_dir: str) -> tuple[str, str]:
    df = catalogue.QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in catalogue.ORACLES:
        return "rows", f"{len(got)} rows"
    cursor = con.execute(catalogue.ORACLES[name])
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return "FAIL", f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return "FAIL", f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w or [kind(x) for x in g] != [kind(x) for x in w]:
            return "FAIL", f"\n   spark  {str(g)[:600]}\n   oracle {str(w)[:600]}"
    return "ok", f"{len(got)} rows"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:] or list(catalogue.QUERIES)
    spark = build_session("check", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            verdict, detail = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            verdict, detail = "ERROR", str(error)[:1500]
        bad += verdict in ("FAIL", "ERROR")
        print(f"{verdict:5} {name:32} {time.time() - start:6.2f}s  {detail}", flush=True)
    print(f"{len(wanted)} queries, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
