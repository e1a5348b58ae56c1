"""Runs queries and their DuckDB counterparts side by side. Usage: python tests/oracle.py [sf_dir] [name...]"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, (int, str, bytes, datetime.datetime)):
        return v
    return f"{float(v):.9g}" if hasattr(v, "as_tuple") else str(v)


def compare(spark, sf_dir, run, sql):
    """What differs between the two results, or the empty string."""
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    theirs = Counter(tuple(plain(r[i]) for i in order) for r in want.fetchall())
    df = run(spark, sf_dir)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    ours = Counter(tuple(plain(x) for x in r) for r in df.select(*(f"`{names[i]}`" for i in order)).collect())
    if ours == theirs:
        return ""
    return f"{sum(ours.values())} rows and {sum(theirs.values())}; ours {list((ours - theirs).items())[:3]}; theirs {list((theirs - ours).items())[:3]}"


if __name__ == "__main__":
    import __spark_entry__ as entry

    from sievemark.session import local_session

    spark = local_session(int(os.environ.get("ORACLE_CORES", "8")), 4)
    sf_dir, only = (sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"), sys.argv[2:]
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name, run in queries.items():
        if only and name not in only:
            continue
        began = time.time()
        try:
            said = compare(spark, sf_dir, run, oracles[name]) if name in oracles else f"{run(spark, sf_dir).count()} rows, no oracle"
        except Exception as e:  # noqa: BLE001
            said = f"{type(e).__name__}: {str(e)[:400]}"
        print(f"{name:26s} {time.time() - began:5.1f}s {'equal' if not said else said}", flush=True)
