"""Run registered queries against their SQL on one data folder: check_oracles.py FOLDER [name …]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

from demesne.queries import ORACLES, QUERIES  # noqa: E402
from demesne.queries.registry import TABLES  # noqa: E402
from demesne.session import local_session  # noqa: E402


def norm(v):
    if v is None:
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return f"{v:.9g}" if type(v).__name__ == "Decimal" else str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, folder):
    df = QUERIES[name](spark, folder)
    got = rows_of(df.columns, df.collect())
    if name not in ORACLES:
        return f"rows only ({len(got)})", df.schema
    rel = con.sql(ORACLES[name])
    cols = list(rel.columns)
    if sorted(cols) != sorted(df.columns):
        return f"COLUMNS differ: {sorted(set(cols) ^ set(df.columns))}", None
    want = rows_of(cols, rel.fetchall())
    if got == want:
        types = dict(zip(cols, [str(x) for x in rel.types]))
        spark_types = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "date": "DATE"}
        odd = {c: (k, types[c]) for c, k in df.dtypes if spark_types.get(k) != types[c] and not (k.startswith("timestamp") and types[c].startswith("TIMESTAMP"))}
        return f"ok ({len(got)})" + (f" TYPES {odd}" if odd else ""), None
    a, b = set(got) - set(want), set(want) - set(got)
    cols = sorted(cols)
    return f"DIFFER {len(got)}/{len(want)} cols={cols}\n    spark  {sorted(a)[:2]}\n    oracle {sorted(b)[:2]}", None


if __name__ == "__main__":
    folder = sys.argv[1]
    spark = local_session("8")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad = 0
    for name in sys.argv[2:] or QUERIES:
        if name.endswith("*"):
            continue
        start = time.time()
        try:
            result, _ = compare(spark, con, name, folder)
        except Exception as exc:
            result = f"FAILED {type(exc).__name__}: {str(exc)[:700]}"
        bad += not result.startswith(("ok", "rows"))
        print(f"{name:34s} {time.time() - start:6.2f}s {result}", flush=True)
    print("bad:", bad)
