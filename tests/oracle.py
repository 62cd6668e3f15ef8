"""Run registered queries beside their SQL on DuckDB: ``python tests/oracle.py [sf] [name-part ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
ROOT = os.environ.get("TIDEMARK_TESTDATA", "/root/testdata")


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    if isinstance(v, dict):
        return sorted((k, plain(x)) for k, x in v.items())
    return v


TYPE_OF = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE", "float": "FLOAT", "binary": "BLOB",
}


def compare(spark, con, folder: str, name: str, fn, sql: str) -> list[str]:
    """Problems found, [] when the two results are the same multiset of rows."""
    df = fn(spark, folder)
    cols = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in cols) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    rows = cur.fetchall()
    if sorted(names) != cols:
        return [f"columns {cols} vs {sorted(names)}"]
    pos = [names.index(c) for c in cols]
    want = [tuple(plain(r[i]) for i in pos) for r in rows]
    problems = []
    types = {d[0]: str(d[1]) for d in cur.description}
    for c, ty in df.dtypes:
        w = TYPE_OF.get(ty, ty.upper())
        if types[c] != w and not (w.startswith("TIMESTAMP") and types[c].startswith("TIMESTAMP")):
            problems.append(f"type of {c}: spark {ty}, sql {types[c]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} vs {len(want)}")
    a, b = sorted(map(repr, got)), sorted(map(repr, want))
    if a != b:
        sa, sb = set(a), set(b)
        problems.append(f"only spark: {sorted(sa - sb)[:3]} only sql: {sorted(sb - sa)[:3]}")
    if not got:
        problems.append("no rows")
    return problems


def main() -> int:
    from tidemark.queries import load
    from tidemark.session import local_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].replace(".", "").isdigit() else "0.01"
    folder = f"{ROOT}/sf{sf}"
    qs, sqls = load()
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    bad = 0
    for name, fn in qs.items():
        if args and not any(name.startswith(a) for a in args):
            continue
        t = time.time()
        try:
            if name in sqls:
                problems = compare(spark, con, folder, name, fn, sqls[name])
            else:
                n = fn(spark, folder).count()
                problems = [] if n else ["no rows"]
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(problems)
        tag = "ok  " if not problems else "BAD "
        print(tag, name, "" if name in sqls else "(rows only)", f"{time.time() - t:.1f}s", *problems, flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
