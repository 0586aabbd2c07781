"""Run registered queries beside their SQL and compare: ``python check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

from suite import registry
from vacancia.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, (int, float)):
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def table(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    registry.load()
    names = args or list(registry.QUERIES)
    spark = local_session(8)
    con = duck(sf_dir)
    bad = []
    for name in names:
        t0 = time.time()
        try:
            df = registry.QUERIES[name](spark, sf_dir)
            got_cols, got = table([tuple(r) for r in df.collect()], df.columns)
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(e)[:1500]}", flush=True)
            bad.append(name)
            continue
        t1 = time.time()
        note = ""
        if name in registry.ORACLES:
            try:
                cur = con.execute(registry.ORACLES[name])
                cols = [c[0] for c in cur.description]
                want_cols, want = table(cur.fetchall(), cols)
            except Exception as e:  # noqa: BLE001
                print(f"FAIL {name}: sql error {str(e)[:1500]}", flush=True)
                bad.append(name)
                continue
            if got_cols != want_cols:
                note = f"columns differ {set(got_cols) ^ set(want_cols)}"
            elif got != want:
                a, b = set(got), set(want)
                note = f"rows {len(got)} vs {len(want)}; only spark {len(a - b)}, only sql {len(b - a)}"
                for x in sorted(a - b)[:2]:
                    print("   spark:", dict(zip(got_cols, x)))
                for x in sorted(b - a)[:2]:
                    print("   sql:  ", dict(zip(got_cols, x)))
        else:
            note = "" if got else "no rows"
        state = "FAIL" if note else ("ok  " if name in registry.ORACLES else "rows")
        if note:
            bad.append(name)
        print(f"{state} {name}: {len(got)} rows, {t1 - t0:.2f}s spark, {time.time() - t1:.2f}s sql {note}", flush=True)
    print(f"{len(names) - len(bad)}/{len(names)} good; bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
