"""Run registered queries against their DuckDB oracles, the way the driver does.

    python tests/oracle_check.py [sf_dir] [name ...]

Compares row count, column names and an order-insensitive hash of the values
(columns sorted by name, doubles rounded).  Prints one line per query.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return repr(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as E
    from capsight.session import local_session
    spark = local_session()
    qs, os_ = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in os_:
            print(f"ROWS {name}: {len(srows)} rows ({ts:.1f}s), no oracle")
            continue
        try:
            res = con.execute(os_[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:600]}")
            bad += 1
            continue
        hs, ls = digest(srows, scols)
        hd, ld = digest(drows, dcols)
        ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows) and hs == hd
        if ok:
            print(f"OK   {name}: {len(srows)} rows ({ts:.1f}s)")
        else:
            bad += 1
            print(f"FAIL {name}: cols {sorted(scols)} vs {sorted(dcols)}; rows {len(srows)} vs {len(drows)}")
            sd, dd = set(ls), set(ld)
            for x in sorted(sd - dd)[:3]:
                print("   spark:", x[:700])
            for x in sorted(dd - sd)[:3]:
                print("   duck :", x[:700])
    print("bad", bad)


if __name__ == "__main__":
    main()
