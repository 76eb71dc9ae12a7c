"""Side-by-side check of registered queries against their SQL in DuckDB."""
from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(cell(x) for x in v)
    return v


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(cell(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(df, con, sql) -> tuple[bool, str]:
    names, rows = normal(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    onames, orows = normal([d[0] for d in cur.description], cur.fetchall())
    if names != onames:
        return False, f"columns {names} != {onames}"
    if len(rows) != len(orows):
        return False, f"rows {len(rows)} != {len(orows)}"
    bad = [(a, b) for a, b in zip(rows, orows) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    if bad:
        return False, f"{len(bad)} of {len(rows)} rows differ, first {names}\n   {bad[0][0]}\n   {bad[0][1]}"
    return len(rows) > 0, f"{len(rows)} rows"


def main(argv):
    sys.path.insert(0, ".")
    from tests.session import get_spark
    from panelflume.registry import QUERIES
    sf_dir = f"/root/testdata/{argv[0]}"
    spark, con, failed = get_spark(), connect(sf_dir), []
    wanted = [n for n in QUERIES if not argv[1:] or any(n.startswith(p) for p in argv[1:])]
    for name in wanted:
        t = time.time()
        try:
            if QUERIES[name].sql:
                ok, note = compare(QUERIES[name].run(spark, sf_dir), con, QUERIES[name].sql)
            else:
                ok, note = True, f"{len(QUERIES[name].run(spark, sf_dir).collect())} rows (no SQL)"
        except Exception as err:  # report and go on to the next query
            ok, note = False, f"{type(err).__name__}: {str(err)[:1500]}"
        if not ok:
            failed.append(name)
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - t:.1f}s {note}", flush=True)
    print(f"{len(wanted) - len(failed)} of {len(wanted)} ok; failed: {failed}")


if __name__ == "__main__":
    main(sys.argv[1:])
