"""Runs registered queries against their SQL: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(path: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet')")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return 0.0 if v == 0 else v
    if hasattr(v, "tolist"):
        return plain(v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if type(v).__name__ == "Decimal":
        return float(v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def kind(t: str) -> str:
    t = t.lower()
    for k, names in {"int": ("bigint", "int", "long", "short", "hugeint"), "float": ("double", "float", "decimal")}.items():
        if any(t.startswith(n) for n in names):
            return k
    return "text" if t in ("string", "varchar") else t.split("(")[0].split("<")[0]


def compare(spark, con, name: str, path: str) -> tuple[str, int]:
    from query_catalogue import ORACLE, QUERIES

    df = QUERIES[name](spark, path)
    got = rows_of(df.columns, df.collect())
    if name not in ORACLE:
        return ("rows only" if got else "EMPTY"), len(got)
    rel = con.sql(ORACLE[name])
    names, types, want_rows = list(rel.columns), [str(t) for t in rel.types], rel.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} != {sorted(names)}", len(got)
    spark_types = dict(df.dtypes)
    bad = [f"{n}: {spark_types[n]} / {t}" for n, t in zip(names, types) if kind(spark_types[n]) != kind(t)]
    want = rows_of(names, want_rows)
    if bad:
        return f"TYPES {bad}", len(got)
    if got != want:
        diff = [(g, w) for g, w in zip(got, want) if g != w][:2]
        return f"ROWS {len(got)} / {len(want)} first {str(diff)[:600]}", len(got)
    return ("ok" if got else "EMPTY"), len(got)


def main(argv: list[str]) -> int:
    from atlasloom.session import local_session
    from query_catalogue import QUERIES

    path = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = [n for n in QUERIES if not argv[1:] or any(n.startswith(a) for a in argv[1:])]
    spark, con, failed = local_session(), duck(path), 0
    for n in wanted:
        t = time.time()
        try:
            verdict, rows = compare(spark, con, n, path)
        except Exception as e:
            verdict, rows = "ERROR " + str(e)[:700] + "\n" + traceback.format_exc().splitlines()[-1][:100], 0
        good = verdict in ("ok", "rows only")
        failed += not good
        print(f"{'  ' if good else '!!'} {n:34s} {rows:8d} {time.time() - t:6.1f}s  {verdict}", flush=True)
        spark.catalog.clearCache()
    print(f"{len(wanted) - failed} of {len(wanted)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1:])))
