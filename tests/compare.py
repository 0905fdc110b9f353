"""Run a query and its check SQL side by side.

``python tests/compare.py [names...]`` checks the named queries, or all of them.
"""

from __future__ import annotations

import datetime
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if isinstance(value, datetime.datetime | datetime.date):
        return value.isoformat()
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark, con, run, sql: str, sf: str) -> str | None:
    """None if both sides hold the same rows, else a short account of how they differ."""
    df = run(spark, sf)
    got_names, got = _bag(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_names, want = _bag([d[0] for d in cur.description], cur.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if got == want:
        return None
    only_got, only_want = list((got - want).items()), list((want - got).items())
    return (
        f"{sum(got.values())} rows != {sum(want.values())}; {len(only_got)} only here, {len(only_want)} only there"
        f"\n   here : {str(sorted(only_got, key=str)[:2])[:400]}\n   there: {str(sorted(only_want, key=str)[:2])[:400]}"
    )


def main(names: list[str], sf: str = os.environ.get("SF", "/root/testdata/sf0.01")) -> int:
    from __spark_entry__ import oracle_sql, queries
    from hemeroteca.session import local_session

    spark, con, bad = local_session(8), connect(sf), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            sql = oracle_sql().get(name)
            if sql is None:
                verdict = f"{run(spark, sf).count()} rows, no check SQL"
            else:
                verdict = difference(spark, con, run, sql, sf)
        except Exception as failure:  # noqa: BLE001
            verdict = f"{type(failure).__name__}: {str(failure)[:1500]}"
        bad += verdict is not None
        print(f"{'ok  ' if verdict is None else 'DIFF'} {name} {time.time() - started:.1f}s {verdict or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
