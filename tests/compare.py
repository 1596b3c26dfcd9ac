"""Run registered queries in Spark and DuckDB and compare whole results."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("set threads = 4")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(x):
    if isinstance(x, float):
        if math.isnan(x):
            return "nan"
        if x == 0:
            return 0.0
        return float(f"{x:.12g}")
    return x


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, con, query, statement, sf_dir) -> str | None:
    """None when equal, else a short description of the first difference."""
    df = query(spark, sf_dir)
    got_cols, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(statement)
    want_cols, want = _rows([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    if not got:
        return "no rows on either side"
    for g, w in zip(got, want):
        if g != w:
            bad = [
                (c, a, b) for c, a, b in zip(got_cols, g, w) if a != b or type(a) is not type(b)
            ]
            return f"first difference {bad} in row {g}"
        kinds = [
            (c, type(a).__name__, type(b).__name__)
            for c, a, b in zip(got_cols, g, w)
            if type(a) is not type(b)
        ]
        if kinds:
            return f"types differ {kinds}"
    return None


def main(sf: str, names: list[str]) -> int:
    sys.path.insert(0, "/root/repo")
    from __spark_entry__ import oracle_sql, queries
    from hearthscore.session import local_session

    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session("8"), duck(sf_dir)
    all_queries, oracle = queries(), oracle_sql()
    bad = 0
    for name in names or list(all_queries):
        start = time.time()
        try:
            if name in oracle:
                note = compare(spark, con, all_queries[name], oracle[name], sf_dir)
                kind = "sql"
            else:
                n = len(all_queries[name](spark, sf_dir).collect())
                note, kind = (None if n else "no rows"), f"rows={n}"
        except Exception as exc:  # report and go on with the next query
            note, kind = f"{type(exc).__name__}: {str(exc)[:1500]}", "error"
        bad += note is not None
        print(f"{'ok  ' if note is None else 'FAIL'} {name} [{kind}] {time.time() - start:.1f}s"
              + (f"\n     {note[:1800]}" if note else ""), flush=True)
    print(f"{bad} failures")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 1))
