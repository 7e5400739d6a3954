"""Run registered queries beside their SQL twins.  ``python -m tests.parity DIR [names...]``."""

from __future__ import annotations

import math
import sys
import tempfile
import time
import traceback

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, fn, sql, sf_dir) -> str | None:
    """None when equal, else a short description of the difference."""
    df = fn(spark, sf_dir)
    names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    columns = [d[0] for d in rel.description]
    names2, want = rows_of(columns, rel.fetchall())
    if names != names2:
        return f"columns {names} != {names2}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        parts = [(n, x, y) for n, x, y in zip(names, g, w) if x != y]
        return f"{len(bad)} rows differ, first: {parts[:4]} in {g[:6]}"
    return None if got else "empty"


def main(argv: list[str]) -> int:
    import __spark_entry__ as e
    from wayfold.session import build_session

    sf_dir, only = argv[0], argv[1:]
    conf = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="parity-")}
    spark = build_session("parity", "local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(sf_dir), []
    queries, oracles = e.queries(), e.oracle_sql()
    for name, fn in queries.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, fn, oracles[name], sf_dir)
            else:
                n = len(fn(spark, sf_dir).collect())
                problem = None if n else "empty"
        except Exception as exc:  # report and go on with the next query
            problem = f"{type(exc).__name__}: {str(exc)[:900]}"
            if only:
                traceback.print_exc()
        kind = "D" if name in oracles else "R"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {name} {time.time() - start:.1f}s {problem or ''}",
              flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
