"""Run registered queries and their SQL side by side: `python tests/compare.py [sf_dir] [name ..]`."""

from __future__ import annotations

import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    """A value both engines print alike, with its kind kept apart."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return f"b:{value}"
    if isinstance(value, Decimal):
        return f"d:{value}"
    if isinstance(value, datetime):
        return f"t:{value.isoformat(sep=' ')}"
    if isinstance(value, date):
        return f"D:{value}"
    if isinstance(value, float):
        return f"f:{value!r}"
    return f"{type(value).__name__}:{value}"


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def expected(con, sql: str):
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    return names, cursor.fetchall()


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def mismatch(df, names, rows) -> str | None:
    got_names, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    want_names, want = canonical(names, rows)
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        extra = [r for r in got if r not in set(want)][:2]
        missing = [r for r in want if r not in set(got)][:2]
        return f"{len(got)} rows != {len(want)}; only here {extra}; only there {missing}"
    for g, w in zip(got, want):
        if g != w:
            return f"{g} != {w}"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as e
    from pyspark.sql import SparkSession

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), e.oracle_sql()
    failed = 0
    for name, query in e.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        begun = time.time()
        try:
            df = query(spark, sf_dir)
            problem = mismatch(df, *expected(con, sql[name])) if name in sql else None
            n = df.count()
        except Exception as err:  # report and go on
            problem, n = f"{type(err).__name__}: {str(err)[:700]}", -1
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:24} {n:8} rows "
              f"{time.time() - begun:6.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
