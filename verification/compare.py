"""Run registered queries against their oracle: ``python -m verification.compare SF_DIR [names]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _canonical(rows, order):
    def cell(v):
        if isinstance(v, float):
            return None if math.isnan(v) else float(f"{v:.12g}")
        return v

    data = [tuple(cell(r[i]) for i in order) for r in rows]
    return sorted(data, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(spark, con, name, build, sql, sf_dir) -> tuple[bool, str]:
    started = time.time()
    df = build(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    spark_seconds = time.time() - started
    started = time.time()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    took = f"{len(got)} rows, spark {spark_seconds:.1f}s, oracle {time.time() - started:.1f}s"
    if sorted(names) != sorted(df.columns):
        return False, f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    ours = _canonical(got, [df.columns.index(c) for c in sorted(names)])
    theirs = _canonical(want, [names.index(c) for c in sorted(names)])
    if ours == theirs:
        return True, took
    if len(ours) != len(theirs):
        return False, f"{len(ours)} rows, oracle {len(theirs)}"
    bad = {}
    for a, b in zip(ours, theirs):
        for c, x, y in zip(sorted(names), a, b):
            if x != y:
                bad.setdefault(c, (x, y))
    return False, f"{len(bad)} columns differ, e.g. {list(bad.items())[:5]}"


def main():
    from pyspark.sql import SparkSession

    from verification.catalog import ORACLE, QUERIES

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
             .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    failed = 0
    for name, build in QUERIES.items():
        if only and name not in only:
            continue
        try:
            ok, note = compare(spark, con, name, build, ORACLE[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
