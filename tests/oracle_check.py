"""Compares a query's rows with DuckDB's: python tests/oracle_check.py FOLDER [NAME...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 5)
        return v

    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, name, query, sql, sf_dir):
    """None if both give the same, else what differs."""
    import duckdb

    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    df = query(spark, str(sf_dir))
    names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_names, want = rows_of([c[0] for c in cur.description], cur.fetchall())
    if names != want_names:
        return f"columns {names} and {want_names}"
    if got != want:
        extra, missing = [r for r in got if r not in set(want)][:3], [r for r in want if r not in set(got)][:3]
        return f"{len(got)} and {len(want)} rows; only here {extra}; only there {missing}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:] or len(sys.argv) <= 2 and (name.startswith("op") or name == "pipeline"):
            continue
        began = time.time()
        try:
            said = compare(spark, name, query, sqls[name], sys.argv[1]) if name in sqls else f"rows only: {query(spark, sys.argv[1]).count()}"
        except Exception as e:  # noqa: BLE001
            said = "error " + str(e)[:600].replace("\n", " ")
        print(f"{name}: {said or 'same'} ({time.time() - began:.1f} s)", flush=True)
