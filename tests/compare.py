"""Run registered queries beside their SQL twins.

    python tests/compare.py [name ...]
"""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from terrafold.plans import catalog  # noqa: E402
from terrafold.plans.inputs import TABLES  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"


def connect():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return con


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    def cell(v):
        if isinstance(v, bool) or v is None:
            return str(v)
        if isinstance(v, (int, float)):
            return repr(float(v)) if v == v else "nan"
        return str(v)
    return [names[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql):
    cur = con.execute(sql)
    return canonical([d[0] for d in cur.description], cur.fetchall())


def first_difference(got, want):
    if got[0] != want[0]:
        return f"columns {got[0]} against {want[0]}"
    if got[1] == want[1]:
        return None
    extra = sorted(set(got[1]) - set(want[1]))[:3]
    lost = sorted(set(want[1]) - set(got[1]))[:3]
    return f"{len(got[1])} rows against {len(want[1])}; only here {extra}; only in twin {lost}"


def main(names):
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect()
    oracles = catalog.oracles()
    bad = 0
    for name, fn in catalog.queries().items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            got = spark_rows(fn(spark, SF_DIR))
            sec = time.time() - t0
            note = "rows only" if name not in oracles else first_difference(
                got, oracle_rows(con, oracles[name])) or "ok"
            rows = len(got[1])
        except Exception as e:  # noqa: BLE001
            sec, rows, note = time.time() - t0, -1, f"{type(e).__name__}: {str(e)[:600]}"
        bad += note not in ("ok", "rows only")
        print(f"{name:28s} {rows:7d} {sec:6.2f}s {note}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
