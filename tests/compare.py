"""Run registered queries on Spark and DuckDB over the same files and compare the rows."""

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(root):
    con = duckdb.connect()
    for path in glob.glob(f"{root}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _key(row):
    return tuple((v is not None, "" if v is None else (f"{v:.6f}" if isinstance(v, float) else str(v))) for v in row)


def differences(left, right):
    """First differing rows of two row lists, order ignored."""
    if len(left) != len(right):
        return [("row count", len(left), len(right))]
    out = []
    for a, b in zip(sorted(left, key=_key), sorted(right, key=_key)):
        same = all(
            math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9)
            if isinstance(x, float) and isinstance(y, float)
            else x == y
            for x, y in zip(a, b)
        )
        if not same:
            out.append((a, b))
    return out


def run_pair(spark, con, root, query):
    columns = list(query.out)
    spark_rows = [tuple(r) for r in query(spark, root).select(*columns).collect()]
    sql = f"SELECT {', '.join(columns)} FROM ({query.oracle()}) AS q"
    return spark_rows, con.execute(sql).fetchall()


def main(root, names):
    from tagloom.plans.catalog import load_all
    from tagloom.session import get_session

    spark = get_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(root)
    for name, query in load_all().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if query.sql is None:
                n = len(query(spark, root).collect())
                print(f"rows {name}: {n} ({time.time() - start:.1f}s)", flush=True)
                continue
            left, right = run_pair(spark, con, root, query)
            diff = differences(left, right)
            types = [(type(a), type(b)) for a, b in zip(left[0], right[0]) if type(a) is not type(b)] if left and right else []
            state = "OK  " if not diff else "DIFF"
            print(f"{state} {name}: {len(left)} rows ({time.time() - start:.1f}s) {types or ''}", flush=True)
            for d in diff[:3]:
                print("   ", str(d)[:600])
        except Exception as e:  # report and go on with the next query
            print(f"FAIL {name}: {type(e).__name__} {str(e)[:700]}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], set(sys.argv[2:]))
