"""Run queries beside their SQL and report differences. Usage: check_queries.py SF [name ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from quayside.session import local_session  # noqa: E402


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted([tuple(repr(r[i]) for i in order) for r in rows])


def connect(sf_dir):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def compare(spark, con, name, sf_dir):
    """None when equal, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None
    cursor = con.execute(sql)
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if got == want:
        return None
    extra = [r for r in got[1] if r not in set(want[1])][:3]
    lacking = [r for r in want[1] if r not in set(got[1])][:3]
    return f"{got[0]} / {want[0]}; {len(got[1])} / {len(want[1])} rows; extra {extra}; lacking {lacking}"


if __name__ == "__main__":
    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            result = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if result is None else 'FAIL'} {name} {time.time() - start:.1f}s {result or ''}", flush=True)
