"""Compare queries with their SQL in DuckDB: python tests/oracle.py [SF] [NAME...]."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = os.environ.get("TESTDATA", "/root/testdata")


def views(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        source = path if os.path.isfile(path) else f"{path}/*.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{source}')")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    def show(x) -> str:
        if isinstance(x, float):
            return "null" if x != x else f"{x:.9g}"
        if x is None or x is pd.NaT or x is pd.NA:
            return "null"
        if hasattr(x, "tolist"):
            x = x.tolist()
        return str(x)

    columns = sorted(frame.columns)
    return sorted(tuple(show(x) for x in row) for row in frame[columns].astype(object).itertuples(index=False))


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} against {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if a == b:
        return ""
    extra, lost = list(set(a) - set(b))[:3], list(set(b) - set(a))[:3]
    return f"rows {len(a)} against {len(b)}; only ours {extra}; only SQL {lost}"


def main() -> None:
    import __spark_entry__ as entry
    from paperloom.runtime import local_session

    folder = f"{DATA}/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    spark, con, sql = local_session(8), views(folder), entry.oracle_sql()
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and not any(name.startswith(x) for x in sys.argv[2:]):
            continue
        began = time.time()
        try:
            got = query(spark, folder).toPandas()
            verdict = (compare(got, con.execute(sql[name]).df()) or "equal") if name in sql else "no SQL"
        except Exception as e:  # noqa: BLE001
            got, verdict = [], f"ERROR {str(e)[:1500]}"
        print(f"{name}: {len(got)} rows, {time.time() - began:.1f} s: {verdict}", flush=True)


if __name__ == "__main__":
    main()
