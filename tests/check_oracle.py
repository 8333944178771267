"""Compare registered queries with their SQL twins: check_oracle.py [sf_dir] [name...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    shown = frame.astype(object).where(frame.notna(), None).map(
        lambda v: f"{v:.4f}" if isinstance(v, float) else str(v))
    return shown.sort_values(list(shown.columns)).reset_index(drop=True)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} and {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} and {len(sql_frame)}"
    kinds = [
        c for c in sql_frame.columns
        if str(spark_frame[c].dtype).lower().lstrip("u")[:3] != str(sql_frame[c].dtype).lower()[:3]
        and len(sql_frame)
    ]
    if kinds:
        return "types " + ", ".join(
            f"{c} {spark_frame[c].dtype}/{sql_frame[c].dtype}" for c in kinds)
    left, right = normal(spark_frame), normal(sql_frame)
    unequal = (left != right).any(axis=1)
    if unequal.any():
        return (f"{unequal.sum()} rows differ\n{left[unequal].head(5).to_string()}\n"
                f"{right[unequal].head(5).to_string()}")
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tramloom.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(entry.queries())
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            result = entry.queries()[name](spark, sf).toPandas()
            took = time.time() - start
            sql = entry.oracle_sql().get(name)
            problem = None if sql is None else difference(result, con.execute(sql).df())
            kind = "rows only" if sql is None else "ok"
        except Exception as error:
            took, problem, result = time.time() - start, str(error)[:700], []
        bad += problem is not None
        print(f"{name:32s} {len(result):8d} {took:6.2f}s {problem or kind}", flush=True)
    print("different:", bad)
