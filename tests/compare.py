"""Run queries and their oracles side by side: ``python tests/compare.py SF_DIR [query ...]``."""

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None).map(
        lambda v: v.item() if hasattr(v, "item") else v
    ).map(lambda v: float(v) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) else v)
    order = frame.map(repr).agg("|".join, axis=1).sort_values(kind="stable").index
    return frame.loc[order].reset_index(drop=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when both hold the same rows, else what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if not len(got):
        return "no rows"
    got, want = _normal(got), _normal(want)
    unequal = (got.map(repr) != want.map(repr)).any(axis=1)
    if unequal.any():
        return f"{unequal.sum()} rows differ:\n{got[unequal].head(3)}\n{want[unequal].head(3)}"
    return None


def main(sf_dir: str, *names: str) -> None:
    from __spark_entry__ import oracle_sql, queries
    from dwellmap.session import build_session

    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    sql, con = oracle_sql(), duck(sf_dir)
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = query(spark, sf_dir).toPandas()
            took = time.time() - start
            start = time.time()
            want = con.execute(sql[name]).df()
            verdict = differences(got, want) or "same"
            print(f"{name:24s} {len(got):7d} rows spark {took:5.1f}s duck {time.time() - start:5.1f}s {verdict}", flush=True)
        except Exception as error:  # noqa: BLE001
            print(f"{name:24s} FAILED {type(error).__name__}: {str(error)[:1500]}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
