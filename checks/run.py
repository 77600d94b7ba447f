"""Compare registered queries with their SQL counterparts: python -m checks.run [folder] [key ...]"""

from __future__ import annotations

import sys
import time
import traceback

import duckdb
import pandas as pd

from checks.catalog import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def ordered(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    text = frame.map(lambda v: "" if v is None or v != v else repr(v))
    return frame.loc[text.sort_values(list(text.columns)).index].reset_index(drop=True)


def difference(left: pd.DataFrame, right: pd.DataFrame) -> str | None:
    """None when both frames hold the same rows, regardless of order."""
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(left.columns)} vs {sorted(right.columns)}"
    if len(left) != len(right):
        return f"{len(left)} rows vs {len(right)}"
    left, right = ordered(left), ordered(right)
    for c in left.columns:
        a, b = left[c], right[c]
        kinds = (pd.api.types.infer_dtype(a, skipna=True), pd.api.types.infer_dtype(b, skipna=True))
        same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            i = int((~same).to_numpy().argmax())
            return f"{c}: {int((~same).sum())} of {len(a)} differ, first {a[i]!r} vs {b[i]!r}; {kinds}"
    return None


def main(folder: str, keys: list[str]) -> int:
    from terrafold.session import local_session

    spark = local_session()
    con = connect(folder)
    failed = []
    for key in keys or QUERIES:
        began = time.time()
        try:
            got = QUERIES[key](spark, folder).toPandas()
            spent = time.time() - began
            problem, began = None, time.time()
            if key in ORACLES:
                problem = difference(got, con.execute(ORACLES[key]).df())
            else:
                problem = None if len(got) else "no rows"
        except Exception:
            problem, spent = traceback.format_exc(limit=3)[-1500:], time.time() - began
        print(f"{'ok  ' if problem is None else 'FAIL'} {key:36} rows={len(got) if problem is None else '-':>7} "
              f"spark={spent:6.2f}s sql={time.time() - began:6.2f}s", flush=True)
        if problem is not None:
            failed.append(key)
            print("     ", problem, flush=True)
    print(f"{len(failed)} failed of {len(keys or QUERIES)}: {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
