"""Run registered queries in Spark and their SQL oracle in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from rareclass.sources.io import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None  # pandas shows a null of a number column as NaN
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


# how DuckDB names the types that Spark reports; anything else must be listed to pass
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
         "boolean": "BOOLEAN", "date": "DATE"}


def type_differences(sdf, sql: str, con) -> dict[str, tuple[str, str]]:
    """Columns whose types differ between the query and its SQL (numbers of different width or kind included)."""
    own = dict(sdf.dtypes)
    theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {c: (t, theirs.get(c, "-")) for c, t in own.items() if TYPES.get(t, t.upper().replace("DECIMAL", "DECIMAL")) != theirs.get(c, "-").replace(", ", ",").replace(" ", "")}


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con) -> dict:
    t = time.time()
    sdf = fn(spark, sf_dir)
    spd = sdf.toPandas()
    st = time.time() - t
    res = {"name": name, "spark_rows": len(spd), "spark_sec": round(st, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    dpd = con.execute(sql).df()
    res["oracle_rows"] = len(dpd)
    if sorted(spd.columns) != sorted(dpd.columns):
        res["status"] = f"COLUMNS {sorted(spd.columns)} vs {sorted(dpd.columns)}"
        return res
    a, b = rows_of(spd), rows_of(dpd)
    types = type_differences(sdf, sql, con)
    if a == b:
        res["status"] = f"TYPES {types}" if types else "match"
    else:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["status"] = f"MISMATCH n={len(a)}/{len(b)} first={diff}"
    return res


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as E
    from rareclass.session import local_session

    spark = local_session(8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, name, fn, sqls.get(name), sf_dir, con)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        print(r, flush=True)


if __name__ == "__main__":
    main()
