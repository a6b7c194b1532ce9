"""Run registered queries against their DuckDB oracle, like the driver does.

    python tests/oracle_check.py [--sf /root/testdata/sf0.01] [key ...]

Prints one line per key: OK / MISMATCH (with the reason) / ROWS (no oracle).
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(repr(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _kind(dtype: str) -> str:
    d = dtype.lower()
    for k, names in {
        "int64": ["bigint", "long", "int64"], "int32": ["int", "integer", "int32"],
        "float64": ["double", "float64"], "bool": ["boolean", "bool"],
        "str": ["string", "varchar", "object"], "ts": ["timestamp"], "date": ["date"],
    }.items():
        if any(d == n or d.startswith(n) for n in names):
            return k
    return d


def compare(spark_df, duck_rel):
    spark_cols = spark_df.columns
    sdf = spark_df.toPandas()
    ddf = duck_rel.df()
    if sorted(spark_cols) != sorted(ddf.columns):
        return f"columns {sorted(spark_cols)} vs {sorted(ddf.columns)}"
    stypes = {f.name: _kind(f.dataType.simpleString()) for f in spark_df.schema.fields}
    dtypes = {c: _kind(str(t)) for c, t in zip(duck_rel.columns, duck_rel.types)}
    bad = {c: (stypes[c], dtypes[c]) for c in stypes if stypes[c] != dtypes[c]}
    if bad:
        return f"types {bad}"
    if len(sdf) != len(ddf):
        return f"rows {len(sdf)} vs {len(ddf)}"
    cols = sorted(spark_cols)
    srows = sorted((tuple(_norm(v) for v in r) for r in sdf[cols].itertuples(index=False)), key=repr)
    drows = sorted((tuple(_norm(v) for v in r) for r in ddf[cols].itertuples(index=False)), key=repr)
    for a, b in zip(srows, drows):
        if a != b:
            return f"values spark={a} duck={b}"
    return None


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--partitions", type=int, default=None, help="spark.sql.shuffle.partitions")
    ap.add_argument("keys", nargs="*")
    args = ap.parse_args()

    from quarry.session import local_session

    import __spark_entry__ as entry

    spark = local_session(shuffle_partitions=args.partitions)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(args.sf)
    qs, sqls = entry.queries(), entry.oracle_sql()
    keys = args.keys or sorted(qs)
    failed = 0
    for k in keys:
        t0 = time.time()
        try:
            df = qs[k](spark, args.sf)
            if k in sqls:
                msg = compare(df, con.sql(sqls[k]))
                status = "OK" if msg is None else "MISMATCH " + msg[:400]
            else:
                status = f"ROWS {df.count()}"
        except Exception as e:  # noqa: BLE001
            status = f"ERROR {type(e).__name__}: {str(e).splitlines()[0][:300]}"
        if status.startswith(("MISMATCH", "ERROR")):
            failed += 1
        print(f"{k:28s} {time.time() - t0:6.1f}s {status}", flush=True)
    print(f"{len(keys) - failed}/{len(keys)} fine")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
