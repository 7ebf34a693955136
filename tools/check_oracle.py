"""Run every catalogue query in Spark and its oracle SQL in DuckDB; compare.

Usage: python tools/check_oracle.py [sf_dir] [query ...]
Compares row count, column names and the multiset of rows (floats compared
to 1e-9 relative). Prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

import duckdb  # noqa: E402

from strata.plans.catalog import queries  # noqa: E402
from strata.plans.oracle import oracle_sql  # noqa: E402
from strata.session import get_spark  # noqa: E402
from strata.sources.driver_tables import TABLES  # noqa: E402


EXACT = "--exact" in sys.argv
if EXACT:
    sys.argv.remove("--exact")


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else float(f"{v:.10g}")
    if hasattr(v, "is_nan"):  # Decimal
        return str(v) if EXACT else float(f"{float(v):.10g}")
    if hasattr(v, "item"):
        return norm(v.item())
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime()
    return v


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    oracles = oracle_sql()
    bad = 0
    for name, q in queries().items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sdf = q(spark, sf)
            srows = [tuple(norm(r[c]) for c in sorted(sdf.columns)) for r in sdf.collect()]
            scols = sorted(sdf.columns)
        except Exception as e:  # noqa: BLE001
            print(f"{name:22s} SPARK FAILED {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in oracles:
            print(f"{name:22s} rows={len(srows)} (no oracle) spark={ts:.1f}s")
            continue
        try:
            rel = con.execute(oracles[name])
            ocols_raw = [d[0] for d in rel.description]
            orows_raw = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:22s} ORACLE FAILED {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        order = sorted(range(len(ocols_raw)), key=lambda i: ocols_raw[i])
        ocols = [ocols_raw[i] for i in order]
        orows = [tuple(norm(r[i]) for i in order) for r in orows_raw]
        ok_cols = ocols == scols
        cs, co = Counter(srows), Counter(orows)
        ok = ok_cols and len(srows) == len(orows) and cs == co
        status = "OK " if ok else "BAD"
        if not ok:
            bad += 1
        print(f"{name:22s} {status} rows spark={len(srows)} oracle={len(orows)} spark={ts:.1f}s", flush=True)
        if not ok_cols:
            print("   cols spark:", scols, "\n   cols oracle:", ocols)
        elif not ok:
            only_s = list((cs - co).elements())[:3]
            only_o = list((co - cs).elements())[:3]
            print("   cols:", scols)
            print("   spark-only:", only_s)
            print("   oracle-only:", only_o)
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
