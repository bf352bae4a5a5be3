"""Run registered queries in Spark and their oracle texts in DuckDB; compare.

Comparison mirrors the driver: columns sorted by name, rows compared as an
order-insensitive multiset of normalised values.

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tallyspark.plans.params import ORACLE_DIR  # noqa: E402
from tallyspark.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9) + 0.0)
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 9) + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    return repr(v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    body = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple("" if x is None else x for x in t))
    return cols, body


# Spark type -> DuckDB type that holds the same values.
TYPE_PAIRS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, sf_dir: str, name: str, query, sql: str | None) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    spark_s = time.time() - t0
    scols = sdf.columns
    out = {"name": name, "spark_rows": len(srows), "spark_sec": round(spark_s, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    res = con.execute(sql.replace(ORACLE_DIR, sf_dir))
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    out["oracle_rows"] = len(drows)
    a, b = canon(scols, srows), canon(dcols, drows)
    stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    dtypes = {d[0]: str(d[1]) for d in res.description}
    bad_types = {c: (stypes[c], dtypes.get(c)) for c in stypes if TYPE_PAIRS.get(stypes[c]) != dtypes.get(c)}
    if a[0] != b[0]:
        out["status"] = f"COLUMNS {a[0]} vs {b[0]}"
    elif bad_types:
        out["status"] = f"TYPES {bad_types}"
    elif a[1] != b[1]:
        diff = [x for x in a[1] if x not in set(b[1])][:3]
        diff2 = [x for x in b[1] if x not in set(a[1])][:3]
        out["status"] = f"VALUES spark-only={diff} oracle-only={diff2}"
    else:
        out["status"] = "ok"
    out["types"] = [f"{f.name}:{f.dataType.simpleString()}" for f in sdf.schema.fields]
    out["oracle_types"] = [f"{d[0]}:{d[1]}" for d in res.description]
    return out


def main() -> None:
    import __spark_entry__ as E
    from tallyspark.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(E.queries())
    spark = build_session("local[8]", 8, checkpoint_dir=tempfile.mkdtemp(prefix="oracle-shared-"))
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, sf_dir, n, qs[n], sqls.get(n))
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(f"{r['name']:<28} spark={r.get('spark_rows')} oracle={r.get('oracle_rows')} "
              f"sec={r.get('spark_sec')} {r['status'][:900]}", flush=True)
    print(f"mismatches: {bad} of {len(names)}")


if __name__ == "__main__":
    main()
