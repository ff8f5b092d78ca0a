"""Compare each registered Spark query with its DuckDB oracle (rows, columns, values)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "NULL"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "smallint": "SMALLINT",
                 "float": "FLOAT"}


def type_diffs(sdf, rel) -> list[str]:
    """Columns whose Spark type and DuckDB type differ (decimals must agree on precision/scale)."""
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for f in sdf.schema.fields:
        t = f.dataType.simpleString()
        want = SPARK_TO_DUCK.get(t, t.upper())
        if duck_types.get(f.name) != want:
            out.append(f"{f.name}: spark={t} duck={duck_types.get(f.name)}")
    return out


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in records)


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = {"query": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    ocols = rel.columns
    orows = rel.fetchall()
    res["oracle_rows"] = len(orows)
    res["cols_match"] = sorted(scols) == sorted(ocols)
    if not res["cols_match"]:
        res["cols"] = (sorted(set(scols) - set(ocols)), sorted(set(ocols) - set(scols)))
        res["status"] = "FAIL"
        return res
    a, b = rows_of(scols, srows), rows_of(ocols, orows)
    res["values_match"] = a == b
    diffs = type_diffs(sdf, rel)
    res["types_match"] = not diffs
    if diffs:
        res["type_diffs"] = diffs
    res["status"] = "ok" if a == b and len(srows) == len(orows) and not diffs else "FAIL"
    if a != b:
        sa, sb = set(a), set(b)
        res["only_spark"] = sorted(sa - sb)[:3]
        res["only_oracle"] = sorted(sb - sa)[:3]
        res["sorted_cols"] = sorted(scols)
    return res


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from civicflow.session import get_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    names = argv or list(qs)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, qs[n], os_.get(n), sf_dir, con)
        except Exception as e:  # noqa: BLE001
            r = {"query": n, "status": "ERROR", "error": str(e)[:1500]}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print("BAD", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
