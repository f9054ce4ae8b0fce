"""Run registered queries in Spark and their SQL in DuckDB; compare.

    python tools/oracle_check.py [sf_dir] [query ...]

Comparison: row count, sorted column names, and the rows with columns in name
order (exact values; floats compared exactly): as a sequence where the SQL ends
in an ORDER BY of its own, as a multiset elsewhere.
"""

from __future__ import annotations

import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tessera.plans.registry import load_all  # noqa: E402
from tessera.session import build_session  # noqa: E402
from tessera.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return ("null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("f", repr(float(v)))
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    if isinstance(v, dict):
        return ("d", tuple(sorted((k, _norm(x)) for k, x in v.items())))
    if hasattr(v, "asDict"):
        return ("d", tuple(sorted((k, _norm(x)) for k, x in v.asDict().items())))
    if isinstance(v, (bytes, bytearray, memoryview)):
        return ("b", bytes(v))
    if hasattr(v, "is_integer") and not isinstance(v, int):  # Decimal
        return ("dec", str(v))
    return (type(v).__name__, v if isinstance(v, (int, str, bool)) else str(v))


# Spark simple type -> DuckDB type name of the same value domain
TYPE_NAMES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "binary": "BLOB", "array<float>": "FLOAT[]",
}


def type_mismatches(spark_schema, duck_columns, duck_types):
    duck = {c: str(t) for c, t in zip(duck_columns, duck_types)}
    out = []
    for f in spark_schema.fields:
        s = f.dataType.simpleString()
        if TYPE_NAMES.get(s, s) != duck.get(f.name):
            out.append(f"{f.name}: spark {s} vs duck {duck.get(f.name)}")
    return out


def promises_order(sql):
    """Whether the outermost SELECT has an ORDER BY."""
    depth, outer = 0, []
    for c in sql:
        depth += (c == "(") - (c == ")")
        if depth == 0:
            outer.append(c)
    last = "".join(outer).upper().rsplit("SELECT", 1)[-1]
    return "ORDER BY" in " ".join(last.split())


def compare(spark_rows, spark_cols, duck_rows, duck_cols, ordered=False):
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns differ: {sorted(spark_cols)} vs {sorted(duck_cols)}"
    if len(spark_rows) != len(duck_rows):
        return f"row count {len(spark_rows)} vs {len(duck_rows)}"
    order_s = sorted(range(len(spark_cols)), key=lambda i: spark_cols[i])
    order_d = sorted(range(len(duck_cols)), key=lambda i: duck_cols[i])
    a = [tuple(_norm(r[i]) for i in order_s) for r in spark_rows]
    b = [tuple(_norm(r[i]) for i in order_d) for r in duck_rows]
    if not ordered:
        a, b = sorted(a), sorted(b)
    for x, y in zip(a, b):
        if x != y:
            return f"first differing row:\n  spark {x}\n  duck  {y}"
    return None


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = set(argv[2:])
    if os.environ.get("ORACLE_PLAIN"):
        # a bare session, as a caller would pass it (no tessera settings)
        from pyspark.sql import SparkSession

        b = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        b = b.config("spark.ui.enabled", "false")
        if os.environ.get("ORACLE_TZ"):
            b = b.config("spark.sql.session.timeZone", os.environ["ORACLE_TZ"])
        spark = b.getOrCreate()
    else:
        spark = build_session(shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    results = {}
    for name, q in load_all().items():
        if wanted and name not in wanted:
            continue
        t0 = time.time()
        try:
            df = q.fn(spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as e:  # report and continue
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:400]}"
            print(name, results[name], flush=True)
            continue
        ts = time.time() - t0
        if q.sql is None:
            results[name] = f"rows-only ({len(rows)} rows)"
        else:
            try:
                rel = con.sql(q.sql)
                types_bad = type_mismatches(df.schema, rel.columns, rel.types)
                cur = con.execute(q.sql)
                dcols = [d[0] for d in cur.description]
                drows = cur.fetchall()
                err = compare(rows, cols, drows, dcols, promises_order(q.sql))
                if err is None and types_bad:
                    err = "types differ: " + "; ".join(types_bad)
                results[name] = "OK" if err is None else "MISMATCH " + err
            except Exception as e:
                results[name] = f"SQL ERROR {type(e).__name__}: {str(e)[:400]}"
        print(f"{name}: {results[name]}  [{len(rows)} rows, {ts:.2f}s]", flush=True)
    bad = [n for n, r in results.items() if not (r == "OK" or r.startswith("rows-only"))]
    print(json.dumps({"checked": len(results), "bad": bad}))
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
