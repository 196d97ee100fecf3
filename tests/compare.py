"""Runs registered queries beside their SQL on DuckDB and reports differences."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, bool):
        return v
    if isinstance(v, (datetime.datetime,)):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    if hasattr(v, "asDict"):
        return [plain(x) for x in v]
    if type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return v


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(([plain(row[i]) for i in order] for row in rows), key=repr)


def compare(spark, con, name, query, sql, sf_dir):
    from tidemark.sources.scratch import scratch_scope

    with scratch_scope(spark):
        df = query(spark, sf_dir)
        got = table(df.columns, df.collect())
    if not sql:
        return None, len(got[1])
    cur = con.execute(sql)
    want = table([c[0] for c in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} against {want[0]}", len(got[1])
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows against {len(want[1])}: {[x for x in got[1] if x not in want[1]][:2]} {[x for x in want[1] if x not in got[1]][:2]}", len(got[1])
    bad = [(a, b) for a, b in zip(got[1], want[1], strict=True) if a != b]
    return (f"{len(bad)} rows differ, first {bad[0]}" if bad else ""), len(got[1])


def main(sf: str, parts: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from pyspark.sql import SparkSession

    from tidemark.plans import registry

    spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/{sf}"
    con, failed = connect(sf_dir), 0
    sqls = registry.oracle_sql()
    for name, q in registry.queries().items():
        if parts and not any(name.startswith(p) for p in parts):
            continue
        at = time.time()
        try:
            why, n = compare(spark, con, name, q, sqls.get(name), sf_dir)
        except Exception as e:
            why, n = f"{type(e).__name__}: {str(e)[:500]}", 0
        failed += bool(why)
        print(f"{'FAIL' if why else 'no sql' if why is None else 'ok':7}{name} {n} rows {time.time() - at:.1f} s {(why or '')[:600]}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
