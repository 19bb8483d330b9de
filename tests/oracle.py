"""Run registered queries next to their SQL twins and compare."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    return v


def compare(spark_df, con, sql):
    """None when equal, else a text that says what differs."""
    names = sorted(spark_df.columns)
    got = Counter(tuple(plain(r[n]) for n in names) for r in spark_df.collect())
    cur = con.execute(sql)
    theirs = [d[0] for d in cur.description]
    if sorted(theirs) != names:
        return f"columns differ: {names} vs {sorted(theirs)}"
    order = [theirs.index(n) for n in names]
    want = Counter(tuple(plain(r[i]) for i in order) for r in cur.fetchall())
    if got == want:
        return None
    return (f"{sum(got.values())} rows vs {sum(want.values())}; columns {names}\n  only spark "
            f"{list((got - want).items())[:3]}\n  only sql   {list((want - got).items())[:3]}")


def main(sf_dir, only):
    sys.path.insert(0, "/root/repo")
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "16g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = connect(sf_dir), entry.oracle_sql()
    for name, build in entry.queries().items():
        if name.startswith("op") and name[2].isdigit() or name == "pipeline":
            if not only:
                continue
        if only and not any(o in name for o in only):
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            if name in oracle:
                result = compare(df, con, oracle[name]) or "ok"
            else:
                result = f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            result = f"ERROR {type(error).__name__}: {str(error)[:500]}"
        print(f"{name:32s} {time.time() - start:6.2f}s {result}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
