"""Reading and writing: what comes back from disk."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import query
from registry.dirty import COLUMNS, dirty, dirty_rules, with_dirty
from registry.event_queries import CORRUPTED_SQL, RATE, SEED, clean, clean_rules
from registry.fix_queries import CHAIN, PLAN_LOG_SQL, STEPS
from tablewright.constants import ROW_ID
from tablewright.operators import evaluate as ev
from tablewright.operators import report
from tablewright.plans.apply import apply_steps, log_frame
from tablewright.sources import read_csv, write_fixed
from tablewright.sources.readers import read_tables
from tablewright.sources.writers import write_evaluation, write_log
from tablewright.tables import new_path


@query("csv_malformed", with_dirty("SELECT order_id, count(*) AS n FROM dirty WHERE row_id % 70 = 0 GROUP BY order_id"))
def csv_malformed(spark, sf):
    """Rows with a cell too many come out as a table of their own."""
    path = new_path(spark, "csv")
    cells = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in COLUMNS])
    line = F.when(F.col(ROW_ID) % 70 == 0, F.concat(cells, F.lit(",surplus"))).otherwise(cells)
    # One column whose name is the header line; nothing is quoted as the lines hold no such separator.
    dirty(spark, sf).select(line.alias(",".join(COLUMNS))).write.option("header", True).option("sep", "\u0001").csv(path)
    bad = read_csv(spark, path, keep_bad=True).bad
    return bad.groupBy(F.col("first_cell").alias("order_id")).agg(F.count("*").alias("n"))


@query("csv_two_headers", with_dirty("SELECT order_id, priority, order_date, count(*) AS n FROM dirty GROUP BY ALL"))
def csv_two_headers(spark, sf):
    """Files with their columns in different order meet by name."""
    path, d = new_path(spark, "csv"), dirty(spark, sf)
    write_fixed(d.where(F.col(ROW_ID) % 20 == 0).select(*COLUMNS), path)
    write_fixed(d.where(F.col(ROW_ID) % 20 != 0).select(*COLUMNS[::-1]), path, mode="append")
    return read_csv(spark, path, nulls=("",)).data.groupBy("order_id", "priority", "order_date").agg(F.count("*").alias("n"))


@query("tables_read", "SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'part', count(*) FROM part")
def tables_read(spark, sf):
    """Several tables at once, as CSV and as parquet."""
    path = new_path(spark, "part") + ".csv"
    write_fixed(spark.read.parquet(f"{sf}/part.parquet"), path)
    found = read_tables(spark, {"orders": f"{sf}/orders.parquet", "part": path})
    counts = [t.select(F.lit(n).alias("name")).groupBy("name").agg(F.count("*").alias("n")) for n, t in found.items()]
    return counts[0].unionByName(counts[1])


@query("log_written", with_dirty(PLAN_LOG_SQL, CHAIN))
def log_written(spark, sf):
    """A correction log through JSON lines."""
    path, d = new_path(spark, "log"), dirty(spark, sf)
    _, entries = apply_steps(d, "dirty", STEPS, dirty_rules())
    write_log(log_frame(d, entries), path)
    return spark.read.json(path).select("seq", "action", "column", "rows_affected", "applied")


@query("log_list", with_dirty("""
SELECT 'dirty' AS dataset, seq AS id, action, "column", rows_affected, applied FROM (""" + PLAN_LOG_SQL + ")", CHAIN))
def log_list(spark, sf):
    d = dirty(spark, sf)
    _, entries = apply_steps(d, "dirty", STEPS, dirty_rules())
    return report.log_list(log_frame(d, entries)).select("dataset", "id", "action", "column", "rows_affected", "applied")


@query("evaluation_written", "SELECT 'summary' AS part, 'overall' AS family, n AS tp FROM (SELECT count(*) AS n FROM ("
       + CORRUPTED_SQL["disguisednull"] + ")) UNION ALL SELECT 'families', 'disguisednull', n FROM (SELECT count(*) AS n FROM ("
       + CORRUPTED_SQL["disguisednull"] + "))")
def evaluation_written(spark, sf):
    """Metrics of an evaluation, written and read back."""
    path = new_path(spark, "evaluation")
    write_evaluation(*ev.evaluate(clean(spark, sf), "orders", clean_rules(), ["disguisednull"], RATE, SEED, ["disguisednull"]), path)
    summary = spark.read.json(f"{path}/summary").select(F.lit("summary").alias("part"), "family", F.col("tp").cast("long").alias("tp"))
    families = spark.read.option("header", True).csv(f"{path}/families")
    return summary.unionByName(families.select(F.lit("families").alias("part"), "family", F.col("tp").cast("long").alias("tp")))


