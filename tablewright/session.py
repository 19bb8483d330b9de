"""Session settings that suit these jobs."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Methods above 8,000 bytes of code are never compiled by the JVM's JIT. Stages with many text
# expressions would exceed that and run interpreted; below this limit Spark falls back to
# smaller generated methods instead.
SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


#: Tasks that a scan of a large table gets for each core.
TASKS_A_CORE = 4


def own_work_folder(spark: SparkSession) -> SparkSession:
    """Give a local session (tests, benches) a folder for intermediate tables of its own if it names none."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local["):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tablewright-"))
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    # Scans get several tasks a core, so that a last task does not keep the other cores waiting for a whole round.
    spark.conf.set("spark.sql.files.minPartitionNum", str(TASKS_A_CORE * spark.sparkContext.defaultParallelism))
    return spark
