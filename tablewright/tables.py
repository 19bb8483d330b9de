"""Row identity, durable intermediate tables and size-checked broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.util import inheritable_thread_target

from tablewright.constants import ROW_ID

#: Rows of a file of an intermediate table: files are what scans are dealt by.
FILE_ROWS = 250_000


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names in spark.checkpoint.dir."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return configured


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tablewright/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table", folders: Sequence[str] = ()) -> DataFrame:
    """Write the table once as parquet and read it back.

    Cuts lineage like a checkpoint, survives lost executors, and later scans still prune
    columns and push filters down. The rows of each value of the columns ``folders`` are written apart.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.option("maxRecordsPerFile", FILE_ROWS).partitionBy(*folders).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_frame(spark: SparkSession, rows: Iterable[Sequence], schema: str | T.StructType) -> DataFrame:
    """A few driver-side rows as a local relation, which the optimizer folds into the plan."""
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(struct)
    rows = list(rows)
    arrays = [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), struct)


def local_rows(df: DataFrame) -> DataFrame:
    """Pin a result whose size depends on the number of columns, not of rows, as a local relation."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)


def together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """The results of jobs that don't need each other, up to four side by side: small ones fill the cores that others leave idle."""
    with ThreadPoolExecutor(4) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [job.result() for job in started]


def with_row_id(df: DataFrame, key: str | None = None) -> DataFrame:
    """Add ``_row_id``: the user's key when it is a whole number, else a number fixed by writing the table
    once, so that recomputed partitions can never renumber rows.

    Numbers given by writing follow the order in which Spark reads the splits, which for several files is not
    the files' order. A key must be unique and not null; a key of another type is checked and stays data.
    """
    if ROW_ID in df.columns:
        return df
    if key is not None:
        counts = df.agg(F.count("*").alias("rows"), F.count(col(key)).alias("keys"), F.count_distinct(col(key)).alias("distinct")).first()
        if not counts["rows"] == counts["keys"] == counts["distinct"]:
            raise ValueError(f"row key {key!r}: {counts['rows']} rows, {counts['keys']} keys, {counts['distinct']} distinct ones")
        if isinstance(df.schema[key].dataType, T.IntegralType):
            return df.withColumn(ROW_ID, col(key).cast("long"))
    return materialize(df.withColumn(ROW_ID, F.monotonically_increasing_id()), "rows")


def data_columns(df: DataFrame) -> list[str]:
    """Audited columns: all but the row identity."""
    return [c for c in df.columns if c != ROW_ID]


def is_numeric_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_nested_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType))


def column_groups(df: DataFrame) -> tuple[list[str], list[str], list[str]]:
    """(text-like, numeric, nested) data columns by declared type."""
    text, numeric, nested = [], [], []
    for field in df.schema.fields:
        if field.name == ROW_ID:
            continue
        target = (nested if is_nested_type(field.dataType)
                  else numeric if is_numeric_type(field.dataType) else text)
        target.append(field.name)
    return text, numeric, nested


def quoted(name: str) -> str:
    """Column name safe for names with dots or spaces."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str):
    return F.col(quoted(name))


def rows_of_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose (null-safe) key is in ``groups``, with the other columns of ``groups`` attached.

    ``groups`` holds one row per key and should be a written table, whose size Spark knows: a small one is
    broadcast below Spark's own limit of bytes. Otherwise both sides are shuffled, and as a key has one row on
    the side of the groups, adaptive execution splits the rows of a hot key over as many tasks as they need.
    """
    left, right = df.alias("l"), groups.alias("r")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"l.{quoted(k)}").eqNullSafe(F.col(f"r.{quoted(k)}"))
    return left.join(right, on).select(*[F.col(f"l.{quoted(c)}") for c in df.columns],
                                       *[F.col(f"r.{quoted(c)}") for c in groups.columns if c not in keys])
