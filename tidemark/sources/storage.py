"""Reading and writing tables on shared storage."""

import hashlib
import re
import tempfile

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_local_roots: dict[str, str] = {}
_written: set[tuple[str, str]] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints, which all executors reach.

    Only a local master, where the driver is the executor, may go without: it gets a
    temporary folder. On a cluster a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_roots[app]


def app_folder(spark: SparkSession, *parts: str) -> str:
    return "/".join([shared_folder(spark), f"tidemark-{spark.sparkContext.applicationId}", *parts])


def table_path(spark: SparkSession, scope: str, name: str) -> str:
    return app_folder(spark, hashlib.md5(scope.encode()).hexdigest()[:12], name)


def stored_once(spark: SparkSession, scope: str, name: str, build, schema=None) -> DataFrame:
    """A derived table, written on first use in this application and read afterwards.

    The written files cut the lineage, so later queries survive lost executors
    without recomputing it.
    """
    path = table_path(spark, scope, name)
    if (spark.sparkContext.applicationId, path) not in _written:
        build().write.mode("overwrite").parquet(path)
        _written.add((spark.sparkContext.applicationId, path))
    # A declared schema saves the job that reads it from the file footers.
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def param_scan(frame: DataFrame, query: str, **params) -> DataFrame:
    """Run a SELECT over ``{source}`` with named parameters such as ``:report_date``."""
    return frame.sparkSession.sql(query, args=params, source=frame)


def _hadoop(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where it is absent."""
    fs, target = _hadoop(spark, path)
    if not fs.exists(target):
        return []
    return [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop(spark, path)
    fs.delete(target, True)


def nothing(spark: SparkSession, schema) -> DataFrame:
    """An empty table that Spark knows to be empty, so that joins with it fall away."""
    return spark.createDataFrame([], schema).limit(0)


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table by path; an absent table is an empty one."""
    if table_exists(spark, path):
        # A partition column comes back last; restore the declared order.
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    return nothing(spark, schema)


def write_counted(rows: DataFrame, save) -> int:
    """Run ``save(rows)`` and return how many rows it wrote, counted in the same job."""
    seen = Observation()
    save(rows.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def append(df: DataFrame, path: str) -> int:
    return write_counted(df, lambda rows: rows.write.mode("append").parquet(path))


def overwrite_partitions(df: DataFrame, path: str, partition_col: str, affected) -> int:
    """Replace the affected partitions of a table by ``df``; returns the rows written.

    Dynamic overwrite replaces the partitions that have new rows. An affected
    value without rows would keep its old files, so its folder is removed.
    """
    spark = df.sparkSession
    seen = Observation()
    # Rebalancing gathers each value into few files and still splits a large one.
    (
        df.hint("rebalance", partition_col)
        .observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.collect_set(F.col(partition_col).cast("string")).alias("filled"),
        )
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )
    filled = set(seen.get["filled"])
    for value in affected:
        if str(value) not in filled:
            delete_folder(spark, f"{path}/{partition_col}={value}")
    return seen.get["rows"]


def export_csv(df: DataFrame, path: str, order_by: list[str]) -> int:
    """Write ordered CSV with a header and return the number of rows.

    Files are in range order; adaptive execution merges a small result into one.
    """
    return write_counted(
        df.orderBy(*order_by),
        lambda rows: rows.write.mode("overwrite").option("header", True).csv(path),
    )
