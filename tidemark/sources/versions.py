"""Tables as versioned folders, and one list of the folders that are current.

A table is a set of parts, each in a folder of its own below
``<root>/<table>/version=<id>``. New folders are written beside the old ones and stay
unseen until a list that names them is complete; writing that list is the one
switch by which raw events, newest versions and marts change together. Folders
that neither of the two newest lists names are left over from a broken or an
overtaken run and are swept at the next load. One writer per root is assumed.
"""

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.storage import child_folders, delete_folder, nothing, table_exists

#: (table, part) -> folder, relative to the root.
Entries = dict[tuple[str, str], str]

_LIST = "table string, part string, path string"


def _lists(spark: SparkSession, root: str) -> list[str]:
    """Names of the complete lists, oldest first."""
    names = sorted(child_folders(spark, f"{root}/lists"))
    return [n for n in names if table_exists(spark, f"{root}/lists/{n}/_SUCCESS")]


def _entries(spark: SparkSession, root: str, name: str) -> Entries:
    rows = spark.read.schema(_LIST).parquet(f"{root}/lists/{name}").collect()
    return {(r["table"], r["part"]): r["path"] for r in rows}


def current(spark: SparkSession, root: str) -> Entries:
    """The folders that are current; one row for each part of each table."""
    names = _lists(spark, root)
    return _entries(spark, root, names[-1]) if names else {}


def publish(spark: SparkSession, root: str, entries: Entries) -> None:
    """Make ``entries`` current. Readers see all of the change or nothing of it."""
    names = _lists(spark, root)
    following = f"{int(names[-1]) + 1:010d}" if names else f"{1:010d}"
    rows = [(table, part, path) for (table, part), path in sorted(entries.items())]
    frame = spark.createDataFrame(rows, _LIST).coalesce(1)
    frame.write.mode("overwrite").parquet(f"{root}/lists/{following}")


def sweep(spark: SparkSession, root: str, tables: Iterable[str]) -> None:
    """Delete older lists, and folders of the tables that the two newest don't name."""
    names = _lists(spark, root)
    for name in child_folders(spark, f"{root}/lists"):
        if name not in names[-2:]:
            delete_folder(spark, f"{root}/lists/{name}")
    named = {
        "/".join(path.split("/")[:-1] if "version=" not in path.split("/")[-1] else path.split("/"))
        for name in names[-2:]
        for path in _entries(spark, root, name).values()
    }
    for table in tables:
        for version in child_folders(spark, f"{root}/{table}"):
            if f"{table}/{version}" not in named:
                delete_folder(spark, f"{root}/{table}/{version}")


def stage(
    df: DataFrame,
    root: str,
    table: str,
    version: str,
    part: str | None = None,
    order: Iterable[str] = (),
) -> tuple[int, dict[str, str]]:
    """Write a frame as a version of a table; returns its rows and the parts written.

    ``part`` is the partition column, of few values; each gets few files, a large one
    more, with rows in the given order. Nothing is current before :func:`publish`.
    """
    folder = f"{table}/version={version}"
    seen = Observation()
    counted = F.count(F.lit(1)).alias("rows")
    if part is None:
        df.observe(seen, counted).write.mode("overwrite").parquet(f"{root}/{folder}")
        rows = seen.get["rows"]
        return rows, {version: folder} if rows else {}
    values = F.collect_set(F.col(part).cast("string")).alias("values")
    rebalanced = df.hint("rebalance", part).observe(seen, counted, values)
    if order := list(order):
        rebalanced = rebalanced.sortWithinPartitions(part, *order)
    rebalanced.write.mode("overwrite").partitionBy(part).parquet(f"{root}/{folder}")
    found = seen.get
    return found["rows"], {v: f"{folder}/{part}={v}" for v in found["values"]}


def replaced(
    entries: Entries, table: str, parts: dict[str, str], affected: Iterable[str] = ()
) -> Entries:
    """Entries in which ``parts`` are new and affected parts without a folder are gone."""
    gone = {(table, str(v)) for v in affected}
    kept = {k: path for k, path in entries.items() if k not in gone}
    return {**kept, **{(table, v): path for v, path in parts.items()}}


def read(
    spark: SparkSession, root: str, entries: Entries, table: str, schema, part: str | None = None
) -> DataFrame:
    """The current parts of a table; a filter on the part column prunes folders.

    An absent table is an empty one. The part column is added if the schema lacks it.
    """
    columns = [*schema.names, *([part] if part and part not in schema.names else [])]
    paths = [f"{root}/{path}" for (name, _), path in entries.items() if name == table]
    if not paths:
        empty = nothing(spark, schema)
        return empty if len(columns) == len(schema) else empty.withColumn(part, F.lit(""))
    declared = schema if len(columns) == len(schema) else f"{ddl(schema)}, {part} string"
    reader = spark.read.schema(declared).option("basePath", f"{root}/{table}")
    return reader.parquet(*paths).select(*columns)


def ddl(schema) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
