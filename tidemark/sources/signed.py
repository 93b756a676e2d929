"""Tables of signed changes, in which the rows of a key add up to its value.

A change of the data adds a *run* of rows with the differences it makes and rewrites nothing.
Runs are added up into one when those beside the largest hold more than a share of its rows, so
what is written follows the changes. A run's entries begin with its number of rows; with
a ``bucket`` column it has an entry for each bucket, and readers take only the buckets they need.
"""

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import versions

FOLD = 8
BUCKETS = 64


@dataclass(frozen=True)
class Signed:
    """``keys`` are "name type" pairs, ``measures`` names of 64-bit counts."""

    table: str
    keys: tuple[str, ...]
    measures: tuple[str, ...]
    bucketed: bool = False

    @property
    def key_names(self) -> list[str]:
        return [k.split()[0] for k in self.keys]

    @property
    def schema(self):
        ddl = ", ".join([*self.keys, *[f"{m} long" for m in self.measures]])
        return T.StructType.fromDDL(ddl)

    def totals(self, rows: DataFrame) -> DataFrame:
        """One row for each key whose rows don't cancel out."""
        summed = rows.groupBy(*self.key_names).agg(*[F.sum(m).alias(m) for m in self.measures])
        return summed.filter(" OR ".join(f"{m} <> 0" for m in self.measures))

    def bucket(self):
        return F.pmod(F.xxhash64(*self.key_names), F.lit(BUCKETS)).cast("string")


def stored(entries: versions.Entries, kind: Signed) -> bool:
    return any(table == kind.table for table, _ in entries)


def buckets_of(kind: Signed, rows: DataFrame) -> list[str]:
    """Buckets that hold keys of the rows, of :data:`BUCKETS`."""
    return sorted(r[0] for r in rows.select(kind.bucket()).distinct().collect())


def read(
    spark: SparkSession,
    root: str,
    entries: versions.Entries,
    kind: Signed,
    buckets: Iterable[str] | None = None,
) -> DataFrame:
    """Rows of all runs, not added up; of the named buckets alone, if there are any named."""
    wanted = None if buckets is None else set(buckets)
    picked = {
        (table, part): path
        for (table, part), path in entries.items()
        if table == kind.table and (wanted is None or part.split("/")[-1] in wanted)
    }
    schema = kind.schema
    rows = versions.read(
        spark, root, picked, kind.table, schema, "bucket" if kind.bucketed else None
    )
    return rows.select(*schema.names)


def add(
    spark: SparkSession,
    root: str,
    entries: versions.Entries,
    kind: Signed,
    changes: DataFrame,
    version: str,
) -> versions.Entries:
    """Entries with a run for the changes; runs are folded when the small ones outgrow a share."""
    entries = {**entries, **_run(root, kind, kind.totals(changes), version)}
    sizes: dict[str, int] = {}
    for table, part in entries:
        if table == kind.table:
            run = part.split("/")[0]
            sizes[run] = int(run.split("-")[0])
    if len(sizes) > 1 and (sum(sizes.values()) - max(sizes.values())) * FOLD > max(sizes.values()):
        whole = kind.totals(read(spark, root, entries, kind))
        folded = _run(root, kind, whole, f"{version}f")
        entries = {k: p for k, p in entries.items() if k[0] != kind.table} | folded
    return entries


def _run(root: str, kind: Signed, rows: DataFrame, version: str) -> versions.Entries:
    if not kind.bucketed:
        n, parts = versions.stage(rows, root, kind.table, version)
        return {(kind.table, f"{n}-{version}"): path for path in parts.values()}
    placed = rows.withColumn("bucket", kind.bucket())
    n, parts = versions.stage(placed, root, kind.table, version, "bucket")
    return {(kind.table, f"{n}-{version}/{b}"): path for b, path in parts.items()}
