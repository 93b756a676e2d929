"""Keyed upserts and partition replacement as frame-to-frame operators."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed_upsert(
    current: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    keep_current: tuple[str, ...] = (),
) -> DataFrame:
    """Incoming rows replace current rows with the same key, new keys are added.

    Columns in ``keep_current`` keep an already stored value.
    """
    cur = current.withColumn("_stored", F.lit(True)).alias("cur")
    new = incoming.withColumn("_given", F.lit(True)).alias("new")
    joined = cur.join(new, keys, "full")
    merged = [F.col(k) for k in keys]
    for name in current.columns:
        if name in keys:
            continue
        old, fresh = F.col(f"cur.{name}"), F.col(f"new.{name}")
        value = (
            F.coalesce(old, fresh)
            if name in keep_current
            else F.when(F.col("_given"), fresh).otherwise(old)
        )
        merged.append(value.alias(name))
    return joined.select(*merged).select(*current.columns)


def replace_partitions(
    table: DataFrame, new: DataFrame, partition_col: str, affected_values: Iterable
) -> DataFrame:
    """Drop every affected partition of ``table``, then add ``new``.

    An affected value without new rows ends up empty.
    """
    kept = table.filter(~F.col(partition_col).isin(list(affected_values)))
    return kept.unionByName(new)
