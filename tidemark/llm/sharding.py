"""Histogram sort: byte-balanced shards from exact counts below refined key boundaries.

Only DataFrame functions are used. The key of a row is 168 bits: 56 of the hash of its text, then
56 of its id, so equal texts stand together and a very frequent text can still be split, then 56 that
tell repeated rows apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.shared import cut

#: Bits that one round of probes adds to a boundary; rounds until all three parts of a key are used up.
STEP = 8
HALF = 56
KEY = ["_k1", "_k2", "_k3"]
#: Leading bits of the key by which a row looks up the bounds near it.
CELL = 12
#: Parts of a shard, each ordered by a task of its own.
PARTS = 8


def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Adds ``size`` (UTF-8 bytes and 16 more), ``text_crc32`` and the key halves ``_k1`` and ``_k2``."""
    t = F.coalesce(F.col(text), F.lit(""))
    low = F.lit((1 << HALF) - 1)
    return (
        docs.withColumn("size", (F.octet_length(t) + F.lit(16)).cast("long"))
        .withColumn("text_crc32", F.crc32(F.encode(t, "UTF-8")))
        .withColumn("_k1", F.xxhash64(t).bitwiseAND(low))
        .withColumn("_k2", F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(1)).bitwiseAND(low))
    )


def told_apart(rows: DataFrame) -> DataFrame:
    """Adds ``_k3``: 0 for a row whose key no other has, else a number drawn for the row.

    Rows with repeated keys are written with their numbers, so that a task that runs again finds
    the same ones.
    """
    repeated = cut(rows.groupBy("_k1", "_k2").agg(F.count("*").alias("n")).where("n > 1").select("_k1", "_k2"))
    if repeated.isEmpty():
        return rows.withColumn("_k3", F.lit(0).cast("long"))
    drawn = F.xxhash64(F.monotonically_increasing_id(), F.lit(3)).bitwiseAND(F.lit((1 << HALF) - 1))
    several = cut(rows.join(repeated, ["_k1", "_k2"], "left_semi").withColumn("_k3", drawn))
    return rows.join(repeated, ["_k1", "_k2"], "left_anti").withColumn("_k3", F.lit(0).cast("long")).unionByName(several)


def _digit(level: int) -> Column:
    """The STEP bits of the key that the given round looks at."""
    part, at = divmod(level, HALF // STEP)
    return F.shiftright(F.col(KEY[part]), HALF - STEP * (at + 1)).bitwiseAND(F.lit((1 << STEP) - 1))


def splitters(rows: DataFrame, parts: int, tolerance: float = 0.01) -> list[tuple[int, ...]]:
    """Lower key bounds of parts 1 to ``parts - 1``: of equal bytes but for ``tolerance`` of a part.

    A round counts the exact bytes below every candidate boundary of the cells that still hold a
    target and keeps the nearest; its result has at most ``parts`` times 256 rows, whatever
    the input. A target stays open while its nearest boundary is off by more than the
    tolerance and its cell holds several rows; a single document can't be split.
    """
    top = HALF * len(KEY) // STEP
    total = rows.agg(F.sum("size")).first()[0] or 0
    goals = {i: total * i / parts for i in range(1, parts)}
    done: dict[int, int] = {}
    cells: dict[tuple[int, ...], tuple[float, list[int]]] = {(): (0, list(goals))}
    for level in range(top):
        if not cells or not total:
            break
        path = [_digit(i) for i in range(level)]
        chosen = rows
        if level:
            chosen = rows.where(_in_cells(level, [_prefix(level, digits) for digits in cells]))
        got = chosen.groupBy(*[p.alias(f"d{i}") for i, p in enumerate(path)], _digit(level).alias("d")).agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
        counts: dict[tuple[int, ...], list[tuple[int, int, int]]] = {}
        for r in got:
            counts.setdefault(tuple(r[:level]), []).append((r["d"], r["b"], r["n"]))
        following: dict[tuple[int, ...], tuple[float, list[int]]] = {}
        for digits, (below, open_goals) in cells.items():
            bins = sorted(counts.get(digits, []))
            for g in open_goals:
                at = below
                for d, b, n in bins:
                    if at + b >= goals[g]:
                        lower, upper = goals[g] - at, at + b - goals[g]
                        if min(lower, upper) <= tolerance * total / parts or n == 1 or level == top - 1:
                            done[g] = _bound((*digits, d + (upper < lower)), level)
                        else:
                            following.setdefault((*digits, d), (at, []))[1].append(g)
                        break
                    at += b
        cells = following
    full = 1 << (len(KEY) * HALF)
    return [_parts(min(done.get(g, full), full)) for g in goals]


def _parts(value: int) -> tuple[int, ...]:
    """The three parts of a key; the first holds what is above all keys."""
    low = (1 << HALF) - 1
    return value >> (2 * HALF), value >> HALF & low, value & low


def _bound(digits: tuple[int, ...], level: int) -> int:
    value = 0
    for d in digits:
        value = (value << STEP) + d
    return value << (len(KEY) * HALF - STEP * (level + 1))


def _prefix(level: int, digits: tuple[int, ...]) -> tuple[int, ...]:
    return _parts(_bound(digits, level - 1))


def _in_cells(level: int, cells: list[tuple[int, ...]]) -> Column:
    """Rows whose key begins as one of the given cells does."""
    part, rest = divmod(STEP * level - 1, HALF)
    shift = HALF - 1 - rest
    by: dict[tuple[int, ...], list[int]] = {}
    for cell in cells:
        by.setdefault(cell[:part], []).append(cell[part] >> shift)
    found = F.lit(False)
    for whole, some in by.items():
        same = F.shiftright(KEY[part], shift).isin(some)
        for name, value in zip(KEY, whole, strict=False):
            same = same & (F.col(name) == value)
        found = found | same
    return found


def shard(docs: DataFrame, shards: int = 40, text: str = "text", doc_id: str = "doc_id", tolerance: float = 0.01) -> DataFrame:
    """Adds ``size, text_crc32, law, shard, slot, grown_shard`` under the law ``bytes``.

    Splitters are found for ``PARTS`` times ``shards`` parts, so that no task orders a whole
    shard; every ``PARTS``-th is a shard's bound. Rows are then exchanged once, by part, and
    numbered in key order within the shard. Null texts count 16 bytes; null ids are one
    id; repeated rows stand together in any order and are split like others; no rows give no rows. ``grown_shard`` is
    null, as one shard more moves all bounds. Columns of the caller with a result's name
    are replaced.
    """
    docs = docs.drop("size", "text_crc32", "law", "shard", "slot", "grown_shard", "_k1", "_k2", "_k3", "_part", "_row", "_start", "_n")
    rows = told_apart(keyed(docs, text, doc_id))
    spark = docs.sparkSession
    bounds = splitters(cut(rows.select(*KEY, "size")), shards * PARTS, tolerance)
    near: dict[int, list[tuple[int, ...]]] = {}
    for b in bounds:
        near.setdefault(b[0] >> (HALF - CELL), []).append(b)
    cells, passed = [], 0
    for c in range(1 << CELL):
        cells.append((c, passed, near.get(c, [])))
        passed += len(near.get(c, []))
    # 4,096 rows and the bounds, whatever the input
    looked = F.broadcast(spark.createDataFrame(cells, "_cell int, _base int, _near array<struct<a: long, b: long, c: long>>"))
    over = F.size(F.filter("_near", lambda x: F.struct(*KEY) >= F.struct(x["a"].alias("_k1"), x["b"].alias("_k2"), x["c"].alias("_k3"))))
    part = F.col("_base") + over
    rows = rows.withColumn("_cell", F.shiftright("_k1", HALF - CELL).cast("int")).join(looked, "_cell")
    rows = rows.withColumn("_part", part).drop("_cell", "_base", "_near").withColumn("shard", F.floor(F.col("_part") / PARTS).cast("int"))
    sums = rows.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
    before = W.partitionBy("shard").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    order = W.partitionBy("shard", "_part").orderBy(*KEY, "text_crc32", "size")
    placed = rows.withColumn("_row", F.row_number().over(order))
    return (
        placed.join(starts, ["shard", "_part"])
        .withColumn("slot", (F.col("_start") + F.col("_row") - 1).cast("long"))
        .withColumn("law", F.lit("bytes"))
        .withColumn("grown_shard", F.lit(None).cast("int"))
        .drop(*KEY, "_part", "_row", "_start")
    )
