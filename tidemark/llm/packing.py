"""Packing documents into sequences of a fixed length by best-two-fit on the histogram of lengths.

How many pieces there are of each length decides the packing, and that is a table of at most
``width`` rows whatever the corpus. The bins are therefore laid out once, as patterns with a
multiplicity; every piece then finds its place from its number among the pieces of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from tidemark.llm import tokens
from tidemark.llm.shared import cut, ship

WIDTH = 1024


def pieces(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH, path: str | None = None, ids: bool = False) -> DataFrame:
    """Rows ``(doc_id, piece, start, length, ids_crc32)`` and, if asked for, ``ids`` as bytes.

    Texts are encoded whole, with the end id. Only documents longer than ``width`` are cut, into
    pieces of ``width`` of which the first takes the remainder. A null text is the end id alone.
    """
    ship(docs.sparkSession)
    path = path or tokens.vocabulary_path()
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("ids", pa.binary())] if ids else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for whole in tokens.encode([t.as_py()], path):
                    n = len(whole) // 4
                    first = (n - 1) % width + 1
                    for i in range((n - 1) // width + 1):
                        a, b = (first + (i - 1) * width if i else 0), first + i * width
                        part = whole[4 * a : 4 * b]
                        rows.append((key, i, a, b - a, zlib.crc32(part), part)[: len(fields)])
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)] if rows else [pa.array([], k) for _, k in fields], names=[n for n, _ in fields])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if ids else "")
    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, schema)


def patterns(counts: dict[int, int], width: int = WIDTH) -> list[tuple[tuple[int, ...], int]]:
    """Bins for ``counts[length]`` pieces of each length, as (lengths of a bin, number of such bins).

    A bin is filled greedily, the longest piece that fits first. Then its smallest piece is
    replaced by two that are left, if two fit the gap so expanded more tightly. The bin is used
    as often as the counts allow, so every turn uses up a length and the list stays short.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    out: list[tuple[tuple[int, ...], int]] = []
    lengths = sorted(left)
    while lengths:
        used: dict[int, int] = {}
        items: list[int] = []
        gap = width
        at = len(lengths) - 1
        while at >= 0:
            n = lengths[at]
            if n > gap:
                at = bisect_right(lengths, gap, 0, at) - 1
                continue
            if left[n] > used.get(n, 0):
                used[n] = used.get(n, 0) + 1
                items.append(n)
                gap -= n
            else:
                at -= 1
        if gap and len(items) > 1:
            small = items[-1]
            room = gap + small
            free = lambda n: left.get(n, 0) - used.get(n, 0)  # noqa: B023, E731
            best = (small, 0, 0)
            i, j = 0, bisect_right(lengths, room) - 1
            while i <= j:
                a, b = lengths[i], lengths[j]
                if a + b > room:
                    j -= 1
                    continue
                enough = free(a) > 1 if a == b else free(a) > 0 and free(b) > 0
                if enough and a + b > best[0]:
                    best = (a + b, b, a)
                # the pair with the largest sum may need the neighbour of a length that is used up
                if free(b) <= 0:
                    j -= 1
                else:
                    i += 1
            if best[1]:
                items = [*items[:-1], best[1], best[2]]
                used[small] -= 1
                for n in best[1:]:
                    used[n] = used.get(n, 0) + 1
        used = {n: k for n, k in used.items() if k}
        times = min(left[n] // k for n, k in used.items())
        out.append((tuple(items), times))
        for n, k in used.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
        lengths = sorted(left) if any(n not in left for n in used) else lengths
    return out


def _places(bins: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[list[int], list[tuple[int, int]]]]:
    """For each length: first piece numbers of its runs, and (sequence of that first piece, offset)."""
    out: dict[int, tuple[list[int], list[tuple[int, int]]]] = {}
    seen: dict[int, int] = {}
    base = 0
    for items, times in bins:
        offset = 0
        for n in items:
            starts, where = out.setdefault(n, ([], []))
            starts.append(seen.get(n, 0))
            where.append((base, offset))
            seen[n] = seen.get(n, 0) + times
            offset += n
        base += times
    return out


def pack(parts: DataFrame, width: int = WIDTH) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to the pieces; ``length`` is between 1 and ``width``.

    Pieces are numbered within their length: by groups of a hash, so that a length that a third of
    all pieces has is dealt to many tasks, then by the groups' counts. Repeated rows are pieces of
    their own; which of them gets which place is arbitrary. No pieces give no rows. Other
    columns stay as they are.
    """
    spark = parts.sparkSession
    ship(spark)
    salts = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = parts.drop("sequence_id", "offset", "_salt", "_n", "_before", "_rank")
    salted = cut(parts.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int")))
    groups = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    counts = {r["length"]: r["n"] for r in groups.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    before = W.partitionBy("length").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    offsets = groups.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = salted.withColumn("_rank", F.row_number().over(W.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")))
    numbered = ranked.join(offsets, ["length", "_salt"]).withColumn("_rank", F.col("_rank") - 1 + F.col("_before"))
    names = parts.columns
    places = spark.sparkContext.broadcast(_places(patterns(counts, width)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, offs = [], []
            for n, rank in zip(batch.column("length").to_pylist(), batch.column("_rank").to_pylist(), strict=True):
                starts, where = places.value[n]
                k = bisect_right(starts, rank) - 1
                ids.append(where[k][0] + rank - starts[k])
                offs.append(where[k][1])
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(ids, pa.int64()), pa.array(offs, pa.int64())], names=[*names, "sequence_id", "offset"])

    schema = T.StructType([*parts.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return numbered.select(*parts.columns, "_rank").mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences as bytes of ids: ``packed`` must carry the pieces' ``ids``."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.aggregate(F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0))), F.col("parts")[0]["ids"], lambda a, x: F.concat(a, x["ids"])).alias("ids"))
