"""Mixing sources to target weights by balanced sampling with the cube method."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.shared import SPACES, cut, ship

#: Rows that one flight takes at most in the mean; leftovers of that many blocks meet in the next flight.
BLOCK = 4_000
#: Open items of a source, of all sizes, that are kept for the landing.
LANDING = 12
#: Repeated rows that are numbered together, about.
GROUP = 10_000


def word_count(text):
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{SPACES}|{SPACES}$", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACES))).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """Adds ``source_no`` and ``target`` to rows ``(source, source_size)``, one for each source.

    Sources are numbered in code-point order, null last, and weigh what ``weights`` repeat. The total is
    shared by weight; a target stops at ``most`` times its source's size and the excess is
    shared again by weight among the others until none is above. The driver sees two totals a round.
    """
    part = cut(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = part.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(W.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    numbered = part.withColumn("rank", rank).join(starts, "part").withColumn("source_no", (F.col("start") + F.col("rank") - 1).cast("long"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights)).cast("int") + 1)
    known = cut(numbered.select("source", "source_size", "source_no", weight.alias("w"), (most * F.col("source_size")).alias("most")))
    total = float(known.agg(F.sum("source_size")).first()[0] or 0)
    full, rest, free = F.lit(False), total, known.agg(F.sum("w")).first()[0] or 1
    stopped = -1
    while True:
        # what was above stays fixed: the others' share only grows
        full = full | (F.lit(rest) * F.col("w") / F.lit(free) > F.col("most"))
        row = known.agg(F.count_if(full).alias("n"), F.sum(F.when(full, F.col("most"))).alias("fixed"), F.sum(F.when(~full, F.col("w"))).alias("free")).first()
        if row["n"] == stopped or not row["free"]:
            break
        stopped, rest, free = row["n"], total - (row["fixed"] or 0.0), row["free"]
    share = F.when(full, F.col("most")).otherwise(F.lit(rest) * F.col("w") / F.lit(free))
    return known.select("source", "source_size", "source_no", share.cast("double").alias("target"))


def _fly(p: list[float], size: list[float], rng: random.Random) -> list[int]:
    """The flight phase, in place: moves ``p`` until at most two items are strictly between 0 and 1.

    Three open items and two balancing totals (items and tokens) leave one direction in which
    both totals stay; a random step along it, with mean zero, settles at least one item.
    """
    eps = 1e-9
    todo = [i for i, x in enumerate(p) if eps < x < 1 - eps]
    held: list[int] = []
    for k in todo:
        held.append(k)
        while len(held) >= 3:
            a, b, c = held
            u = [size[b] - size[c], size[c] - size[a], size[a] - size[b]]
            if not any(u):
                u = [1.0, -1.0, 0.0]
            up = min((1 - p[i]) / x if x > 0 else -p[i] / x for i, x in zip(held, u, strict=True) if x)
            down = min(p[i] / x if x > 0 else (p[i] - 1) / x for i, x in zip(held, u, strict=True) if x)
            step = up if rng.random() * (up + down) < down else -down
            for i, x in zip(held, u, strict=True):
                p[i] = min(1.0, max(0.0, p[i] + step * x))
                if p[i] < eps or p[i] > 1 - eps:
                    p[i] = round(p[i])
            held = [i for i in held if 0 < p[i] < 1]
    return held


def _settle(p: list[float], size: list[float], heavy: list[int], others: list[int], rng: random.Random) -> None:
    """Flies the ``heavy`` items to 0 or 1, in place, each against all open ``others`` together.

    In steps of three, short items settle while a long one hardly moves, and it stays open until
    nothing can make up for it. A step here moves all others a little, along a direction in which
    both totals stay; its mean is zero too. An item that the others can't balance stays open.
    """
    eps, x, s = 1e-9, np.array(p), np.array(size)
    for a in heavy:
        while eps < x[a] < 1 - eps:
            near = np.array([i for i in others if 0 < x[i] < 1], np.int64)
            w = x[near] * (1 - x[near])
            mean = (w * s[near]).sum() / w.sum() if len(near) else 0.0
            spread = (w * (s[near] - mean) ** 2).sum()
            if len(near) < 3 or spread <= eps:
                break
            u = np.append(-w * (1 / w.sum() + (s[a] - mean) * (s[near] - mean) / spread), 1.0)
            at = np.append(near, a)
            moved, rate = u != 0, np.where(u == 0, 1.0, u)
            up = np.where(u > 0, (1 - x[at]) / rate, -x[at] / rate)[moved].min()
            down = np.where(u > 0, x[at] / rate, (x[at] - 1) / rate)[moved].min()
            step = up if rng.random() * (up + down) < down else -down
            x[at] = np.clip(x[at] + step * u, 0.0, 1.0)
            x[at] = np.where((x[at] < eps) | (x[at] > 1 - eps), x[at].round(), x[at])
    p[:] = x.tolist()


def _land(p: list[float], size: list[float], held: list[int]) -> None:
    """Settles the last open items, ``LANDING + 2`` at most, by the choice nearest to their expected tokens.

    Ties go to the number of items nearest to the expected one, then to the first choice.
    """
    if not held:
        return
    own, part = np.array([size[i] for i in held]), np.array([p[i] for i in held])
    choices = (np.arange(1 << len(held))[:, None] >> np.arange(len(held))) & 1
    tokens, items = np.abs(choices @ own - part @ own), np.abs(choices.sum(1) - part.sum())
    best = choices[np.lexsort((items.round(9), tokens.round(6)))[0]]
    for i, x in zip(held, best, strict=True):
        p[i] = float(x)


def _flight(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The flight of a block; a source's only block lands, others hand on their open items."""
    final = int(rows["blocks"].iloc[0]) == 1
    rows = rows.sort_values(["size", "order", "unit"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    p, size = rows["p"].tolist(), rows["size"].astype(float).tolist()
    rng = random.Random(zlib.crc32(repr((int(key[0]), int(key[1]), len(p))).encode()))
    # the longest settle first, while many others can make up for them
    heavy = LANDING if len(p) > 4 * LANDING else 0
    # items of all sizes wait for the landing, so that their sums come near any total
    waiting = sorted({heavy + (len(p) - heavy) * i // LANDING for i in range(LANDING)}) if p else []
    kept = [p[i] for i in waiting]
    for i in waiting:
        p[i] = 0.0
    if heavy:
        _settle(p, size, list(range(heavy)), list(range(heavy, len(p))), rng)
    held = _fly(p, size, rng)
    for i, x in zip(waiting, kept, strict=True):
        p[i] = x
    if final:
        _land(p, size, [*held, *waiting])
    return rows.assign(p=p)[["unit", "source_no", "size", "order", "p"]]


def sample(units: DataFrame) -> DataFrame:
    """Cube sampling of ``units (unit, source_no, size, order, p)``; returns ``(unit, picked)``.

    Every source flies in blocks of about ``BLOCK`` rows, dealt by ``order``. A block leaves two open
    items and the ``LANDING`` of all sizes that wait; these meet in ever fewer blocks until the
    source has one, which also lands, whatever blocks other sources still have. A source's tokens
    and items keep their expected totals but for the landing. Numbers of blocks are a table
    keyed by source; the driver sees the largest.
    """
    ship(units.sparkSession)
    schema = "unit long, source_no long, size long, order long, p double"
    open_rows = (F.col("p") > 0) & (F.col("p") < 1)
    level = cut(units.select("unit", F.col("source_no").cast("long").alias("source_no"), "size", "order", "p"))
    fly, settled = level.where(open_rows), [level.where(~open_rows)]
    blocks = cut(fly.groupBy("source_no").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / BLOCK)).cast("long").alias("blocks")))
    while True:
        most = blocks.agg(F.max("blocks")).first()[0]
        if most is None:
            break
        dealt = fly.join(blocks, "source_no").withColumn("block", F.pmod(F.xxhash64("order", F.lit(len(settled) - 1)), F.col("blocks")))
        flown = cut(dealt.groupBy("source_no", "block").applyInPandas(_flight, schema))
        settled.append(flown.where(~open_rows))
        if most == 1:
            break
        fly = flown.where(open_rows)
        fewer = F.greatest(F.lit(1), F.least(F.col("blocks") - 1, F.ceil((LANDING + 2) * F.col("blocks") / BLOCK)))
        blocks = cut(blocks.where("blocks > 1").select("source_no", fewer.cast("long").alias("blocks")))
    picked = settled[0]
    for more in settled[1:]:
        picked = picked.union(more)
    return picked.select("unit", F.col("p").cast("long").alias("picked"))


def plan(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """One row for each different ``(doc_id, source, text)``: how often the mix takes its rows.

    Columns: ``_unit`` (a 64-bit key of the three), ``doc_id, source, size, source_size, target``,
    ``rows`` (repeated rows) and ``picks`` (how often they are taken in all). A document's
    expected count is its source's target over its size; the whole part is certain, the
    fraction is settled by :func:`sample`. Only sizes and keys are exchanged, never texts.
    A null text has size 0, a null source is a source of its own, ordered last.
    """
    key = F.xxhash64(F.struct(doc_id, source).cast("string"), F.coalesce(F.col(text), F.lit("")), F.col(text).isNull())
    thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), key.alias("_unit"))
    units = cut(thin.groupBy("doc_id", "source", "size", "_unit").agg(F.count("*").alias("rows")))
    by_source = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).cast("long").alias("source_size"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    ratios = cut(targets(by_source, weights, most).withColumn("ratio", ratio))
    # both sides are written tables: a frequent source can be split
    joined = units.join(ratios, units["source"].eqNullSafe(ratios["source"])).drop(ratios["source"])
    expected = F.col("ratio") * F.col("rows")
    parts = joined.withColumn("sure", F.floor(expected + 1e-9)).withColumn("p", F.greatest(F.lit(0.0), expected - F.col("sure")))
    ready = parts.withColumn("p", F.when(F.col("p") < 1e-9, 0.0).otherwise(F.col("p")))
    picked = sample(ready.select(F.col("_unit").alias("unit"), "source_no", "size", F.xxhash64("_unit", F.lit(7)).alias("order"), "p"))
    return (
        ready.join(picked.select(F.col("unit").alias("_unit"), "picked"), "_unit")
        .withColumn("picks", (F.col("sure") + F.col("picked")).cast("long"))
        .select("_unit", "doc_id", "source", "size", "source_size", "target", "rows", "picks")
    )


def taken(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size, target, taken`` (words, repeats counted)."""
    each = plan(docs, **options).withColumn("i", F.explode(F.expr("sequence(1L, rows)")))
    times = F.floor(F.col("picks") / F.col("rows")) + (F.col("i") <= F.col("picks") % F.col("rows")).cast("long")
    return each.select("doc_id", "source", "size", "source_size", "target", (times * F.col("size")).cast("long").alias("taken"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", **options) -> DataFrame:
    """The mixed rows, with the columns of ``docs``; a row taken twice stands there twice.

    Repeated rows share their picks as evenly as whole numbers allow. Those of a key are told
    apart by a number within it, dealt in groups of about ``GROUP`` rows. The caller's columns travel in
    one struct, so none of their names can clash.
    """
    picks = cut(plan(docs, text, source, doc_id, **options).where("picks > 0").select("_unit", "rows", "picks"))
    key = F.xxhash64(F.struct(doc_id, source).cast("string"), F.coalesce(F.col(text), F.lit("")), F.col(text).isNull())
    # repeated rows are numbered in groups of a bounded size
    group = F.when(F.col("rows") > 1, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.ceil(F.col("rows") / GROUP)))
    # the one exchange of texts, by the same plan at every size; written, so that both ways read it and a group stays what it is
    joined = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"), key.alias("_unit")).join(picks.hint("merge"), "_unit")
    rows = cut(joined.withColumn("group", group))
    whole = F.floor(F.col("picks") / F.col("rows"))
    single = rows.where("rows = 1").select("own", F.col("picks").alias("times"))
    several = rows.where("rows > 1")
    sizes = several.groupBy("_unit", "group").agg(F.count("*").alias("n"))
    before = W.partitionBy("_unit").orderBy("group").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_unit", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    number = F.col("start") + F.row_number().over(W.partitionBy("_unit", "group").orderBy("rows"))
    numbered = several.join(starts, ["_unit", "group"]).withColumn("number", number)
    shared = numbered.select("own", (whole + (F.col("number") <= F.col("picks") % F.col("rows")).cast("long")).alias("times"))
    every = single.unionByName(shared).where("times > 0")
    return every.select("own", F.explode(F.expr("sequence(1L, times)")).alias("time")).select("own.*")
