"""Prefix trie of conversations in flat arrays, addressed by a minimal perfect hash.

A prefix is known by a 128-bit digest: the exclusive-or of one hash for every (place, role, text), so
digests of all prefixes come from running totals that can be taken in stretches. Distinct
digests are the nodes. A node is owned by its smallest member; the nodes of an owner are
the end of its path. Shards take stretches of owners' paths, and every weight is scattered in one
shard only, so totals of shards add up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import cut, ship

#: Conversations are rebuilt in families of so many neighbouring ids; a head has fewer turns than HEADS.
FAMILY, HEADS = 5, 9
#: Turns of one conversation that are ranked, and prefixes of one that are put into a shard, together.
STRETCH = 4096
#: Rows that a shard has, about.
SHARD = 50_000
#: Ids of members that end at a node travel in strings of at most so many.
IDS = 4096
ROOT = 0


def _turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows ``(conv, at, role, text)`` with the place from 0 of every turn in its conversation.

    Rows of one conversation are ranked in stretches of turn numbers, so a very long one is not
    sorted in one place; stretches before it add their counts.
    """
    named = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).withColumn("stretch", F.expr(f"turn div {STRETCH}"))
    counts = named.groupBy("conv", "stretch").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy(F.col("stretch").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).where("before > 0").select("conv", "stretch", "before")
    rank = F.row_number().over(Window.partitionBy("conv", "stretch").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    # a stretch without turn numbers comes first and has no start
    placed = named.withColumn("rank", rank.cast("long")).join(starts, ["conv", "stretch"], "left")
    return placed.select("conv", (F.coalesce("before", F.lit(0)) + F.col("rank") - 1).alias("at"), "role", "text")


def rebuilt(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: ``(conv, n)`` with their numbers of turns, and ``(conv, depth, a, b, bytes)``.

    ``a`` and ``b`` hash the turn at this depth, together with the depth. Conversation c begins with
    the first h turns of conversation ``c - c % 5`` (as many as there are), h being crc32(c) % 9, and
    goes on with its own turns after the first h.
    """
    turns = cut(
        _turns(rows, conv, turn, role, text).select(
            "conv", "at", F.xxhash64("role", "text").alias("x"), F.conv(F.substring(F.sha2(F.concat("role", F.lit("\0"), "text"), 256), 1, 15), 16, 10).cast("long").alias("y"), F.octet_length("text").cast("long").alias("bytes")
        )
    )
    sizes = cut(turns.groupBy("conv").agg(F.count("*").alias("own")))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).alias("h")
    first = sizes.select(F.col("conv").alias("base"), F.col("own").alias("there"))
    plan = sizes.select("conv", "own", (F.col("conv") - F.col("conv") % FAMILY).alias("base"), h).join(first, "base", "left")
    plan = cut(plan.select("conv", "own", "base", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("lent")))
    lengths = plan.select("conv", (F.col("lent") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n"))
    # a family has few members and a head few turns
    heads = turns.where((F.col("at") < HEADS) & (F.col("conv") % FAMILY == 0)).withColumnRenamed("conv", "base")
    lent = heads.join(plan.where("lent > 0").select("conv", "base", "lent"), "base").where("at < lent").select("conv", (F.col("at") + 1).alias("depth"), "x", "y", "bytes")
    own = turns.join(plan.select("conv", "h", "lent"), "conv").where("at >= h").select("conv", (F.col("at") - F.col("h") + F.col("lent") + 1).alias("depth"), "x", "y", "bytes")
    both = lent.union(own).select("conv", "depth", F.xxhash64("depth", "x", "y").alias("a"), F.xxhash64("y", "depth", "x").alias("b"), "bytes")
    return lengths, both


def _band() -> Column:
    return F.expr(f"greatest(depth - 1, 0) div {STRETCH}")


def prefixes(turns: DataFrame) -> DataFrame:
    """Rows ``(conv, depth, band, a, b, up_a, up_b, turn_a, turn_b, bytes)``: digest of each prefix and of the one before."""
    banded = turns.withColumn("band", _band())
    band = Window.partitionBy("conv", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    within = banded.select("conv", "depth", "band", F.bit_xor("a").over(band).alias("wa"), F.bit_xor("b").over(band).alias("wb"), F.col("a").alias("turn_a"), F.col("b").alias("turn_b"), "bytes")
    earlier = Window.partitionBy("conv").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    totals = banded.groupBy("conv", "band").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    starts = totals.select("conv", "band", F.bit_xor("a").over(earlier).alias("sa"), F.bit_xor("b").over(earlier).alias("sb")).where("band > 0")
    whole = within.join(starts, ["conv", "band"], "left")
    x = lambda w, s: F.col(w).bitwiseXOR(F.coalesce(s, F.lit(ROOT).cast("long")))
    made = whole.select("conv", "depth", "band", x("wa", "sa").alias("a"), x("wb", "sb").alias("b"), "turn_a", "turn_b", "bytes")
    return made.withColumn("up_a", F.col("a").bitwiseXOR(F.col("turn_a"))).withColumn("up_b", F.col("b").bitwiseXOR(F.col("turn_b")))


class Slots:
    """Minimal perfect hash of distinct 128-bit keys: slots 0 to n - 1.

    Keys that meet no other in a table of their level take its cell, the others go to the next
    level; a cell's slot is the number of taken cells before it. The keys stand at their
    slots, so a look-up is verified and an unknown key gives -1.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels: list[tuple[np.ndarray, int]] = []
        if pd.DataFrame({"a": a, "b": b}).duplicated().any():
            raise ValueError("keys of a slot table must be distinct")
        rest, start = np.arange(len(a)), 0
        while len(rest):
            cell = _cell(a[rest], b[rest], len(self.levels), 2 * len(rest))
            alone = np.bincount(cell, minlength=2 * len(rest)) == 1
            # number of taken cells up to each, 0 for those that aren't taken
            self.levels.append((np.where(alone, start + np.cumsum(alone), 0), 2 * len(rest)))
            start += int(alone.sum())
            rest = rest[~alone[cell]]
        self.a, self.b = np.zeros(start, np.int64), np.zeros(start, np.int64)
        at = self._find(a, b)
        self.a[at], self.b[at] = a, b
        if len(np.unique(at)) != len(a) or (self.a[at] != a).any() or (self.b[at] != b).any():
            raise AssertionError("two keys got one slot")

    def _find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        found = np.full(len(a), -1, np.int64)
        left = np.arange(len(a))
        for level, (taken, cells) in enumerate(self.levels):
            slot = taken[_cell(a[left], b[left], level, cells)]
            found[left[slot > 0]] = slot[slot > 0] - 1
            left = left[slot == 0]
        return found

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slots of the keys, -1 for unknown ones."""
        found = self._find(a, b)
        if not len(self.a):
            return found
        return np.where((found >= 0) & (self.a[found] == a) & (self.b[found] == b), found, -1)


def _cell(a: np.ndarray, b: np.ndarray, level: int, cells: int) -> np.ndarray:
    x = a.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) ^ b.astype(np.uint64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(cells)).astype(np.int64)


def accumulated(rows: pd.DataFrame, stretch: int) -> pd.DataFrame:
    """Totals ``(a, b, n_leaves, saved_tokens)`` of the subtrees of every node in a shard's rows.

    Rows are ``(a, b, up_a, up_b, depth, leaves, saved)``. Distinct digests get slots, weights are
    scattered into flat arrays, and levels of the tree, deepest first, are added to the slots of their
    parents. The first node of a later stretch has no parent here.
    """
    first = ~rows.duplicated(["a", "b"]).to_numpy()
    a, b, up_a, up_b, depth = (rows[c].to_numpy(np.int64) for c in ("a", "b", "up_a", "up_b", "depth"))
    slots = Slots(a[first], b[first])
    at = slots(a, b)
    n = int(first.sum())
    leaves, saved, level, parent = (np.zeros(n, np.int64) for _ in range(4))
    np.add.at(leaves, at, rows["leaves"].to_numpy(np.int64))
    np.add.at(saved, at, rows["saved"].to_numpy(np.int64))
    level[at] = depth
    up = slots(up_a, up_b)
    parent[at] = np.where((depth == 0) | ((depth > 1) & (depth % stretch == 1)), -1, up)
    order = np.argsort(-level, kind="stable")
    ends = np.flatnonzero(np.diff(level[order])) + 1
    for nodes in np.split(order, ends):
        inner = nodes[parent[nodes] >= 0]
        np.add.at(leaves, parent[inner], leaves[inner])
        np.add.at(saved, parent[inner], saved[inner])
    return pd.DataFrame({"a": slots.a, "b": slots.b, "n_leaves": leaves, "saved_tokens": saved})


def _shards(paths: DataFrame, owners: DataFrame, rows: int) -> DataFrame:
    """Totals ``(a, b, n_leaves, saved_tokens)`` of all nodes from the owners' paths, shard by shard.

    A path longer than a stretch is cut into bands. What lies deeper than a band is scattered at its
    last node, so no shard needs the whole path. A family's paths lie in one shard, where they share slots.
    """
    total = owners.groupBy("conv", _band().alias("band")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    below = Window.partitionBy("conv").orderBy(F.col("band").desc()).rowsBetween(Window.unboundedPreceding, -1)
    path = paths.join(owners.select("conv").distinct(), "conv", "left_semi").join(owners, ["conv", "depth"], "left")
    spans = path.groupBy("conv", "band").agg(F.max("depth").alias("depth"))
    long = spans.groupBy("conv").agg(F.max("band").alias("last")).where("last > 0").select("conv")
    every = spans.join(long, "conv", "left_semi").join(total, ["conv", "band"], "left")
    carried = every.select(
        "conv", "depth", F.coalesce(F.sum("leaves").over(below), F.lit(0)).alias("more_leaves"), F.coalesce(F.sum("saved").over(below), F.lit(0)).alias("more_saved")
    )
    full = path.join(carried, ["conv", "depth"], "left")
    plus = lambda x, y: (F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))
    many = max(paths.sparkSession.sparkContext.defaultParallelism, -(-rows // SHARD))
    shard = F.pmod(F.xxhash64(F.col("conv") - F.col("conv") % FAMILY, "band"), F.lit(many))
    dealt = full.select(shard.alias("shard"), "a", "b", "up_a", "up_b", "depth", plus("leaves", "more_leaves").alias("leaves"), plus("saved", "more_saved").alias("saved"))
    stretch = STRETCH
    made = dealt.groupBy("shard").applyInPandas(lambda rows: accumulated(rows, stretch), "a long, b long, n_leaves long, saved_tokens long")
    return made.groupBy("a", "b").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


def _ends(last: DataFrame) -> DataFrame:
    """Rows ``(a, b, ends_sha256)`` from ``(conv, a, b)``: the hash of the ids that end at each node, ascending.

    A hash is taken over a whole list in order, so its strings pass one task, a bounded string at a time.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])
    listed = last.groupBy("a", "b", F.expr(f"conv div {IDS}").alias("part")).agg(F.array_sort(F.collect_list("conv")).alias("ids"))
    joined = listed.select("a", "b", "part", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done: list[tuple] = []
            for a, b, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if (a, b) != node:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = (a, b), hashlib.sha256(ids.encode())
                else:
                    digest.update(f",{ids}".encode())
            yield _batch(done, schema)
        if node is not None:
            yield _batch([(*node, digest.hexdigest())], schema)

    return joined.repartition("a", "b").sortWithinPartitions("a", "b", "part").select("a", "b", "ids").mapInArrow(run, "a long, b long, ends_sha256 string")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def trie(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Nodes of the prefix trie of the rebuilt conversations, one row each.

    Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (bytes) and ``ends_sha256``. Turns are in order of their number,
    null first; ties go by role, then text, so repeated rows are turns of their own. A null role
    or text is empty; rows without a conversation id are left out; other columns have no effect; for
    negative ids % takes the sign of the id, as in SQL.
    No rows give no nodes, not even the root.

    Members of a node are counted before anything is exchanged, so a first turn or a whole
    conversation that most share is one row of each task. A digest that stands for two
    prefixes would have two turns or two parents and raises an error.
    """
    ship(rows.sparkSession)
    lengths, turns = rebuilt(rows, conv, turn, role, text)
    lengths = cut(lengths)
    paths = cut(prefixes(turns))
    least, most = (lambda c: F.min(c).alias(c)), (lambda c: F.max(c).alias(f"{c}_"))
    same = ["up_a", "up_b", "turn_a", "turn_b", "depth", "bytes"]
    nodes = paths.groupBy("a", "b").agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv"), *[least(c) for c in same], *[most(c) for c in same])
    clash = ~F.concat(*[(F.col(c) == F.col(f"{c}_")).cast("string") for c in same]).eqNullSafe(F.lit("true" * len(same)))
    depth = F.when(clash, F.raise_error(F.lit("two prefixes have one digest")).cast("long")).otherwise(F.col("depth"))
    inner = nodes.select("a", "b", "conv", depth.alias("depth"), "up_a", "up_b", "n_convs", "bytes")
    top = lengths.groupBy().agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv")).where("n_convs > 0")
    zero = F.lit(ROOT).cast("long")
    root = top.select(zero.alias("a"), zero.alias("b"), "conv", zero.alias("depth"), zero.alias("up_a"), zero.alias("up_b"), "n_convs", zero.alias("bytes"))
    nodes = cut(inner.union(root))
    children = cut(nodes.where("depth > 0").groupBy("up_a", "up_b").agg(F.count("*").alias("n_children")).select(F.col("up_a").alias("a"), F.col("up_b").alias("b"), "n_children"))
    nodes = cut(nodes.join(children, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")))
    weights = nodes.select("conv", "depth", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    # the root is the first node of every path
    tops = lengths.select("conv", zero.alias("depth"), zero.alias("band"), *[zero.alias(c) for c in ("a", "b", "up_a", "up_b")])
    whole = tops.unionByName(paths.select("conv", "depth", "band", "a", "b", "up_a", "up_b"))
    totals = _shards(whole, weights, paths.count())
    last = lengths.join(paths.select("conv", F.col("depth").alias("n"), "a", "b"), ["conv", "n"], "left").select("conv", F.coalesce("a", F.lit(ROOT)).alias("a"), F.coalesce("b", F.lit(ROOT)).alias("b"))
    # parents of one owner's nodes are its own, but for the first of them
    start = nodes.groupBy("conv").agg(F.min("depth").alias("start"))
    chained = nodes.join(start, "conv")
    attached = chained.where((F.col("depth") == F.col("start")) & (F.col("depth") > 0)).select("a", "b", "up_a", "up_b")
    parents = cut(attached.join(nodes.join(children.select("a", "b"), ["a", "b"], "left_semi").select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv").alias("above")), ["up_a", "up_b"]).select("a", "b", "above"))
    full = chained.join(totals, ["a", "b"]).join(_ends(last), ["a", "b"], "left").join(parents, ["a", "b"], "left")
    return full.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.when(F.col("depth") > 0, F.coalesce("above", "conv")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
