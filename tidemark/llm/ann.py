"""Approximate nearest neighbours by a forest of random-projection trees.

A tree splits by the sign of a random projection against its median: one direction for each tree
and level, one threshold for each node. It is fitted on a bounded sample; its depth follows the
number of vectors, as far as the sample has members for each node. A query walks all
trees at once through one priority queue of margins, and leaf members are ranked exactly. How
many leaves a query probes is measured on the table: some queries are answered by a full
scan, and all probe as many leaves as reach the wanted share of those true neighbours.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.shared import cut, ship

TREES, LEAF, SEED = 24, 128, 7
#: Leaves that a query probes at least, and the share of true neighbours for which it probes more.
PROBES, RECALL = 256, 0.95
#: Queries that measure the number of probes, drawn by a hash of the vector.
PILOTS = 128
#: The most vectors that fit the trees, drawn by a hash of the vector.
SAMPLE = 65_536
#: Sample vectors that a leaf has at least in the mean; medians of fewer are noise.
FITTED = 8
#: Members of a leaf that one task ranks at most in the mean; larger leaves are dealt to several.
CROWD = 4096


class Forest:
    """Directions ``(trees, depth, dim)`` and thresholds ``(trees, 2 ** depth)`` in heap order from 1."""

    def __init__(self, sample: np.ndarray, depth: int, trees: int = TREES, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        self.depth, self.center = depth, sample.mean(0)
        self.directions = rng.standard_normal((trees, max(depth, 1), sample.shape[1]))
        self.directions /= np.linalg.norm(self.directions, axis=2, keepdims=True)
        self.cuts = np.zeros((trees, 1 << depth))
        moved = sample - self.center
        for t in range(trees):
            node = np.ones(len(sample), np.int64)
            for level in range(depth):
                x = moved @ self.directions[t, level]
                order = np.lexsort((x, node))
                at, first, n = np.unique(node[order], return_index=True, return_counts=True)
                values = x[order]
                self.cuts[t, at] = (values[first + (n - 1) // 2] + values[first + n // 2]) / 2
                node = 2 * node + (x > self.cuts[t, node])

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree."""
        moved = vectors - self.center
        out = np.empty((len(vectors), len(self.cuts)), np.int64)
        for t, cuts in enumerate(self.cuts):
            node = np.ones(len(vectors), np.int64)
            for level in range(self.depth):
                node = 2 * node + (moved @ self.directions[t, level] > cuts[node])
            out[:, t] = node
        return out

    def probes(self, vector: np.ndarray, count: int) -> list[tuple[int, int]]:
        """The ``count`` nearest (tree, leaf) pairs: least by the largest margin crossed on the way."""
        x = self.directions @ (vector - self.center)
        queue = [(0.0, t, 1, 0) for t in range(len(self.cuts))]
        found: list[tuple[int, int]] = []
        while queue and len(found) < count:
            margin, t, node, level = heapq.heappop(queue)
            while level < self.depth:
                gap = x[t, level] - self.cuts[t, node]
                heapq.heappush(queue, (max(margin, abs(gap)), t, 2 * node + (gap <= 0), level + 1))
                node, level = 2 * node + (gap > 0), level + 1
            found.append((t, node))
        return found

    def margins(self, vector: np.ndarray) -> np.ndarray:
        """The largest margin crossed on the way to each leaf, ``(trees, leaves)``: the order of ``probes``."""
        x = self.directions @ (vector - self.center)
        out = np.zeros((len(self.cuts), 1))
        for level in range(self.depth):
            gap = x[:, level, None] - self.cuts[:, 1 << level : 2 << level]
            sides = [np.where(gap > 0, np.maximum(out, np.abs(gap)), out), np.where(gap > 0, out, np.maximum(out, np.abs(gap)))]
            out = np.stack(sides, axis=2).reshape(len(out), -1)
        return out

    def needed(self, vector: np.ndarray, near: np.ndarray) -> np.ndarray:
        """How many probes of ``vector`` reach each of the ``near`` vectors in one tree at least."""
        margins = self.margins(vector)
        first = margins[np.arange(len(margins)), self.leaves(near) - (1 << self.depth)].min(1)
        return np.searchsorted(np.sort(margins, axis=None), first, side="right")


def depth_for(total: int, sampled: int, leaf: int) -> int:
    """Levels for leaves of about ``leaf`` vectors, stopped where the sample would leave nodes without members."""
    return max(0, min(round(np.log2(total / leaf)), int(np.log2(max(1, sampled / min(FITTED, leaf))))))


def probes_for(forest: Forest, near: list[tuple[list, list]], least: int, recall: float) -> int:
    """The fewest probes, ``least`` at least, that find the share ``recall`` of true neighbours.

    ``near`` has ``(vector, true neighbours)`` of each pilot query.
    """
    found = [forest.needed(np.array(v), np.array(own)) for v, own in near if len(own)]
    if not found:
        return least
    return max(least, int(np.quantile(np.concatenate(found), recall, method="higher")))


def _pilots(items: DataFrame, asked: DataFrame, k: int, count: int) -> list[tuple[list, list]]:
    """``(vector, its k nearest other vectors)`` of ``count`` of the queries at most, by one scan of all vectors."""
    drawn = [(r["digest"], r["vector"]) for r in asked.orderBy(F.xxhash64("digest", F.lit(SEED + 1)), "digest").limit(count).collect()]
    if not drawn:
        return []
    own, q = np.array([d for d, _ in drawn], np.int64), np.array([v for _, v in drawn], np.float64)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            m, names = np.array(batch["vector"].tolist(), np.float64), batch["digest"].to_numpy()
            # half the squared distance, less what is the same for all members
            d = (m**2).sum(1)[None, :] / 2 - q @ m.T
            d[own[:, None] == names[None, :]] = np.inf
            best = np.argpartition(d, min(k, len(m)) - 1, axis=1)[:, :k]
            r, c = np.repeat(np.arange(len(q)), best.shape[1]), best.reshape(-1)
            fine = d[r, c] < np.inf
            r, c = r[fine], c[fine]
            yield pd.DataFrame({"pilot": r, "score": d[r, c], "digest": names[c], "vector": list(m[c])})

    close = items.select("digest", "vector").mapInPandas(nearest, "pilot int, score double, digest long, vector array<double>")
    order = W.partitionBy("pilot").orderBy("score", "digest")
    kept = close.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).select("pilot", "vector").collect()
    return [(v, [r["vector"] for r in kept if r["pilot"] == i]) for i, (_, v) in enumerate(drawn)]


def _classes(vectors: DataFrame, vec_id: str, embedding: str, k: int) -> DataFrame:
    """Valid vectors, equal ones as one row ``(vector, digest, ids)`` with their ``k + 1`` smallest ids.

    Further copies can't be among the ``k`` nearest of any query: they are as near as these with
    larger ids. Sets of ids are merged by repeated aggregation: by a hash of the id, then whole.
    """
    double = F.col(embedding).cast("array<double>")
    fine = F.col(embedding).isNotNull() & F.col(vec_id).isNotNull() & F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(double, lambda x: x != 0)
    # -0.0 + 0.0 is 0.0, so equal vectors have equal digests
    rows = vectors.where(fine).select(F.col(vec_id).cast("long").alias("id"), F.transform(double, lambda x: x + F.lit(0.0)).alias("vector"))
    keyed = rows.withColumn("digest", F.xxhash64("vector")).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    small = lambda c: F.slice(F.sort_array(c), 1, k + 1)
    some = keyed.groupBy("digest", "salt").agg(F.first("vector").alias("vector"), small(F.collect_set("id")).alias("ids"))
    return some.groupBy("digest").agg(F.first("vector").alias("vector"), small(F.flatten(F.collect_list("ids"))).alias("ids"))


def search(vectors: DataFrame, is_query, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 10, trees: int = TREES, leaf: int = LEAF, probes: int = PROBES, recall: float = RECALL) -> DataFrame:
    """Rows ``(query_id, rank, vec_id, score)``: the ``k`` nearest found of every row for which ``is_query`` holds.

    The score is the Euclidean distance of the original vectors, in double precision; ties go to the
    smaller id and a query isn't its own neighbour. Null, zero and non-finite vectors, and rows
    with a null id, take no part; vectors of another length than most common are refused.
    A query probes ``probes`` leaves, and more where ``PILOTS`` queries need more to find the share
    ``recall`` of their true neighbours. If all vectors fit these leaves, the search is exact.
    Repeated rows of an id count once.
    """
    spark = vectors.sparkSession
    ship(spark)
    items = cut(_classes(vectors, vec_id, embedding, k))
    total = items.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not total:
        return empty
    sample = items.orderBy(F.xxhash64("digest", F.lit(SEED))).limit(SAMPLE).select("vector")
    matrix = np.array([r[0] for r in sample.toLocalIterator()], np.float64)
    fitted = Forest(matrix, depth_for(total, len(matrix), leaf), trees)
    forest = spark.sparkContext.broadcast(fitted)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                found = forest.value.leaves(np.array(batch["vector"].tolist(), np.float64))
                n, t = found.shape
                yield pd.DataFrame({"digest": np.repeat(batch["digest"].to_numpy(), t), "tree": np.tile(np.arange(t), n), "leaf": found.reshape(-1)})

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(d, t, n) for d, v in zip(batch["digest"], batch["vector"], strict=True) for t, n in forest.value.probes(np.array(v, np.float64), probes)]
            yield pd.DataFrame(rows, columns=["digest", "tree", "leaf"])

    def rank(key: tuple, members: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        columns = ["query", "digest", "score"]
        if not len(members) or not len(asked):
            return pd.DataFrame({c: [] for c in columns}).astype({"query": "int64", "digest": "int64", "score": "float64"})
        m, q = np.array(members["vector"].tolist(), np.float64), np.array(asked["vector"].tolist(), np.float64)
        out = []
        for at in range(0, len(q), 256):
            part = q[at : at + 256]
            # exact differences in slices: the short cut over dot products loses digits for near vectors
            d = np.stack([np.sqrt(((m - x) ** 2).sum(1)) for x in part])
            best = np.argsort(d, axis=1, kind="stable")[:, : k + 1]
            # all that tie with the last stay, their smaller ids decide later
            last = np.take_along_axis(d, best[:, -1:], 1)
            r, c = np.nonzero(d <= last)
            out.append(pd.DataFrame({"query": asked["digest"].to_numpy()[at + r], "digest": members["digest"].to_numpy()[c], "score": d[r, c]}))
        return pd.concat(out)

    double = F.transform(F.col(embedding).cast("array<double>"), lambda x: x + F.lit(0.0))
    of_query = vectors.where(is_query).select(F.col(vec_id).cast("long").alias("query_id"), F.xxhash64(double).alias("digest")).where("query_id IS NOT NULL").distinct()
    asked = items.join(of_query.select("digest").distinct(), "digest", "left_semi").select("digest", "vector")
    if probes < trees << fitted.depth:
        asked = cut(asked)
        probes = probes_for(fitted, _pilots(items, asked, k, PILOTS), probes, recall)
    schema = "digest long, tree int, leaf long"
    placed = items.select("digest", "vector").mapInPandas(assign, schema)
    crowds = placed.groupBy("tree", "leaf").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("tree", "leaf", F.ceil(F.col("n") / CROWD).alias("deal"))
    crowds = cut(crowds)
    share = lambda frame: frame.join(crowds, ["tree", "leaf"], "left").withColumn("deal", F.coalesce("deal", F.lit(1)))
    members = share(placed).withColumn("part", F.pmod(F.xxhash64("digest"), F.col("deal"))).join(items.select("digest", "vector"), "digest")
    routed = share(asked.mapInPandas(route, schema)).withColumn("part", F.explode(F.expr("sequence(0L, deal - 1)"))).join(asked, "digest")
    group = ["tree", "leaf", "part"]
    ranked = members.groupBy(*group).cogroup(routed.groupBy(*group)).applyInPandas(rank, "query long, digest long, score double")
    best = ranked.distinct().join(items.select("digest", "ids"), "digest")
    named = best.join(of_query.select("query_id", F.col("digest").alias("query")), "query")
    near = named.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
