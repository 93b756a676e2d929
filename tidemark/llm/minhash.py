"""Near-duplicate classes by SetSketch registers.

A sketch has ``BANDS * ROWS`` registers. Every shingle drives a Poisson process of points, each
of which falls on a random register; a register is the minimum over all shingles, kept as its
truncated logarithm to base ``BASE``. Registers merge by maximum and agree more often the more
alike two sets are, so bands of them find candidates. A joint likelihood of the registers
drops clear strangers, and full shingle sets confirm every link.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected
from tidemark.llm.shared import cut, ship

BANDS, ROWS = 32, 6
BASE, LIMIT = 1.02, 65534
#: Rate of the smallest value that a register can tell apart; sets of up to some 10^15 shingles fit.
RATE = 20.0
WIDTH = 5
#: Orders in which a bucket's hub is the first member; a bucket's key names its order.
ORDERS = [0x5DEECE66D1A2B3C4, 0x2545F4914F6CDD1D, 0x369DEA0F31A53F85, 0x1B873593CC9E2D51]
#: Members of a bucket, and shingles of such members, that stand in one piece, about.
MEMBERS, SHINGLES = 512, 200_000
#: A pair is linked if 100 * common >= PERCENT * union.
PERCENT = 80
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
_LOG = np.log(BASE)


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; a shorter text is one shingle."""
    found = WORD.findall(text.translate(LOWER)) if text else []
    if not found:
        return np.empty(0, np.uint64)
    if len(found) < width:
        return np.array([xxhash.xxh3_64_intdigest(" ".join(found))], np.uint64)
    # a hash of word hashes in order: one vector operation for each place in the shingle
    seen: dict[str, int] = {}
    h = np.array([seen.get(w) or seen.setdefault(w, xxhash.xxh3_64_intdigest(w) | 1) for w in found], np.uint64)
    n = len(h) - width + 1
    mixed = np.zeros(n, np.uint64)
    for i in range(width):
        mixed = _mix(mixed ^ h[i : i + n])
    return np.unique(mixed)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def registers(sets: list[np.ndarray], m: int = BANDS * ROWS) -> np.ndarray:
    """Registers of the sets, one row of ``m`` 16-bit numbers each. No set may be empty.

    Points of all sets are drawn together, one more of every live shingle a round. A shingle
    is live while its last point lies below the largest minimum of its set's registers.
    """
    low = np.full((len(sets), m), np.inf)
    state = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    point = np.zeros(len(state))
    flat = low.reshape(-1)
    while len(state):
        state = _mix(state + np.uint64(0x9E3779B97F4A7C15))
        # 40 bits of the hash give the distance to the next point, the others the register
        point = point - np.log(((state >> np.uint64(24)).astype(np.float64) + 0.5) / 2.0**40) / (RATE * m)
        place = ((state & np.uint64(0xFFFFFF)) * np.uint64(m) >> np.uint64(24)).astype(np.int64)
        np.minimum.at(flat, owner * m + place, point)
        live = point < low.max(axis=1)[owner]
        state, owner, point = state[live], owner[live], point[live]
    return np.clip(np.floor(1 - np.log(low) / _LOG), 0, LIMIT + 1).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets, from theirs."""
    return np.maximum(a, b)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of pairs of sketches, given both set sizes.

    For similarity J a register of a is above, below or equal to that of b with probabilities
    that follow from the sizes' shares and the base; the likelihood of the three counts is
    maximised over a grid of similarities.
    """
    up, down = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - up - down
    grid = np.linspace(0.0, 1.0, 201)[None, :]
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    top = np.minimum(u / v, v / u)
    j = np.minimum(grid, top)
    p = lambda x: -np.log1p(-x * (BASE - 1) / BASE) / _LOG
    q_up = np.clip(p(np.clip(u - v * j, 0, 1)), 1e-12, 1)
    q_down = np.clip(p(np.clip(v - u * j, 0, 1)), 1e-12, 1)
    q_same = np.clip(1 - q_up - q_down, 1e-12, 1)
    fit = up[:, None] * np.log(q_up) + down[:, None] * np.log(q_down) + same[:, None] * np.log(q_same)
    return j[np.arange(len(a)), fit.argmax(1)]


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def sketches(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows ``(doc_id, tkey, n, cls, sketch)``: hash of the text, set size, 64-bit digest of the set, registers.

    Sets are worked on in groups of some 400,000 shingles, which bounds a task's memory. Documents
    with no word have size 0 and neither digest nor registers.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("tkey", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple[int | None, int, np.ndarray]] = []
            weight = 0
            for key, tkey, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                held.append((key, tkey, shingles(t.as_py())))
                weight += len(held[-1][2])
                if weight >= 400_000 or len(held) >= 2000:
                    yield done(held)
                    held, weight = [], 0
            if held:
                yield done(held)

    def done(held):
        sets = [s for _, _, s in held if len(s)]
        regs = iter(registers(sets)) if sets else iter(())
        rows = []
        for key, tkey, s in held:
            digest = xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None
            rows.append((key, tkey, len(s), digest, next(regs).tobytes() if len(s) else None))
        return _arrow(rows, schema)

    keyed = docs.select(F.col(doc_id).cast("long"), F.xxhash64(F.col(text)), F.col(text).cast("string"))
    return keyed.mapInArrow(run, "doc_id long, tkey long, n long, cls long, sketch binary")


def _band_keys(regs: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band of registers, given as 64-bit numbers."""
    keys = np.empty((len(regs), BANDS), np.uint64)
    for b in range(BANDS):
        h = np.full(len(regs), b + 1, np.uint64)
        for r in range(ROWS):
            h = _mix(h + regs[:, b * ROWS + r] * np.uint64(0x9E3779B97F4A7C15))
        keys[:, b] = h
    return keys.view(np.int64)


def _banded(classes: DataFrame) -> DataFrame:
    """Rows ``(key, cls)``: a 64-bit key of each band and its registers."""
    schema = pa.schema([("key", pa.int64()), ("cls", pa.int64())])

    def run(batches):
        for batch in batches:
            own = np.array(batch.column(0).to_pylist(), np.int64)
            regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(len(own), BANDS * ROWS).astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(_band_keys(regs).reshape(-1)), pa.array(np.repeat(own, BANDS))], schema=schema)

    return classes.select("cls", "sketch").mapInArrow(run, "key long, cls long")


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b, j)`` whose joint estimate isn't below the threshold by over six standard errors."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("j", pa.float64())])
    j = percent / 100
    least = j - 6 * (j * (1 - j) / (BANDS * ROWS)) ** 0.5

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            n_a, n_b = (np.array(batch.column(i).to_pylist(), np.float64) for i in (2, 3))
            s_a, s_b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for i in (4, 5))
            found = np.concatenate([estimate(s_a[i : i + 2000], s_b[i : i + 2000], n_a[i : i + 2000], n_b[i : i + 2000]) for i in range(0, len(n_a), 2000)])
            near = pa.array(found >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near), pa.array(found).filter(near)], schema=schema)

    side = lambda x: classes.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    sized = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(sized)
    return both.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(run, "a long, b long, j double")


def _texts(classes: DataFrame, wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """One text of each wanted class, ``(cls, text)``; ``docs`` has ``doc_id, text, tkey``."""
    found = classes.join(wanted, "cls", "left_semi").select("cls", F.col("first.doc_id").alias("doc_id"), F.col("first.tkey").alias("tkey"))
    return docs.join(found, ["doc_id", "tkey"]).groupBy("cls").agg(F.first("text").alias("text"))


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full shingle sets are alike enough."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        last, mine = None, None
        for batch in batches:
            rows = []
            for a, b, ta, tb in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if a != last:
                    last, mine = a, shingles(ta.as_py())
                other = shingles(tb.as_py())
                common = len(np.intersect1d(mine, other, assume_unique=True))
                if 100 * common >= percent * (len(mine) + len(other) - common):
                    rows.append((a, b))
            yield _arrow(rows, schema)

    both = pairs.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")
    both = both.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a")
    return cut(both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long"))


def _roots(frame: DataFrame, roots: DataFrame, column: str) -> DataFrame:
    """Adds ``root_<column>``: the component of the class in the column, itself if it isn't linked."""
    named = roots.select(F.col("node").alias(column), F.col("root").alias("_root"))
    return frame.join(named, column, "left").withColumn(f"root_{column}", F.coalesce("_root", column)).drop("_root")


def _met(rows: DataFrame, weight: Column, most: int, columns: list[str]) -> DataFrame:
    """Pieces of every key's rows, such that each two pieces of a key meet: ``key, guest, items``.

    A key's rows are dealt into pieces of about ``most`` in weight. A piece is the host of its key's
    later pieces, which follow it as guests; a host and its guests lie in one partition, in
    order. What travels are pieces, never pairs of rows.
    """
    spark = rows.sparkSession
    sizes = rows.groupBy("key").agg(F.ceil(F.sum(weight) / most).cast("int").alias("pieces"))
    dealt = rows.join(sizes, "key").withColumn("piece", F.pmod(F.xxhash64("cls"), F.col("pieces")).cast("int"))
    packed = cut(dealt.groupBy("key", "piece").agg(F.collect_list(F.struct(*columns)).alias("items")))
    hosts = packed.select("key", "piece", F.lit(False).alias("guest"), "items")
    guests = packed.where("piece > 0").select("key", F.explode(F.sequence(F.lit(0), F.col("piece") - 1)).alias("piece"), F.lit(True).alias("guest"), "items")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return hosts.unionByName(guests).repartition(tasks, "key", "piece").sortWithinPartitions("key", "piece", "guest").select("key", "guest", "items")


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, bool, pa.StructArray]]:
    for key, guest, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
        yield key, guest, items.values


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _may_link(a: tuple, b: tuple, band: int, percent: int) -> np.ndarray:
    """Which members of two pieces of a band's bucket may be linked across components, as a matrix.

    A pair counts in the first band in which it agrees. Registers are equal at least as often as the
    similarity says, so pairs with fewer equal ones than six standard errors below are no links.
    """
    (root_a, n_a, regs_a), (root_b, n_b, regs_b) = a, b
    j = percent / 100
    least = BANDS * ROWS * (j - 6 * (j * (1 - j) / (BANDS * ROWS)) ** 0.5)
    small, large = np.minimum.outer(n_a, n_b), np.maximum.outer(n_a, n_b)
    open_pairs = (root_a[:, None] != root_b[None, :]) & (100 * small >= percent * large)
    same = np.zeros(open_pairs.shape, np.int32)
    for k in range(BANDS):
        if not open_pairs.any():
            break
        equal = regs_a[:, None, k * ROWS : (k + 1) * ROWS] == regs_b[None, :, k * ROWS : (k + 1) * ROWS]
        count = equal.sum(2)
        if k < band:
            open_pairs &= count < ROWS
        same += count
    return open_pairs & (same >= least)


def _open_members(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The members ``(key, cls, root)`` of buckets that have a possible link across components there."""
    schema = pa.schema([("key", pa.int64()), ("cls", pa.int64())])

    def run(batches):
        host, band = None, 0
        for batch in batches:
            out: set[tuple[int, int]] = set()
            for key, guest, items in _pieces(batch):
                cls, root, n = (_numbers(items.field(c)) for c in ("cls", "root", "n"))
                regs = np.frombuffer(b"".join(items.field("sketch").to_pylist()), np.uint16).reshape(len(cls), -1)
                if not guest:
                    host = (cls, root, n, regs)
                    band = int(np.flatnonzero(_band_keys(regs[:1].astype(np.uint64))[0] == key)[0])
                found = _may_link(host[1:], (root, n, regs), band, percent)
                out.update((key, int(c)) for c in host[0][found.any(1)])
                out.update((key, int(c)) for c in cls[found.any(0)])
            yield _arrow(sorted(out), schema)

    sketched = members.join(classes.select("cls", "n", "sketch"), "cls")
    met = _met(sketched, F.lit(1), MEMBERS, ["cls", "root", "n", "sketch"])
    found = met.mapInArrow(run, "key long, cls long").distinct()
    return members.join(found, ["key", "cls"], "left_semi")


def common_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of two lists, by products of their incidence matrices."""
    shared = np.intersect1d(np.concatenate(a), np.concatenate(b))
    total = np.zeros((len(a), len(b)), np.float32)
    for at in range(0, len(shared), 4096):
        some = shared[at : at + 4096]
        sides = []
        for sets in (a, b):
            marks = np.zeros((len(sets), len(some)), np.float32)
            for row, own in enumerate(sets):
                place = np.searchsorted(some, own[np.searchsorted(own, some[0]) : np.searchsorted(own, some[-1], "right")])
                inner = own[np.searchsorted(own, some[0]) : np.searchsorted(own, some[-1], "right")]
                marks[row, place[some[place] == inner]] = 1
            sides.append(marks)
        total += sides[0] @ sides[1].T
    return total


def _forest(pairs: np.ndarray, root_a: np.ndarray, root_b: np.ndarray) -> list[tuple[int, int]]:
    """Places of linked pairs that join the same components as all ``pairs`` do: fewer than components."""
    _, first = np.unique(np.stack([root_a[pairs[:, 0]], root_b[pairs[:, 1]]]), axis=1, return_index=True)
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    kept = []
    for i, j in pairs[first].tolist():
        x, y = top(int(root_a[i])), top(int(root_b[j]))
        if x != y:
            up[x] = y
            kept.append((i, j))
    return kept


def _across(members: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` across components between members ``(key, cls, root)`` of a bucket.

    Full sets of a bucket's members are compared with each other piece by piece. Of the links
    found in two pieces only as many are handed on as join their components.
    """
    schema = pa.schema([("cls", pa.int64()), ("n", pa.int64()), ("found", pa.binary())])

    def sets(batches):
        for batch in batches:
            for cls, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = shingles(t.as_py())
                yield _arrow([(cls, len(own), own.tobytes())], schema)

    def run(batches):
        host = None
        for batch in batches:
            out: set[tuple[int, int]] = set()
            for _, guest, items in _pieces(batch):
                cls, root = (_numbers(items.field(c)) for c in ("cls", "root"))
                own = [np.frombuffer(x, np.uint64) for x in items.field("found").to_pylist()]
                if not guest:
                    host = (cls, root, own)
                common = common_counts(host[2], own).astype(np.int64)
                union = np.add.outer([len(x) for x in host[2]], [len(x) for x in own]) - common
                linked = (100 * common >= percent * union) & (host[1][:, None] != root[None, :])
                for i, j in _forest(np.argwhere(linked), host[1], root):
                    out.add((min(int(host[0][i]), int(cls[j])), max(int(host[0][i]), int(cls[j]))))
            yield _arrow(sorted(out), pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    wanted = texts.join(members.select("cls").distinct(), "cls", "left_semi").select("cls", "text")
    full = members.join(cut(wanted.mapInArrow(sets, "cls long, n long, found binary")), "cls")
    met = _met(full, F.col("n") + 64, SHINGLES, ["cls", "root", "found"])
    return cut(met.mapInArrow(run, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """Rows ``(doc_id, n_shingles, component_id)``, one for each row of ``docs``.

    1. Documents with equal shingle sets become a class.
    2. In every bucket of a band one member, the first in one of four orders, is the hub, and
       every other is paired with it: at most one pair for each member, whatever the bucket's size.
    3. Pairs that pass the sizes and the joint estimate are confirmed on full sets; first the
       likeliest of each class, then those that still lie across components.
    4. Buckets that still hold several components get a second way: all their members are compared,
       first by registers, then the full sets of those that may be linked, in pieces that
       meet inside tasks. Pairs are never listed, and no bucket is capped.

    A document without a word, or with a null text, has size 0 and is a component of its own; so
    is one with a null id, whose component is null. Rows with the same id and different texts
    are linked by their own texts each. Ties have no meaning here; no rows give no rows.
    """
    return linked_rows(docs, text, doc_id, percent).select("doc_id", "n_shingles", "component_id")


def linked_rows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """Rows of :func:`near_duplicates` with ``tkey``, the text's hash, and ``head``.

    ``head`` holds for the rows with the smallest ``(doc_id, tkey)`` of their component and
    for rows without a word; it is false for null ids.
    """
    ship(docs.sparkSession)
    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), F.xxhash64(F.col(text)).alias("tkey"))
    rows = cut(sketches(docs, text, doc_id))
    full = rows.where(F.col("cls").isNotNull() & F.col("doc_id").isNotNull())
    classes = cut(full.groupBy("cls").agg(F.min(F.struct("doc_id", "tkey")).alias("first"), F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    bands = _banded(classes)
    first_of = F.element_at(F.array(*[F.lit(x) for x in ORDERS]), F.pmod(F.col("key"), F.lit(len(ORDERS))).cast("int") + 1)
    drawn = F.col("cls").bitwiseXOR(first_of)
    buckets = bands.groupBy("key").agg(F.min(drawn).alias("x"), F.max(drawn).alias("y")).where("x <> y")
    hubs = cut(buckets.select("key", F.col("x").bitwiseXOR(first_of).alias("hub")))
    shared = cut(bands.join(hubs, "key"))
    texts = cut(_texts(classes, shared.select("cls").distinct(), keyed))
    star = shared.where("cls <> hub").select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")).distinct()
    likely = cut(_likely(star, classes, percent))
    best = cut(likely.groupBy("b").agg(F.max_by("a", "j").alias("a")).select("a", "b"))
    links = _verified(best, texts, percent)
    roots = connected(links)
    open_pairs = cut(_roots(_roots(likely, roots, "a"), roots, "b").where("root_a <> root_b").select("a", "b").join(best, ["a", "b"], "left_anti"))
    if not open_pairs.isEmpty():
        links = links.union(_verified(open_pairs, texts, percent))
        roots = connected(links)
    rooted = _roots(shared.select("key", "cls"), roots, "cls").withColumnRenamed("root_cls", "root")
    mixed = rooted.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("key")
    members = cut(rooted.join(mixed, "key", "left_semi").select("key", "cls", "root"))
    still = cut(_open_members(members, classes, percent))
    if not still.isEmpty():
        more = _across(still, texts, percent)
        roots = roots if more.isEmpty() else connected(links.union(more))
    named = _roots(classes.select("cls", "first"), roots, "cls")
    ids = named.groupBy("root_cls").agg(F.min("first").alias("least")).select("root_cls", F.col("least.doc_id").alias("component_id"), F.col("least.tkey").alias("head_key"))
    by_class = named.select("cls", "root_cls").join(ids, "root_cls").select("cls", "component_id", "head_key")
    linked = F.when(F.col("cls").isNotNull() & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    head = (F.col("doc_id") == linked) & (F.col("cls").isNull() | (F.col("tkey") == F.col("head_key")))
    return rows.join(by_class, "cls", "left").select("doc_id", F.col("n").alias("n_shingles"), linked.alias("component_id"), "tkey", F.coalesce(head, F.lit(False)).alias("head"))
