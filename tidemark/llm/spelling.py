"""Words that differ by one letter, found by products of letter counts.

Words are dealt into blocks by how many letters of each letter group they have. One inserted,
deleted or replaced letter changes the counts of a group by one at most, so near words lie in the
same block or in one of a few adjacent ones. For two blocks a NumPy product of their letter-count
matrices gives all squared distances at once: near words have at most two. Those pairs are
then compared letter by letter.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import cut, ship

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Every letter that a word can have, in the order of its column in a count matrix.
LETTERS = [*map(chr, range(0x61, 0x7B)), *map(chr, range(0xC0, 0x100))]
#: A run loses a letter if this divides its hash.
DROP = 97
SHORTEST, FEWEST = 5, 3
#: Words a block should have on the average, and letters that one piece of a block has at most, about.
BLOCK, PIECE = 400, 16_384
#: Words that a task counts before it passes them on.
HELD = 200_000


def runs(doc_id: int | None, text: str | None) -> Counter[str]:
    """Words of one text: its lower-cased runs, some without a letter as the hash of id and run says."""
    found = Counter(RUN.findall(text.encode("utf-8", "replace").lower().decode())) if text else Counter()
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    made: Counter[str] = Counter()
    for run, n in found.items():
        if len(run) >= SHORTEST:
            h = zlib.crc32(run.encode(), start)
            if h % DROP == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= SHORTEST:
                made[run] += n
    return made


def vocabulary(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows ``(word, n)`` of the words with at least ``FEWEST`` occurrences in all texts."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for key, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.update(runs(key, t.as_py()))
                if len(held) >= HELD:
                    yield _counted(held, schema)
                    held = Counter()
        yield _counted(held, schema)

    pieces = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, "word string, n long")
    return pieces.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= FEWEST)


def _counted(held: Counter[str], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], schema=schema)


def letter_groups(vocab: DataFrame, size: int) -> list[str]:
    """Letters in so many groups that a block has about ``BLOCK`` of ``size`` words, equally frequent groups.

    A block is told by its counts of all groups; a group parts words about 2.5 bits further, and
    the lengths 3 bits.
    """
    many = max(1, min(12, round((math.log2(max(size, 1) / BLOCK) - 3) / 2.5) + 1))
    share = [F.sum(F.length("word") - F.length(F.translate("word", x, ""))).alias(f"l{i}") for i, x in enumerate(LETTERS)]
    often = [n or 0 for n in vocab.agg(*share).first()]
    groups, weight = [""] * many, [0] * many
    for i in sorted(range(len(LETTERS)), key=lambda i: -often[i]):
        least = weight.index(min(weight))
        groups[least] += LETTERS[i]
        weight[least] += often[i]
    return groups


def _steps(many: int) -> list[list[int]]:
    """Changes of the group counts that one edit can make, one of each opposite pair."""
    step = lambda up, down: [int(i == up) - int(i == down) for i in range(many)]
    return [[0] * many, *[step(i, -1) for i in range(many)], *[step(b, a) for a in range(many) for b in range(a + 1, many)]]


def _codes(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of letter numbers."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.int64)
    return np.where(points < 0xC0, points - 0x61, points - 0xC0 + 26)


def _grams(codes: np.ndarray) -> np.ndarray:
    n, wide = codes.shape
    flat = (np.arange(n)[:, None] * len(LETTERS) + codes).reshape(-1)
    return np.bincount(flat, minlength=n * len(LETTERS)).reshape(n, len(LETTERS)).astype(np.float64 if wide > 2000 else np.float32)


def near_pairs(left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places ``(i, j)`` of the near words of two blocks of letter numbers; ``i < j`` if they are the same block.

    The right block's words are as long as the left one's, or one letter longer.
    """
    a, b = _grams(left), _grams(right)
    distance = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    i, j = np.nonzero(distance <= 2)
    if same:
        i, j = i[i < j], j[i < j]
    wide = left.shape[1]
    keep = [np.empty(0, bool)]
    for at in range(0, len(i), 1 << 16):
        x, y = left[i[at : at + (1 << 16)]], right[j[at : at + (1 << 16)]]
        if right.shape[1] == wide:
            keep.append((x != y).sum(1) == 1)
        else:
            front = np.cumprod(x == y[:, :wide], axis=1).sum(1)
            back = np.cumprod((x == y[:, 1:])[:, ::-1], axis=1).sum(1)
            keep.append(front + back >= wide)
    kept = np.concatenate(keep)
    return i[kept], j[kept]


def _best(words: list[str], ns: np.ndarray, me: np.ndarray, other: np.ndarray, other_words: list[str], other_ns: np.ndarray):
    """For each word with near ones: its number of them, and the one with the largest n, then smallest word."""
    rank = np.empty(len(other_words), np.int64)
    rank[sorted(range(len(other_words)), key=other_words.__getitem__)] = np.arange(len(other_words))
    order = np.lexsort((rank[other], -other_ns[other], me))
    who, first, many = np.unique(me[order], return_index=True, return_counts=True)
    top = other[order][first]
    return [words[i] for i in who], many, other_ns[top], [other_words[i] for i in top]


def neighbours(vocab: DataFrame) -> DataFrame:
    """Rows ``(word, n_near, best_n, best)`` of the words ``(word, n)`` that have near ones.

    Blocks are cut into pieces of a bounded size. A piece travels once to every piece it has to meet;
    no list of pairs of words is ever made, a task hands on one row for each word and piece met.
    """
    spark = vocab.sparkSession
    size = vocab.count()
    groups = letter_groups(vocab, size)
    count = [F.length("word") - F.length(F.translate("word", letters, "")) for letters in groups]
    keyed = vocab.select("word", "n", F.array(*count).alias("key"))
    length = F.aggregate("key", F.lit(0), lambda a, x: a + x)
    sizes = cut(keyed.groupBy("key").agg(F.count("*").alias("size")).withColumn("pieces", F.ceil(F.col("size") * F.greatest(length, F.lit(8)) / PIECE).cast("int")).drop("size"))
    dealt = keyed.join(sizes, "key").withColumn("piece", F.pmod(F.xxhash64("word"), F.col("pieces")).cast("int"))
    packed = cut(dealt.groupBy("key", "piece").agg(F.collect_list(F.struct("word", "n")).alias("words")))
    steps = F.array(*[F.array(*map(F.lit, s)) for s in _steps(len(groups))])
    targets = F.filter(F.transform(steps, lambda s: F.zip_with("key", s, lambda a, b: a + b)), lambda k: F.forall(k, lambda x: x >= 0))
    other = sizes.select(F.col("key").alias("other"), F.col("pieces").alias("other_pieces"))
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    meets = sizes.select("key", "pieces", F.explode(targets).alias("other")).join(other, "other")
    meets = meets.withColumn("piece", F.explode(upto("pieces"))).withColumn("other_piece", F.explode(upto("other_pieces")))
    meets = cut(meets.where((F.col("key") != F.col("other")) | (F.col("piece") <= F.col("other_piece"))).select("key", "piece", "other", "other_piece"))
    guests = packed.select(F.col("key").alias("other"), F.col("piece").alias("other_piece"), "words")
    coming = meets.join(guests, ["other", "other_piece"]).select(
        "key", "piece", ((F.col("key") == F.col("other")) & (F.col("piece") == F.col("other_piece"))).alias("same"), F.lit(True).alias("guest"), "words"
    )
    hosts = packed.select("key", "piece", F.lit(False).alias("same"), F.lit(False).alias("guest"), "words")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, math.ceil(meets.count() / 1000))
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: tuple = ()
        for batch in batches:
            out: list[tuple] = []
            for same, guest, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                fields = members.values
                words, ns = fields.field("word").to_pylist(), fields.field("n").to_numpy(zero_copy_only=False)
                here = (words, ns, _codes(words))
                if not guest:
                    mine = here
                    continue
                i, j = near_pairs(mine[2], here[2], same)
                if len(i):
                    out += [_best(mine[0], mine[1], i, j, words, ns), _best(words, ns, j, i, mine[0], mine[1])]
            if out:
                near, many, top, best = zip(*out, strict=True)
                flat = lambda parts: [x for part in parts for x in part]
                yield pa.RecordBatch.from_arrays([pa.array(flat(near), pa.string()), pa.array(np.concatenate(many).astype(np.int64)), pa.array(np.concatenate(top).astype(np.int64)), pa.array(flat(best), pa.string())], schema=schema)

    met = hosts.unionByName(coming).repartition(tasks, "key", "piece").sortWithinPartitions("key", "piece", "guest")
    found = met.select("same", "guest", "words").mapInArrow(run, "word string, n_near long, best_n long, best string")
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top"))
        .select("word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))
    )


def variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows ``(word, form, root, n, n_near, form_n)``, one for each word of the vocabulary.

    ``form`` is the near word of the largest ``n`` (ties: the smallest), where that is twice the
    word's at least, else null; ``root`` is where the forms lead. A form has twice the occurrences, so
    a path is as long as the largest ``n`` doubles at most, and half of it is left in every round.

    A null text has no words, a null id is hashed as an empty one, repeated rows count each, other
    columns are left alone, and no rows give no rows.
    """
    ship(docs.sparkSession)
    vocab = cut(vocabulary(docs, text, doc_id))
    found = neighbours(vocab)
    suits = F.col("best_n") >= 2 * F.col("n")
    formed = cut(
        vocab.join(found, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(suits, F.col("best")).alias("form"), F.when(suits, F.col("best_n")).alias("form_n")
        )
    )
    most = formed.agg(F.max("n")).first()[0] or 1
    paths = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(math.log2(most) + 1)) if most > 1 else 0):
        paths = cut(paths.join(paths.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    rooted = formed.join(paths, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
