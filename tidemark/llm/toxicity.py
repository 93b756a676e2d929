"""Toxicity by compression distance: two zstandard dictionaries, compared window by window.

The ordinary dictionary is trained on windows of ordinary texts, the toxic one on windows of toxic
texts: on those that dictionaries of other toxic texts compress best, since most of a toxic text is
ordinary. The ordinary content stands in both behind the toxic one, so it cancels out: a window
that compresses better with the second holds toxic material.
A logistic function, fitted on other labelled texts, turns the gains into a calibrated score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import ship

WORDS, LEVEL = 6, 9
ORDINARY_BYTES, TOXIC_BYTES = 131_072, 2048
#: Windows of toxic texts are ranked in so many rounds by dictionaries of this size, against this share of ordinary windows.
ROUNDS, ROUGH_BYTES, KEEP = 2, 16_384, 0.997
#: Ordinary windows that set the limits of a ranking at most; windows that a half needs to go on; words of a narrow window.
RANKED, FEWEST, NARROW = 4000, 20, 2
#: Labelled texts of each label that the fit takes at most, half for dictionaries, half to calibrate.
SAMPLE = 4000
#: Windows that train the ordinary dictionary at most.
WINDOWS = 40_000
THRESHOLD = 0.7
#: Both dictionaries end with it and every window begins with it: the overhead of a compressed block is then in both lengths.
ANCHOR = b"#0123456789+anchor+9876543210#"


def windows(text: str | None, words: int = WORDS) -> list[bytes]:
    """The whole text, lower case, in windows of so many words."""
    found = text.lower().split() if text else []
    return [" ".join(found[i : i + words]).encode("utf-8", "replace") for i in range(0, len(found), words)]


def _different(texts: list[str]) -> list[str]:
    """Texts that share at most a tenth of their three-word shingles with earlier ones: copies teach nothing."""
    seen: set[int] = set()
    out = []
    for text in texts:
        w = text.lower().split()
        own = {hash((w[i], *w[i + 1 : i + 3])) for i in range(len(w))}
        if own and len(own & seen) <= 0.1 * len(own):
            out.append(text)
            seen |= own
    return out


class Model:
    """Dictionaries and the weights of the logistic function; ``None`` weights score 0."""

    def __init__(self, ordinary: bytes, toxic: bytes, weights: np.ndarray | None) -> None:
        self.ordinary, self.toxic, self.weights = ordinary, toxic, weights
        self._lengths = None

    def __getstate__(self):
        return {"ordinary": self.ordinary, "toxic": self.toxic, "weights": self.weights, "_lengths": None}

    def gains(self, text: str | None) -> list[int]:
        """Bytes that the toxic dictionary saves in each window of the text."""
        return self.saved(windows(text))

    def saved(self, some: list[bytes]) -> list[int]:
        """Bytes that the toxic dictionary saves in each window."""
        if self._lengths is None:
            made = []
            for content in (self.ordinary + ANCHOR, self.toxic + self.ordinary + ANCHOR):
                known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                known.precompute_compress(level=LEVEL)
                made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
            self._lengths = made
        a, b = self._lengths
        return [len(a(x)) - len(b(x)) for x in (ANCHOR + b" " + w + b" " for w in some)]

    def features(self, text: str | None) -> list[float]:
        g = sorted(self.gains(text), reverse=True) or [0]
        n = len(g)
        return [1.0, g[0], sum(g[:3]) / min(3, n), 10 * sum(g) / n, 100 * sum(x >= 3 for x in g) / n, float(np.log(n))]

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return 0.0
        z = float(np.dot(self.weights, self.features(text)))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _trained(size: int, samples: list[bytes]) -> bytes:
    """Content of a trained dictionary; with too few samples to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


def _saved(ordinary: bytes, toxic: bytes, some: list[bytes]) -> np.ndarray:
    return np.array(Model(ordinary, toxic, None).saved(some))


def _telling(ordinary: bytes, usual: list[bytes], halves: list[list[bytes]]) -> list[bytes]:
    """Windows of toxic texts that a dictionary of *other* toxic texts compresses better than the ordinary one.

    Most windows of a toxic text are ordinary. Each half of the texts is ranked with the dictionary of
    the other one, so only what both have counts; windows above what ``KEEP`` of the ordinary windows
    gain are the next dictionaries' text. In the end a window gives its ``NARROW`` best words in a row.
    """
    chosen = halves
    for _ in range(ROUNDS):
        made = [_trained(ROUGH_BYTES, half) for half in chosen]
        following = []
        for own, other in zip(halves, made[::-1], strict=True):
            limit = np.quantile(_saved(ordinary, other, usual), KEEP)
            best = [w for w, x in zip(own, _saved(ordinary, other, own), strict=True) if x > limit]
            following.append(best if len(best) >= FEWEST else own)
        chosen = following
    made = [_trained(ROUGH_BYTES, half) for half in chosen]
    out = []
    for own, other in zip(chosen, made[::-1], strict=True):
        limit = np.quantile(_saved(ordinary, other, [x for w in usual[::2] for x in _parts(w)]), KEEP)
        narrow = [_parts(window) for window in own]
        flat = _saved(ordinary, other, [x for parts in narrow for x in parts])
        start, best = 0, []
        for parts in narrow:
            gain = flat[start : start + len(parts)]
            start += len(parts)
            if gain.max() > limit:
                best.append(parts[int(gain.argmax())])
        out += best if len(best) >= FEWEST else own
    return out


def _parts(window: bytes) -> list[bytes]:
    words = window.split()
    return [b" ".join(words[i : i + NARROW]) for i in range(max(1, len(words) - NARROW + 1))]


def fit(toxic: list[str], ordinary: list[str]) -> Model:
    """Model from labelled texts; even places train the dictionaries, odd ones calibrate."""
    bad, good = _different(toxic[::2]), _different(ordinary[::2])
    halves = [[w for t in bad[i::2] for w in windows(t) if len(w) > 8] for i in (0, 1)]
    usual = [w for t in good for w in windows(t, 16) if len(w) >= 8]
    if not all(halves) or not usual:
        return Model(b"", b"", None)
    base = _trained(ORDINARY_BYTES, usual[:: max(1, len(usual) // WINDOWS)])
    some = [w for t in good for w in windows(t)]
    telling = _telling(base, some[:: max(1, len(some) // RANKED)], halves)
    model = Model(base, _trained(TOXIC_BYTES, telling), None)
    held = [(t, 1.0) for t in toxic[1::2]] + [(t, 0.0) for t in ordinary[1::2]]
    if len({y for _, y in held}) == 2:
        model.weights = _logistic(np.array([model.features(t) for t, _ in held]), np.array([y for _, y in held]))
    return model


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Fits on at most ``sample`` texts of each label whose crc32(id) mod 3 isn't 1, drawn by a hash of the id.

    Labels that are null, or of documents that aren't there, are left out; an id with both labels
    counts as toxic. Without both kinds the model scores 0.
    """
    named = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_toxic"))
    named = named.where(F.crc32(F.col("_id").cast("string").cast("binary")) % 3 != 1)
    there = named.join(docs.select(F.col(doc_id).alias("_id")), "_id", "left_semi")
    drawn = [there.where(F.col("_toxic") == y).orderBy(F.xxhash64("_id"), "_id").limit(sample) for y in (1, 0)]
    # bounded by the sample's size, twice 4,000 ids
    chosen = F.broadcast(drawn[0].union(drawn[1]))
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(chosen, "_id").where("_text IS NOT NULL").select("_id", "_text", "_toxic").collect()
    by_id = sorted({(r["_id"], r["_text"], r["_toxic"]) for r in rows})
    np.random.default_rng(0).shuffle(by_id)
    return fit(*[[t for _, t, y in by_id if int(y) == k] for k in (1, 0)])


def score(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The given columns with ``held_out, score, predicted``. Only the text goes into the score.

    A null or empty text has the score of a text without a toxic window; repeated rows have equal
    scores; a null id is never held out. Columns with a result's name are replaced.
    """
    ship(docs.sparkSession)
    docs = docs.drop("held_out", "score", "predicted", "_text")
    known = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:  # noqa: UP028
        for some in texts:
            yield pd.Series([known.value.score(t) for t in some], dtype="float64")

    out = F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return docs.withColumn("held_out", out).withColumn("score", scored(F.col(text))).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
