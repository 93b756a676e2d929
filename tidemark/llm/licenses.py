"""Licence families of paragraphs by a trained classifier, confirmed against templates.

Features are the words and word pairs of notices that a window holds; a multinomial logistic regression over all windows of
the corpus gives family probabilities. A calibrated limit sends unsure paragraphs to the unknown, and a family
counts only if the paragraph holds the wording of one of its templates. DataFrame functions and Spark's own JVM learner only.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import cut

#: Usual short notices of the families.
TEMPLATES = {
    "apache": ["licensed under the apache license version 2.0", "apache software license 2.0"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted", "licensed under the bsd license", "released under the bsd 3 clause license"],
    "cc": ["licensed under cc by 4.0", "licensed under cc by sa 4.0", "licensed under cc by nc 4.0", "this work is licensed under a creative commons attribution license"],
    "gpl": ["this work is licensed under the gnu general public license version 3", "you can redistribute it under the terms of the gnu general public license", "licensed under the gnu lesser general public license"],
    "mit": ["released under the mit license", "licensed under the mit license", "permission is hereby granted free of charge to any person obtaining a copy of this software"],
    "mpl": ["this source code form is subject to the terms of the mozilla public license v 2.0"],
    "reserved": ["all rights reserved", "all rights reserved no part of this work may be reproduced without permission"],
}
NONE = "none"
FAMILIES = [NONE, *sorted(TEMPLATES)]
#: Words of a window, twice those of the longest template at least.
WINDOW = 40
#: Weight of a notice alone in the fit, as a share of the ordinary windows.
ALONE = 1e-4
#: Share of ordinary calibration paragraphs that may pass the limit, share of a template's words that confirm.
FALSE_RATE, CONFIRM = 0.001, 0.8
#: Probability that a family needs to be compared with its templates; the limit holds for all families together.
LIKELY = 0.05


def _telling() -> set[str]:
    """Words of which a window must hold one to hold enough of a template: the longest, one more than may lack."""
    out: set[str] = set()
    for own in (set(t.split()) for ts in TEMPLATES.values() for t in ts):
        out |= set(sorted(own, key=lambda w: (-len(w), w))[: len(own) - ceil(CONFIRM * len(own)) + 1])
    return out


#: Words of the templates by their code, from 1; all other words have code 0. Telling words come last, from ``TELLS``.
CODES = {w: i for i, w in enumerate(sorted({w for ts in TEMPLATES.values() for t in ts for w in t.split()}, key=lambda w: (w in _telling(), len(w), w)), 1)}
TELLS = min(CODES[w] for w in _telling())
#: Bits of a word mask: a long holds 63 of them.
BITS = 63
#: Word pairs of the templates; a pair's code is the first word's shifted by ``SHIFT`` bits, plus the second's.
SHIFT = 7
PAIRS = sorted({(CODES[a] << SHIFT) + CODES[b] for ts in TEMPLATES.values() for t in ts for a, b in zip(t.split(), t.split()[1:], strict=False)})
#: The features.
GRAMS = [*CODES.values(), *PAIRS]


def paragraph_words(line: Column) -> Column:
    """Lower-case words of letters, digits and inner full stops, as in version numbers."""
    plain = F.regexp_replace(F.lower(line), r"[^ a-z0-9.\p{L}\p{N}]+|\.(?![0-9])", " ")
    return F.array_remove(F.split(plain, " "), "")


def _coded(words: Column) -> Column:
    codes = F.create_map(*[F.lit(x) for w, c in CODES.items() for x in (w, c)])
    return F.transform(words, lambda w: F.when(w.isin(*CODES), codes[w]).otherwise(0).cast("tinyint"))


def _linked(words: Column) -> Column:
    """Of each coded word its code, shifted, plus that of the word after it if they are a template's pair; 0 for code 0."""

    def link(a: Column, b: Column) -> Column:
        first = F.shiftleft(a.cast("int"), SHIFT)
        both = first + b.cast("int")
        return F.when(a == 0, 0).when(both.isin(*PAIRS), both).otherwise(first)

    return F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), link)


def _grams(linked: Column) -> Column:
    """Codes of the template words and pairs that linked words hold, sorted."""
    own = F.filter(linked, lambda x: x > 0)
    pairs = F.filter(own, lambda x: x.bitwiseAND(F.lit((1 << SHIFT) - 1)) > 0)
    return F.sort_array(F.array_distinct(F.concat(F.transform(own, lambda x: F.shiftright(x, SHIFT)), pairs)))


def windows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows ``(doc_id, tkey, start, key, words, grams)``: windows of ``WINDOW`` words over the whole text, half overlapping.

    Line ends are spaces, so a notice that is wrapped, or stands inside a long line, lies whole in a
    window. A text without a word has one empty window. ``words`` are coded, ``key`` is the hash of the words
    themselves, ``grams`` are the template words and pairs among them. The text is cleaned and coded once: what follows starts from the generators' output.
    """
    cleaned = F.explode(F.array(paragraph_words(F.coalesce(F.col(text), F.lit(""))))).alias("all")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("tkey"), cleaned)
    rows = rows.select("doc_id", "tkey", "all", F.explode(F.array(_coded(F.col("all")))).alias("coded"))
    rows = rows.select("doc_id", "tkey", "all", "coded", F.explode(F.array(_linked(F.col("coded")))).alias("linked"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - WINDOW // 2 - 1, F.lit(0)), F.lit(WINDOW // 2))

    def window(i: Column) -> Column:
        of = lambda c, n: F.slice(c, i + 1, F.lit(n))
        # the last word's pair lies outside
        last = F.coalesce(F.shiftleft(F.get("coded", i + WINDOW - 1).cast("int"), SHIFT), F.lit(0))
        linked = F.concat(of("linked", WINDOW - 1), F.array(last))
        return F.struct(i.alias("start"), F.xxhash64(of("all", WINDOW)).alias("key"), of("coded", WINDOW).alias("words"), linked.alias("linked"))

    # a text's arrays stay behind: only its windows leave the generator
    cut_out = rows.select("doc_id", "tkey", F.explode(F.transform(starts, window)).alias("x"))
    return cut_out.select("doc_id", "tkey", "x.start", "x.key", "x.words", _grams(F.col("x.linked")).alias("grams"))


def _counted(frame: DataFrame) -> DataFrame:
    """Adds ``features``, one for each of ``grams``."""
    model = CountVectorizerModel.from_vocabulary(list(map(str, GRAMS)), inputCol="_grams", outputCol="features")
    return model.transform(frame.withColumn("_grams", F.col("grams").cast("array<string>"))).drop("_grams")


def _masks(words: Column) -> list[Column]:
    """Bits of the coded words that stand in a window."""
    own = F.filter(words, lambda x: x > 0)

    def mask(n: int) -> Column:
        bit = lambda x: F.when((x > n * BITS) & (x <= (n + 1) * BITS), F.call_function("shiftleft", F.lit(1).cast("long"), x.cast("int") - (1 + n * BITS))).otherwise(F.lit(0).cast("long"))
        return F.aggregate(own, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(bit(x)))

    return [mask(n) for n in range((len(CODES) - 1) // BITS + 1)]


def _masked(frame: DataFrame, needed: Column) -> DataFrame:
    """Adds ``masks``, without bits where not needed; what is built on them reads the generator's output."""
    masks = _masks(F.col("words"))
    none = F.array(*[F.lit(0).cast("long")] * len(masks))
    return frame.select("*", F.explode(F.array(F.when(needed, F.array(*masks)).otherwise(none))).alias("masks"))


def _share(template: str) -> Column:
    """Whether the words hold enough of a template."""
    own = {CODES[w] - 1 for w in template.split()}
    parts = [sum(1 << (c - n * BITS) for c in own if c // BITS == n) for n in range((len(CODES) - 1) // BITS + 1)]
    held = reduce(lambda a, b: a + b, [F.bit_count(F.col("masks")[n].bitwiseAND(F.lit(x).cast("long"))) for n, x in enumerate(parts) if x])
    return held >= CONFIRM * len(own)


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


class Classifier:
    """Weights and the limit that a family's probability must reach."""

    def __init__(self, model: LogisticRegressionModel, limit: float) -> None:
        self.model, self.limit = model, limit

    def predict(self, paragraphs: DataFrame) -> DataFrame:
        """Adds ``sure`` and ``likely``: families that are not unlikely, empty for ordinary text.

        Paragraphs are :func:`windows`. One can hold notices of several families, which then share its probability.
        """
        found = self.model.transform(_counted(paragraphs))
        # the model runs once for each row, whatever is built on its verdict
        found = found.select(*paragraphs.columns, "prediction", F.explode(F.array(vector_to_array("probability"))).alias("chance"))
        chance = F.col("chance")
        names = F.array(*[F.when(chance[i] >= LIKELY, F.lit(x)) for i, x in enumerate(FAMILIES) if x != NONE])
        likely = F.when(F.col("prediction") != FAMILIES.index(NONE), F.array_compact(names)).otherwise(F.array().cast("array<string>"))
        return found.select(*paragraphs.columns, (1 - chance[FAMILIES.index(NONE)] >= self.limit).alias("sure"), likely.alias("likely"))


def _examples(found: DataFrame) -> DataFrame:
    """Rows ``(half, label, grams, n)``: how many distinct ordinary windows give which features.

    Windows of half 0 stand as they are and with a notice; those of half 1 as they are.
    """
    drawn = found.where("size(words) > 0").select("key", "words", "grams").distinct()
    templates = [(t, f) for f, ts in TEMPLATES.items() for t in ts]
    ordinary = _masked(drawn, F.array_max("words") >= TELLS).where(~_any([_share(t) for t, _ in templates]))
    draw = lambda seed, n: F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(n)).cast("int")
    # a window takes one notice, at a place that its hash names
    turn, place, words = draw(2, 64) % len(templates), draw(3, WINDOW), F.col("words")
    notices = F.array(*[F.array(*[F.lit(CODES[w]).cast("tinyint") for w in t.split()]) for t, _ in templates])
    labels = F.array(*[F.lit(float(FAMILIES.index(f))) for _, f in templates])
    drawn_for = ordinary.select("words", "grams", draw(1, 2).alias("half"), notices[turn].alias("notice"), labels[turn].alias("label"), place.alias("place"))
    inside = F.concat(F.slice(words, F.lit(1), F.col("place")), F.col("notice"), F.slice(words, F.col("place") + 1, F.greatest(F.lit(WINDOW) - F.size("notice") - F.col("place"), F.lit(0))))
    plain = F.struct(F.lit(0.0).alias("label"), F.col("grams"))
    placed = F.struct(F.col("label"), _grams(_linked(F.col("inside"))).alias("grams"))
    drawn_for = drawn_for.select("half", "label", "grams", F.explode(F.array(F.when(F.col("half") == 0, inside))).alias("inside"))
    rows = drawn_for.select("half", F.explode(F.when(F.col("half") == 0, F.array(plain, placed)).otherwise(F.array(plain))).alias("x"))
    return rows.select("half", "x.label", "x.grams").groupBy("half", "label", "grams").agg(F.count("*").alias("n"))


def _quantile(values: DataFrame, share: float, bins: int = 1000) -> float:
    """The least ``p`` that at most ``1 - share`` of the ``n`` rows exceed; 0 without rows.

    Counts per bin lead to the bin that holds it, which is divided again, until that bin has one value.
    """
    low, high, below = 0.0, 1.0, 0
    total = values.agg(F.sum("n")).first()[0] or 0
    if not total:
        return 0.0
    while True:
        place = F.least(F.floor((F.col("p") - low) / (high - low) * bins), F.lit(bins - 1)) if high > low else F.lit(0)
        here = values.where(F.col("p").between(low, high)).groupBy(place.alias("bin")).agg(F.sum("n").alias("n"), F.min("p").alias("a"), F.max("p").alias("b"))
        for row in sorted(here.collect(), key=lambda r: r["a"]):
            if below + row["n"] >= share * total:
                break
            below += row["n"]
        if row["a"] == row["b"]:
            return row["a"]
        low, high = row["a"], row["b"]


def train(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", found: DataFrame | None = None) -> Classifier:
    """Fits on all distinct windows of the corpus, with and without template notices.

    Ordinary are windows that hold no template, with or without words that licences use. A notice is
    learnt inside ordinary windows, at any place, and alone. Half of the windows, by a hash, are learnt; the other
    half calibrates: the limit is the smallest that at most ``FALSE_RATE`` of them exceed in a family.
    Features are the words and pairs of the templates: other words stand in windows of all labels alike.
    Windows of equal features are one weighted row of the fit, so that the passes of the learner are over these.
    ``found`` are the :func:`windows` of the documents, if they are stored.
    """
    spark = docs.sparkSession
    rows = cut(_examples(windows(docs, text, doc_id) if found is None else found))
    learnt = rows.where("half = 0")
    weight = max(1.0, ALONE * (learnt.where("label = 0").agg(F.sum("n")).first()[0] or 0))
    notices = spark.createDataFrame([([CODES[w] for w in t.split()], float(FAMILIES.index(f))) for f, ts in TEMPLATES.items() for t in ts], "words array<tinyint>, label double")
    alone = notices.select("label", _grams(_linked(F.col("words"))).alias("grams"), F.lit(weight).alias("n"))
    both = _counted(learnt.select("label", "grams", F.col("n").cast("double")).union(alone)).select("features", "label", "n")
    model = LogisticRegression(maxIter=60, regParam=1e-4, family="multinomial", weightCol="n").fit(both)
    held = model.transform(_counted(rows.where("half = 1")))
    wrong = held.select(F.when(F.col("prediction") != 0, 1 - vector_to_array("probability")[0]).otherwise(0.0).alias("p"), "n")
    top = _quantile(cut(wrong.groupBy("p").agg(F.sum("n").alias("n"))), 1 - FALSE_RATE)
    return Classifier(model, max(0.5, top))


def scan(docs: DataFrame, model: Classifier, text: str = "text", doc_id: str = "doc_id", found: DataFrame | None = None) -> DataFrame:
    """One row per distinct (id, text): ``doc_id, n_paragraphs, n_confirmed, n_unknown, families``.

    Paragraphs are half overlapping windows of ``WINDOW`` words, counted each. ``families`` lists the
    confirmed families in order, joined by commas, and is empty without any. A paragraph that looks
    like a licence but is unsure or unconfirmed is unknown. A null or empty text has no
    paragraphs; equal rows are one; a null id stays null. ``found`` are the :func:`windows` of the
    documents, if they are stored.
    """
    found = windows(docs, text, doc_id) if found is None else found
    found = _masked(model.predict(found.select("doc_id", "tkey", "start", "words", "grams")), F.size("likely") > 0)
    families = list(TEMPLATES)
    looks = (F.size("words") > 0) & (F.size("likely") > 0)
    bits = [F.when(F.array_contains("likely", f) & _any([_share(t) for t in TEMPLATES[f]]), 1 << i).otherwise(0) for i, f in enumerate(families)]
    known = F.when(looks & F.col("sure"), reduce(lambda a, b: a + b, bits)).otherwise(0)
    # equal rows have equal windows, each as often as there are rows; every row has a first window
    judged = found.select("doc_id", "tkey", (F.size("words") > 0).alias("there"), looks.alias("looks"), known.alias("known"), (F.col("start") == 0).alias("first"))
    some = F.col("known") > 0
    counts = {"n_paragraphs": F.col("there"), "n_confirmed": some, "n_unknown": F.col("looks") & ~some, "n_rows": F.col("first")}
    per_doc = judged.groupBy("doc_id", "tkey").agg(*[F.count_if(c).alias(n) for n, c in counts.items()], F.bit_or("known").alias("known"))
    names = F.array_compact(F.array(*[F.when(F.col("known").bitwiseAND(F.lit(1 << families.index(f))) > 0, F.lit(f)) for f in sorted(families)]))
    return per_doc.select("doc_id", *[F.expr(f"{n} div n_rows").alias(n) for n in list(counts)[:3]], F.array_join(names, ",").alias("families"))
