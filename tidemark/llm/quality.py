"""Line frequency across the documents of a host, with base rules on each text.

Only DataFrame functions are used. Lines are counted by 64-bit hashes of their normal form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import cut, words

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: White space of the word rule.
BLANKS = " \t\n\x0b\x0c\r"
#: Columns that :func:`assess` adds.
MADE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def _lines(text: Column, blank: bool = False) -> Column:
    """Lines in their normal form: lower case, single spaces, digit runs as one 0; without those that have no word unless ``blank``."""
    flat = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09\x0B-\x0D]+", " ")
    parts = F.split(F.regexp_replace(flat, r"[0-9]+", "0"), "\n")
    normal = F.transform(parts, lambda line: F.trim(line))
    return normal if blank else F.array_remove(normal, "")


def _text_key(host: Column, text: Column) -> Column:
    return F.xxhash64(F.coalesce(host, F.lit("\0")), F.coalesce(text, F.lit("")))


def line_counts(docs: DataFrame, text: str = "text", host: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """One row for each host, distinct text and distinct normalised line of it.

    ``line`` hashes host and line, ``key`` host and text, ``n`` is the line's number of words,
    ``total`` that of all distinct lines of the text and ``first_id`` the smallest document id.
    Exact copies within a host give one row, so a popular text isn't taken for boilerplate.
    """
    rows = docs.select(
        F.col(doc_id).alias("id"),
        F.coalesce(F.col(host), F.lit("\0")).alias("h"),
        _text_key(F.col(host), F.col(text)).alias("key"),
        F.array_distinct(_lines(F.col(text))).alias("lines"),
    )
    n = lambda line: F.size(F.split(line, " "))
    sized = rows.select("id", "key", F.transform("lines", lambda x: F.struct(F.xxhash64("h", x).alias("line"), n(x).alias("n"))).alias("lines"))
    total = F.aggregate("lines", F.lit(0), lambda a, x: a + x["n"])
    each = sized.select("id", "key", total.alias("total"), F.explode("lines").alias("x")).select("id", "key", "total", "x.line", "x.n")
    return each.groupBy("line", "key").agg(F.max("n").alias("n"), F.max("total").alias("total"), F.min("id").alias("first_id"))


def surplus(counts: DataFrame, max_docs: int) -> DataFrame:
    """The rows of ``counts`` whose line goes from their text: ``line, key, n, total``.

    A line goes where more than ``max_docs`` different texts of its host have it, except from
    the text with the smallest document id, so that one source of each line stays. The lines
    above the limit are written first; both sides of the join are then plain exchanges that
    adaptive execution can split where one line is very frequent.
    """
    often = cut(
        counts.groupBy("line")
        .agg(F.count("*").alias("docs"), F.min(F.struct("first_id", "key")).alias("first"))
        .where(F.col("docs") > max_docs)
        .select("line", F.col("first.key").alias("keeper"))
    )
    return counts.join(often, "line").where("key <> keeper").select("line", "key", "n", "total")


def depleted(gone: DataFrame, max_removed: float) -> DataFrame:
    """Keys of the texts that lose more than ``max_removed`` of their words with the lines ``gone``."""
    lost = gone.groupBy("key").agg(F.sum("n").alias("lost"), F.max("total").alias("total"))
    return lost.where(F.col("lost") > max_removed * F.col("total")).select("key", "lost")


def line_places(docs: DataFrame, gone: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """Rows ``(key, cuts)``: the places, in order, of the lines ``gone`` in the texts that have some.

    Only hashes and places of lines are exchanged, never texts.
    """
    lines = F.transform(_lines(F.col(text), blank=True), lambda x: F.xxhash64(F.coalesce(F.col(host), F.lit("\0")), x))
    hashed = docs.select(_text_key(F.col(host), F.col(text)).alias("key"), lines.alias("lines")).join(gone.select("key").distinct(), "key", "left_semi")
    # copies of a text have the same lines: one row for each place
    places = hashed.select("key", F.posexplode("lines").alias("place", "line")).groupBy("key", "place").agg(F.first("line").alias("line"))
    found = places.join(gone.select("line", "key"), ["key", "line"])
    return found.groupBy("key").agg(F.sort_array(F.collect_list("place")).alias("cuts"))


def _rest(text: Column, cuts: Column) -> Column:
    """A text without its lines at the places ``cuts``, put together from the stretches between them; linear in its length."""
    parts = F.split(text, "\n")
    # the array binds lines and ends once; a stretch goes from behind one line that goes to the next
    bound = F.array(F.struct(parts.alias("lines"), F.concat(F.array(F.lit(-1)), cuts, F.array(F.size(parts))).alias("ends")))
    stretches = F.transform(bound, lambda x: F.zip_with(F.slice(x["ends"], 1, F.size(x["ends"]) - 1), F.slice(x["ends"], 2, F.size(x["ends"]) - 1), lambda a, b: F.slice(x["lines"], a + 2, b - a - 1)))
    cleaned = F.array_join(F.flatten(F.flatten(stretches)), "\n")
    return F.when(cuts.isNull(), text).otherwise(cleaned)


def _named(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def base_features(text: Column) -> Column:
    """A struct of ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` as longs.

    Every intermediate array is bound once, as the variable of a function over an array of one,
    so the text is split once whatever is built on the result. Repeated windows are found by sorting
    the window hashes of one text, so the work is n log n in its words, and only where an equal pair exists.
    """
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.trim(F.translate(x, BLANKS[1:], " " * 5))) > 0)
    bind = lambda value, made: F.element_at(F.transform(F.array(value), made), 1)

    def repeated(w: Column) -> Column:
        size = F.size(w)
        at = lambda h: F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twin = lambda s: F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | ((i < F.size(s) - 1) & (F.get(s, i + 1)["h"] == x["h"])))
        covered = lambda f: F.size(F.array_distinct(F.flatten(F.transform(f, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
        found = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), bind(at(h), lambda s: bind(twin(s), covered))).otherwise(0)
        hashes = F.transform(F.sequence(F.lit(0), size - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(size > 3, bind(hashes, found)).otherwise(0).cast("long")

    def made(w: Column, l: Column) -> Column:  # noqa: E741
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0), lambda a, x: a + F.length(x)).cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size(l) - F.size(F.array_distinct(l))).cast("long").alias("n_dup_lines"),
            repeated(w).alias("n_repeat_words"),
        )

    return bind(words(text), lambda w: bind(lines, lambda l: made(w, l)))


def assess(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    doc_id: str = "doc_id",
    max_docs: int = 20,
    max_removed: float = 0.8,
) -> DataFrame:
    """The given columns with the base features, ``base_failed`` and ``kept``.

    ``kept`` is false for texts under 50 words, for texts of which more than half the words lie in
    repeated three-word windows, and for depleted texts: those that lose more than
    ``max_removed`` of their words with the lines that over ``max_docs`` different texts of their
    host share. A null text has no words and fails; null hosts are one host; repeated rows and
    exact copies share a verdict; of ties for the first text of a line the smaller key keeps it.
    Columns of the caller that have a result's name give way to the result; all others pass.
    """
    judged = _judged(docs, surplus(cut(line_counts(docs, text, host, doc_id)), max_docs), text, host, max_removed)
    own = [c for c in docs.columns if c not in MADE]
    return judged.select(*[F.col("own")[c].alias(c) for c in own], *[F.col("made")[c].alias(c) for c in MADE[:5]], "base_failed", "kept")


def clean(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    doc_id: str = "doc_id",
    max_docs: int = 20,
    max_removed: float = 0.8,
) -> DataFrame:
    """The rows that :func:`assess` keeps, with the given columns and without the lines above the limit.

    A line that over ``max_docs`` different texts of a host share stays in the first of them
    alone. The base rules judge the text as it came. ``n_chars`` follows the text where the
    frame has it.
    """
    gone = cut(surplus(cut(line_counts(docs, text, host, doc_id)), max_docs))
    lost = depleted(gone, max_removed).select("key")
    places = line_places(docs, gone, text, host).join(lost, "key", "left_anti")
    marks = places.select("key", F.lit(False).alias("lost"), "cuts").unionByName(lost.select("key", F.lit(True).alias("lost"), F.lit(None).cast("array<int>").alias("cuts")))
    passed = _featured(docs, text, host).where(~_failed()).select("own", "key")
    # the one exchange of texts, by the same plan at every size
    kept = passed.join(marks.hint("merge"), "key", "left").where("lost IS NULL OR NOT lost")
    rest = _rest(F.col("own")[text], F.col("cuts"))
    cleaned = kept.select(*[rest.alias(c) if c == text else F.col("own")[c].alias(c) for c in docs.columns])
    return cleaned.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cleaned


def _featured(docs: DataFrame, text: str, host: str) -> DataFrame:
    """Rows ``(own, key, made)``: the caller's columns in one struct, so that no names clash, and the base features.

    The features come out of a generator, below which no filter on them can be pushed: they
    are computed once for each row, whatever is asked of the result.
    """
    return docs.select(F.struct(*_named(docs)).alias("own"), _text_key(F.col(host), F.col(text)).alias("key"), F.explode(F.array(base_features(F.col(text)))).alias("made"))


def _failed() -> Column:
    return (F.col("made.n_words") < 50) | (100 * F.col("made.n_repeat_words") > 50 * F.col("made.n_words"))


def _judged(docs: DataFrame, gone: DataFrame, text: str, host: str, max_removed: float) -> DataFrame:
    """Rows ``(own, made, base_failed, kept)``: the caller's row, the base features and the verdicts."""
    lost = depleted(gone, max_removed).select("key", "lost")
    return _featured(docs, text, host).join(lost, "key", "left").select("own", "made", _failed().alias("base_failed"), (~_failed() & F.col("lost").isNull()).alias("kept"))
