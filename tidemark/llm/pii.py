"""Personal data found by labelers whose reliabilities are estimated without labels.

Patterns propose spans. Regular expressions, word lists and the words around a span vote for or
against it or abstain. Expectation-maximisation over the counts of vote patterns of all documents
estimates how far each labeler can be trusted and how likely every pattern is; a logistic classifier
of a span's votes, form and context is trained on these likelihoods and decides on spans
beyond the base ones.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import cut, ship

#: Kinds in the order of spans with the same start; the first four have base patterns.
KINDS = ["email", "ip", "card", "phone", "account"]
BASE = KINDS[:4]

# Base patterns, fixed values. They equal the plain forms without tries from inside a run of digits.
EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
EMAIL_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Looser forms, each with its kind; a find that meets a base span is left out.
LOOSE = [
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\]|\{at\}|(?<=\x20)at(?=\x20))\x20?[A-Za-z0-9-]++(?:\x20?(?:\(dot\)|\[dot\]|\{dot\}|(?<=\x20)dot(?=\x20))\x20?[A-Za-z0-9-]++)+", re.I)),
    ("ip", re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z])(?:00[0-9]{1,3}[\x20-])?(?:\([0-9]{2,5}\)\x20?|[0-9]{2,5}[\x20./-])[0-9]{3,4}[\x20.-][0-9]{3,5}(?![0-9A-Za-z])")),
    ("account", re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])")),
    ("account", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{4}[._/][0-9]{4}[._/][0-9]{4}[._/][0-9]{3,4}(?![0-9])")),
]

#: Words before or behind a span that speak for its kind.
CUES = {
    "email": {"mail", "email", "e-mail", "contact", "write", "mailto", "kontakt", "correo", "courriel", "adresse"},
    "ip": {"ip", "host", "server", "address", "client", "login", "from", "ping", "servidor", "serveur"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "cvv", "payment", "karte", "kreditkarte", "tarjeta", "carte"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "cell", "fax", "telefon", "handy", "teléfono", "móvil", "téléphone", "portable", "sms", "whatsapp"},
    "account": {"account", "iban", "ssn", "social", "security", "passport", "konto", "cuenta", "compte", "bank", "id"},
}
#: Words before a span that speak against personal data.
AGAINST = {"isbn", "issn", "order", "invoice", "version", "v", "ref", "page", "fig", "figure", "table", "no", "nr", "sku", "serial", "article", "part", "build", "token", "hash", "commit", "chapter", "section", "line", "total", "year", "doi"}
#: Endings of host names that are in use; others make an address unlikely.
ENDINGS = {"com", "org", "net", "edu", "gov", "info", "io", "co", "uk", "de", "fr", "es", "it", "nl", "eu", "ch", "at", "be", "pt", "br", "mx", "ar", "ca", "au", "jp", "cn", "in", "ru", "pl", "se", "no", "dk", "fi", "us", "biz", "me"}
LABELERS = ["pattern", "check", "cue", "against", "digits", "edges"]
#: Candidates of each kind that the classifier is trained on at most.
SAMPLE = 5000
HASHED = 1 << 12
THRESHOLD = 0.5
WORD = re.compile(r"[^\W\d_][\w-]*")


def luhn(digits: str) -> bool:
    doubled = [int(x) * 2 for x in digits[-2::-2]]
    return (sum(int(x) for x in digits[-1::-2]) + sum(x - 9 * (x > 9) for x in doubled)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    for tail in EMAIL_TAIL.finditer(text):
        start = tail.start()
        while start > end and text[start - 1] in EMAIL_LETTERS:
            start -= 1
        if start < tail.start():
            end = tail.end()
            yield start, end


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Base spans ``(start, kind number, end)`` in order: matches of the base patterns that pass their rules."""
    found = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = re.sub("[^0-9]", "", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int, int, bool]]:
    """Spans ``(start, kind number, end, base)`` in order: base ones, and looser finds that meet none of them."""
    base = base_spans(text)
    loose = [(m.start(), KINDS.index(kind), m.end()) for kind, pattern in LOOSE for m in pattern.finditer(text)]
    loose += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= m.end() - m.start() <= 38 and 12 <= len(re.sub("[^0-9]", "", m.group())) <= 19]
    found = [(*x, True) for x in base]
    end, ahead = 0, 0
    for start, kind, stop in sorted(loose, key=lambda x: (x[0], -x[2], x[1])):
        while ahead < len(base) and base[ahead][2] <= start:
            ahead += 1
        # base spans are few and short: those that begin before this one ends
        meets = any(b[0] < stop and b[2] > start for b in base[ahead : ahead + 8])
        if start >= end and not meets:
            found.append((start, kind, stop, False))
            end = stop
    return sorted(found)


def _checked(kind: str, span: str, digits: str) -> int:
    """The vote of a kind's own rule: check digits, ranges and lengths."""
    if kind == "card":
        return 1 if 12 <= len(digits) <= 19 and luhn(digits) else -1
    if kind == "phone":
        return 1 if 9 <= len(digits) <= 15 else 0 if len(digits) >= 7 else -1
    if kind == "email":
        return 1 if re.split(r"[\W_]+", span.strip(")]} ").lower())[-1] in ENDINGS else -1
    if kind == "ip":
        return 1
    flat = span.replace(" ", "")
    if flat[:1].isalpha():
        return 1 if int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1 else -1
    return 1 if digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000" else -1


def votes(text: str, start: int, kind: int, end: int, base: bool) -> tuple[list[int], list[int]]:
    """Votes of the labelers, 1 for, -1 against, 0 no opinion, and numbers of the hashed features of a span."""
    name, span = KINDS[kind], text[start:end]
    digits = re.sub("[^0-9]", "", span)
    before = [w.lower() for w in WORD.findall(text[max(0, start - 48) : start])[-4:]]
    behind = [w.lower() for w in WORD.findall(text[end : end + 32])[:2]]
    left, right = text[start - 1 : start], text[end : end + 1]
    made = [
        1 if base else 0,
        _checked(name, span, digits),
        1 if CUES[name] & {*before, *behind} else 0,
        -1 if AGAINST & {*before[-2:]} else 0,
        -1 if digits and (len(set(digits)) <= 2 or digits in "01234567890123456789") else 0,
        -1 if left.isalnum() or right.isalnum() or left in "/\\_#" and left else 1 if left in "\"'(<:=" and left else 0,
    ]
    shape = re.sub("[0-9]", "9", re.sub("[A-Za-z]", "a", span))
    short = re.sub(r"(.)\1+", r"\1+", shape)
    marks = [f"k{name}", f"s{name}{short[:24]}", f"n{name}{min(len(digits), 20)}", f"l{left if not left.isalnum() else 'a'}", f"r{right if not right.isalnum() else 'a'}"]
    marks += [f"v{i}{v}" for i, v in enumerate(made)] + [f"w{name}{i}{v}" for i, v in enumerate(made)] + [f"b{w}" for w in before[-2:]] + [f"a{w}" for w in behind[:1]]
    return made, sorted({zlib.crc32(m.encode("utf-8", "replace")) % HASHED for m in marks})


SPAN = "array<struct<start:int,kind:int,end:int,base:boolean,votes:array<int>,marks:array<int>>>"


def proposed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows ``(doc_id, found)``, one for each row: all candidates of the whole text with votes and features."""
    item = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("votes", pa.list_(pa.int32())), ("marks", pa.list_(pa.int32()))])
    schema = pa.schema([("doc_id", pa.int64()), ("found", pa.list_(item))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(1):
                t = value.as_py() or ""
                rows = []
                for start, kind, end, base in candidates(t):
                    made, marks = votes(t, start, kind, end, base)
                    rows.append({"start": start, "kind": kind, "end": end, "base": base, "votes": made, "marks": marks})
                out.append(rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, schema.field(1).type)], schema=schema)

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, f"doc_id long, found {SPAN}")


def reliabilities(kinds: np.ndarray, patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Likelihood of each vote pattern to be personal data, and each labeler's ``P(vote | label)``.

    Expectation-maximisation of a model with one hidden label: labelers vote independently given
    the label, each kind has a share of its own. It starts from labelers that are right in four of
    five votes; one count is added to every cell, so rare votes stay possible.
    """
    many = patterns.shape[1]
    # vote -1, 0, 1 given label 0, 1
    chance = np.tile(np.array([[0.4, 0.5, 0.1], [0.1, 0.5, 0.4]]), (many, 1, 1))
    share = np.full(len(KINDS), 0.5)
    at = patterns + 1
    for _ in range(rounds):
        fit = np.log(np.stack([1 - share[kinds], share[kinds]], 1))
        for j in range(many):
            fit = fit + np.log(chance[j][:, at[:, j]]).T
        likely = 1 / (1 + np.exp(np.clip(fit[:, 0] - fit[:, 1], -500, 500)))
        weight = np.stack([counts * (1 - likely), counts * likely], 0)
        before = chance.copy()
        for j in range(many):
            for v in range(3):
                chance[j][:, v] = weight[:, at[:, j] == v].sum(1) + (2 if v == 1 else 1)
            chance[j] /= chance[j].sum(1, keepdims=True)
        for k in range(len(KINDS)):
            share[k] = (weight[1, kinds == k].sum() + 1) / (counts[kinds == k].sum() + 2)
        if np.abs(chance - before).max() < 1e-9:
            break
    return likely, chance


@dataclass(frozen=True)
class Model:
    """Weights of the span classifier, one for each hashed feature and one of their own, and the labelers' chances."""

    weights: np.ndarray
    bias: float
    chance: np.ndarray

    def score(self, marks: list[list[int]]) -> np.ndarray:
        total = np.array([self.weights[m].sum() for m in marks]) + self.bias if marks else np.empty(0)
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def train(found: DataFrame) -> Model:
    """The classifier, from the candidates of :func:`proposed`.

    Vote patterns are counted over all documents; there are as many as kinds and votes allow. The
    classifier learns from ``SAMPLE`` candidates of each kind and side (base or not), drawn by a hash.
    """
    each = found.select("doc_id", F.explode("found").alias("x")).select("doc_id", "x.*")
    table = each.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()
    weights = np.zeros(HASHED)
    if not table:
        return Model(weights, -1.0, np.empty((0, 2, 3)))
    table.sort(key=lambda r: (r.kind, r.votes))
    likely, chance = reliabilities(np.array([r.kind for r in table]), np.array([r.votes for r in table]), np.array([r.n for r in table], np.float64))
    known = {(r.kind, *r.votes): p for r, p in zip(table, likely, strict=True)}
    drawn = Window.partitionBy("kind", "base").orderBy(F.xxhash64("doc_id", "start"), "doc_id", "start", "marks")
    rows = each.withColumn("rank", F.row_number().over(drawn)).where(F.col("rank") <= SAMPLE).select("kind", "votes", "marks").collect()
    rows.sort(key=lambda r: (r.kind, r.votes, r.marks))
    goal = np.array([known[(r.kind, *r.votes)] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r.marks) for r in rows])
    mark = np.concatenate([np.array(r.marks, np.int64) for r in rows])
    bias, slope, size, speed = 0.0, np.full(HASHED, 1e-6), 1e-6, 0.5
    for _ in range(300):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights[mark], len(rows)) + bias, -500, 500)))
        miss = (p - goal) / len(rows)
        gradient = np.bincount(mark, miss[row], HASHED) + 1e-5 * weights
        slope, size = slope + gradient**2, size + miss.sum() ** 2
        weights, bias = weights - speed * gradient / np.sqrt(slope), bias - speed * miss.sum() / np.sqrt(size)
    return Model(weights, float(bias), chance)


def spans(found: DataFrame, model: Model) -> DataFrame:
    """Rows ``(doc_id, spans)``: base spans, and candidates that the classifier takes for personal data.

    A span has ``start`` and ``end`` in code points, ``kind``, ``base`` and ``score``.
    """
    item = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(item))])
    known = found.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for rows in batch.column(1).to_pylist():
                scores = known.value.score([r["marks"] for r in rows])
                out.append([{**{k: r[k] for k in ("start", "kind", "end", "base")}, "score": float(s)} for r, s in zip(rows, scores, strict=True) if r["base"] or s >= THRESHOLD])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, schema.field(1).type)], schema=schema)

    numbered = found.mapInArrow(run, "doc_id long, spans array<struct<start:int,kind:int,end:int,base:boolean,score:double>>")
    kind = F.array(*map(F.lit, KINDS))
    return numbered.select("doc_id", F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.get(kind, x["kind"]).alias("kind"), x["base"].alias("base"), x["score"].alias("score"))).alias("spans"))


def find(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows ``(doc_id, spans)``, one for each row of ``docs``: all personal data of its whole text.

    A null or empty text has no spans; repeated rows and ids each have their own row; ties between
    labelers give a likelihood of one half and are kept out by the classifier's other features; a null
    id stays null; other columns have no effect; no rows give no rows. Texts are read once.
    """
    ship(docs.sparkSession)
    found = cut(proposed(docs, text, doc_id))
    return spans(found, train(found))


def redact(text: Column, found: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of spans that meet, the first."""
    step = F.reduce(
        found,
        F.struct(F.lit("").alias("made"), F.lit(0).alias("at")),
        lambda a, x: F.when(x["start"] < a["at"], a).otherwise(
            F.struct(F.concat(a["made"], F.substring(text, a["at"] + 1, x["start"] - a["at"]), F.lit("["), x["kind"], F.lit("]")).alias("made"), x["end"].alias("at"))
        ),
    )
    return F.concat(step["made"], F.substring(text, step["at"] + 1, F.length(text)))


def digests(found: DataFrame) -> DataFrame:
    """Rows ``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` from those of :func:`find`; counts are of base spans."""
    base = F.filter("spans", lambda x: x["base"])
    line = lambda some: F.array_join(F.transform(some, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    of = lambda kind: F.filter(base, lambda x: x["kind"] == kind)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(line(base).cast("binary"), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))
