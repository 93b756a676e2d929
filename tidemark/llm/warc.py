"""Resolution of not-modified revisit records against earlier full responses.

Records are rows ``(record_id, kind, url, at, headers)`` with ``kind`` ``response`` or
``revisit``, ``at`` in seconds and ``headers`` a map with lower-case names; a response also
has the ``digest`` of its payload. Payloads themselves aren't moved: the result names the response.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Headers of a not-modified response that replace those of the stored response (RFC 9111, RFC 9110).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
#: Seconds of a stretch of time. A URL's records are ordered within a stretch, then its stretches.
STRETCH = 86_400


def canonical(url: Column) -> Column:
    """Scheme and host in lower case, no default port, no fragment, parameters sorted without ``utm_``.

    Text that has no scheme and host stays as it is, trimmed; a null stays null.
    """
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    shape = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]*)([^?]*)\??(.*)$"
    part = lambda i: F.regexp_extract(u, shape, i)
    scheme, host = F.lower(part(1)), F.lower(part(2))
    port = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    path = F.when(part(3) == "", "/").otherwise(part(3))
    args = F.array_join(F.array_sort(F.filter(F.split(part(4), "&"), lambda x: (x != "") & ~F.startswith(x, F.lit("utm_")))), "&")
    return F.when(part(2) == "", u).otherwise(F.concat(scheme, F.lit("://"), port, path, F.when(args == "", "").otherwise(F.concat(F.lit("?"), args))))


def _tag(headers: Column) -> Column:
    """Entity tag for a weak comparison."""
    return F.regexp_replace(headers["etag"], "^W/", "")


def resolve(records: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """One row for each revisit: the latest full response of its canonical URL that is strictly earlier.

    Columns ``record_id, canonical_url, at, response_id, response_at, digest, status, headers``. The
    status is ``resolved`` (a validator was compared and agrees: the entity tag if both have
    one, else the date of change), ``mismatch``, ``unchecked`` (nothing to compare) or ``missing``
    (no earlier response, or a null URL or time). Only a resolved or unchecked revisit gets the
    response's headers, with the permitted ones of its own in their place; else it keeps its own.
    Of responses at one time the largest id counts. Repeated revisits give repeated rows.

    A hot URL isn't ordered by one task: its records are ordered within stretches of time, and
    the last response of each stretch, one row, is carried to later ones.
    """
    r = records.select("record_id", "kind", canonical(F.col("url")).alias("canonical_url"), "at", "headers", "digest")
    r = r.withColumn("stretch", F.floor(F.col("at") / stretch))
    full = F.when(F.col("kind") == "response", F.struct(F.col("at").alias("at"), "record_id", "digest", "headers"))
    r = r.withColumn("own", full)
    # at one time revisits stand first, so a response of the same second isn't earlier
    order = W.partitionBy("canonical_url", "stretch").orderBy("at", F.col("kind") == "response", "record_id")
    near = r.withColumn("near", F.last("own", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1)))
    sort_key = F.struct(F.col("own.at"), F.col("own.record_id"))
    ends = r.where("kind = 'response' AND canonical_url IS NOT NULL AND at IS NOT NULL").groupBy("canonical_url", "stretch").agg(F.max_by("own", sort_key).alias("own"))
    revisits = near.where("kind = 'revisit'")
    # stretches that hold revisits, each with the last response of any earlier one
    asked = revisits.where("near IS NULL AND canonical_url IS NOT NULL AND at IS NOT NULL").select("canonical_url", "stretch").distinct()
    steps = ends.unionByName(asked.withColumn("own", F.lit(None).cast(ends.schema["own"].dataType)))
    steps = steps.groupBy("canonical_url", "stretch").agg(F.max("own.at").alias("t"), F.first("own", ignorenulls=True).alias("own")).drop("t")
    over = W.partitionBy("canonical_url").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    before = steps.withColumn("earlier", F.last("own", ignorenulls=True).over(over)).select("canonical_url", "stretch", "earlier")
    found = revisits.join(before, ["canonical_url", "stretch"], "left").withColumn("got", F.coalesce("near", "earlier"))
    mine, theirs = F.col("headers"), F.col("got.headers")
    tags = _tag(mine).isNotNull() & _tag(theirs).isNotNull()
    dates = mine["last-modified"].isNotNull() & theirs["last-modified"].isNotNull()
    agrees = F.when(tags, _tag(mine) == _tag(theirs)).when(dates, mine["last-modified"] == theirs["last-modified"])
    known = F.col("canonical_url").isNotNull() & F.col("at").isNotNull() & F.col("got").isNotNull()
    status = F.when(~known, "missing").when(agrees.isNull(), "unchecked").when(agrees, "resolved").otherwise("mismatch")
    allowed = F.map_filter(F.coalesce(mine, F.create_map().cast("map<string,string>")), lambda k, v: k.isin(PERMITTED))
    rest = F.map_filter(F.coalesce(theirs, F.create_map().cast("map<string,string>")), lambda k, v: ~F.array_contains(F.map_keys(allowed), k))
    return found.withColumn("status", status).select(
        "record_id", "canonical_url", "at", F.when(known, F.col("got.record_id")).alias("response_id"), F.when(known, F.col("got.at")).alias("response_at"),
        F.when(known, F.col("got.digest")).alias("digest"), "status",
        F.when(F.col("status").isin("resolved", "unchecked"), F.map_concat(rest, allowed)).otherwise(mine).alias("headers"),
    )


def records_of_pages(pages: DataFrame) -> DataFrame:
    """A crawl log made of pages: each page is a full response and is asked for once more, an hour later.

    The id's remainder by four decides what the second request finds: an equal tag (written as weak), another
    tag, only an equal date of change, or no validator. It also spells the URL in another way.
    """
    at = F.col("page_id") * 60
    changed = F.concat(F.lit("day "), F.floor(F.col("page_id") / 1000).cast("string"))
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    pair = lambda *x: F.create_map(*[F.lit(v) if isinstance(v, str) else v for v in x])
    response = pages.select(
        (F.col("page_id") * 2).alias("record_id"), F.lit("response").alias("kind"), "url", at.alias("at"),
        pair("content-type", "text/html", "date", at.cast("string"), "etag", tag, "last-modified", changed, "server", "one").alias("headers"), F.sha1(F.coalesce("html", F.lit(""))).alias("digest"),
    )
    late = at + 3600
    role = F.pmod(F.col("page_id"), F.lit(4))
    base = pair("content-type", "text/plain", "date", late.cast("string"), "expires", (late + 60).cast("string"))
    more = (
        F.when(role == 0, pair("etag", F.concat(F.lit("W/"), tag)))
        .when(role == 1, pair("etag", '"other"'))
        .when(role == 2, pair("last-modified", changed))
        .otherwise(F.create_map().cast("map<string,string>"))
    )
    spelt = F.concat(F.regexp_replace(F.regexp_replace("url", "#.*$", ""), "^http", "HTTP"), F.lit("#again"))
    revisit = pages.select((F.col("page_id") * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), spelt.alias("url"), late.alias("at"), F.map_concat(base, more).alias("headers"), F.lit(None).cast("string").alias("digest"))
    return response.unionByName(revisit)
