"""Which event ids are stored, looked up without reading all of them.

Every load leaves a *run*: its ids in files by bucket of their hash, and a page of bits for
every few thousand ids, set where the hashes of the ids point. A batch is first held against the pages;
only buckets of runs in which a page says "maybe" are read. Eight runs of a
like size are merged into one, so the number of runs grows with the logarithm of the history.
Runs are parts of two versioned tables, ``ids/<table>`` and ``bloom/<table>``; a part's name
begins with its number of ids.
"""

from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import versions
from tidemark.sources.storage import nothing

ID = "source_event_id"
# A page has 32768 bits, the size of Spark's bitmap aggregates: 16 bits for each of 2048 ids.
# Six hashes then let one absent id in a thousand or so pass.
PAGE_IDS = 2048
HASHES = 6
# Pages whose ids share a bucket, the unit that is read.
BUCKET_PAGES = 24
MERGED = 8

_PAGE = "run string, pages long, page long, bits binary"


def _page(pages: Column) -> Column:
    return F.pmod(F.xxhash64(ID), pages)


def _positions() -> Column:
    """Bits of an id in its page: 15-bit stretches of two hashes that don't decide the page."""
    hashes = [F.xxhash64(F.col(ID), F.lit(seed)) for seed in (1, 2)]
    places = [F.shiftrightunsigned(hashes[i // 4], 15 * (i % 4)) for i in range(HASHES)]
    return F.array(*[p.bitwiseAND(F.lit(32767).cast("long")) for p in places])


def _runs(entries: versions.Entries, table: str) -> dict[str, tuple[int, str]]:
    """Runs of a table by name, with their numbers of ids and folders."""
    return {
        part: (int(part.split("-")[0]), path)
        for (name, part), path in entries.items()
        if name == f"ids/{table}"
    }


def _pages_of(rows: int) -> int:
    return -(-rows // PAGE_IDS)


def possible_buckets(
    spark: SparkSession, root: str, entries: versions.Entries, table: str, ids: DataFrame
) -> list[tuple[str, int]]:
    """(run, bucket) pairs that may hold an id of the batch; all that do are among them.

    At most one for each id and run; only these names reach the driver.
    """
    runs = _runs(entries, table)
    if not runs:
        return []
    folders = [path for (name, _), path in entries.items() if name == f"bloom/{table}"]
    pages = spark.read.schema(_PAGE).parquet(*[f"{root}/{path}" for path in folders])
    known = F.array(
        *[
            F.struct(F.lit(run).alias("run"), F.lit(_pages_of(rows)).cast("long").alias("pages"))
            for run, (rows, _) in runs.items()
        ]
    )
    probes = ids.select(ID, F.explode(known).alias("x")).select(ID, "x.run", "x.pages")
    probes = probes.select("run", _page(F.col("pages")).alias("page"), _positions().alias("at"))
    byte = lambda p: F.conv(F.hex(F.substring("bits", (p / 8).cast("int") + 1, 1)), 16, 10)
    is_set = lambda p: F.getbit(byte(p).cast("int"), F.pmod(p, F.lit(8)).cast("int")) == 1
    maybe = probes.join(pages.drop("pages"), ["run", "page"]).filter(F.forall("at", is_set))
    buckets = maybe.select("run", F.floor(F.col("page") / BUCKET_PAGES).cast("int").alias("bucket"))
    return sorted((r["run"], r["bucket"]) for r in buckets.distinct().collect())


def known_ids(
    spark: SparkSession, root: str, entries: versions.Entries, table: str, ids: DataFrame
) -> DataFrame:
    """Stored ids from the buckets that may hold one of the batch: all of its stored ids, and others."""
    runs = _runs(entries, table)
    found = possible_buckets(spark, root, entries, table, ids)
    if not found:
        return nothing(spark, f"{ID} string")
    paths = [f"{root}/{runs[run][1]}/bucket={bucket}" for run, bucket in found]
    return _ids(spark, root, table, paths)


def _ids(spark: SparkSession, root: str, table: str, paths: list[str]) -> DataFrame:
    reader = spark.read.schema(f"{ID} string").option("basePath", f"{root}/ids/{table}")
    return reader.parquet(*paths).select(ID)


def add_run(
    spark: SparkSession,
    root: str,
    entries: versions.Entries,
    table: str,
    ids: DataFrame,
    rows: int,
    version: str,
) -> versions.Entries:
    """Entries with a run for ``rows`` distinct new ids; like-sized runs are merged into it."""
    runs = _runs(entries, table)
    merged: set[str] = set()
    while True:
        rank = int(log(max(rows, 1), MERGED))
        alike = {r for r, (n, _) in runs.items() if r not in merged and int(log(max(n, 1), MERGED)) <= rank}
        if len(alike) < MERGED - 1:
            break
        merged |= alike
        rows += sum(runs[r][0] for r in alike)
    if merged:
        old = [f"{root}/{runs[r][1]}" for r in sorted(merged)]
        ids = ids.select(ID).unionByName(_ids(spark, root, table, old))
    entries = {
        (name, part): path
        for (name, part), path in entries.items()
        if not (name in (f"ids/{table}", f"bloom/{table}") and part in merged)
    }
    run, pages = f"{rows}-{version}", F.lit(_pages_of(rows)).cast("long")
    placed = ids.select(ID, _page(pages).alias("page"))
    folder = f"ids/{table}/version={version}"
    (
        placed.select(ID, F.floor(F.col("page") / BUCKET_PAGES).cast("int").alias("bucket"))
        .hint("rebalance", "bucket")
        .write.mode("overwrite")
        .partitionBy("bucket")
        .parquet(f"{root}/{folder}")
    )
    bits = (
        _ids(spark, root, table, [f"{root}/{folder}"])
        .select(_page(pages).alias("page"), F.explode(_positions()).alias("at"))
        .groupBy("page")
        .agg(F.bitmap_construct_agg("at").alias("bits"))
        .select(F.lit(run).alias("run"), pages.alias("pages"), "page", "bits")
    )
    bloom = f"bloom/{table}/version={version}"
    bits.write.mode("overwrite").parquet(f"{root}/{bloom}")
    return {**entries, (f"ids/{table}", run): folder, (f"bloom/{table}", run): bloom}

