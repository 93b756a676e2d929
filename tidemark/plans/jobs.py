"""Daily run, backfill, range rebuild, validation and export over a folder of tables.

Tables below ``root`` are versioned folders (see :mod:`tidemark.sources.versions`):
``raw/<table>`` append-only events, one part for each load; ``newest/<table>`` the newest
version of each key, by month of the business date or by a hash of the key;
``mart/<table>`` by report date; ``ledger/exposure`` the balance changes of all time,
``ledger/campaign`` those of the campaign mart and ``counts/references`` the counts behind the
reference checks, all kept up by the rows that a load changes. ``audit/<table>`` are plain
tables. One writer per root is assumed.
"""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, date, datetime, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.span import ReportSpan, report_span, single
from tidemark.operators.affected import affected_dates
from tidemark.operators.canonical import latest_version, merge_latest
from tidemark.operators.ingest import (
    idempotent_append,
    negative_request_rule,
    null_counts,
    quarantine,
)
from tidemark.operators.quality import all_checks, dq_summary, gate
from tidemark.operators.references import CHECKED, COUNTS, counted, value_changes
from tidemark.operators.upsert import keyed_upsert
from tidemark.plans.acquisition import (
    ATTRIBUTION_DAYS,
    CAMPAIGN_LEDGER,
    campaign_changes,
    campaign_difference,
    campaign_from_ledger,
    campaign_kpi,
    credit_kpi,
    touch_days_of,
)
from tidemark.plans.exposure import (
    ALWAYS,
    LEDGER,
    exposure_ledger,
    ledger_difference,
    ledger_within,
    portfolio_from_changes,
    vintage_from_changes,
)
from tidemark.schemas import (
    AUDIT,
    DQ_SUMMARY,
    EVENTS,
    KEYS,
    MARTS,
    REJECTED_EVENTS,
    RUN_LOG,
    conform,
)
from tidemark.sources import layouts, membership, signed, versions
from tidemark.sources.storage import (
    append,
    delete_folder,
    export_csv,
    overwrite_partitions,
    read_table,
)

# Total orders, so an export has the same rows in the same order every time.
EXPORT_ORDER = {
    "daily_credit_kpi": ["channel", "risk_grade", "product_code"],
    "daily_portfolio_kpi": ["risk_grade"],
    "daily_campaign_kpi": ["campaign_id", "touch_date", "channel"],
    "vintage_kpi": ["origination_month", "months_on_book"],
}

# Tables whose newest versions are kept by month of a date.
BY_MONTH = {"marketing_touch": "touch_date", "application": "application_date"}
# The others are kept by a hash of the column by which the rows of a loan are looked up, in so
# many buckets. One installment can hold very many payments, so a bucket of them is spread
# over parts by their own id, and a correction rewrites one.
PLACE = {
    "customer": ("customer_id", 64),
    "loan": ("loan_id", 64),
    "installment": ("loan_id", 64),
    "payment": ("installment_id", 16),
}
SPREAD = {"payment": 12}
# Up to so many keys are named in the filter of a look-up; more of them come by a join.
NAMED_KEYS = 1000
# Newest versions of single loads; folded when they hold more than one in FOLD of the events.
RECENT = "recent"
# Entries of this kind tell for which dates a mart holds what the current events give.
BUILT = "built/"
# Entries of this kind tell the value of a check for the current events.
CHECK_VALUE = "check/"
FOLD = 8


# Marts whose columns have changed, with the steps from the first layout to the declared one.
MART_LAYOUTS = {
    "daily_campaign_kpi": layouts.Layouts(
        MARTS["daily_campaign_kpi"],
        # rows from before the touch date existed lack the column or its value
        (layouts.Step({"touch_date date": "coalesce(touch_date, report_date)"}),),
    ),
}


class RunFailure(RuntimeError):
    pass


def _version() -> str:
    return uuid4().hex[:12]


def raw_table(spark: SparkSession, root: str, name: str, entries=None) -> DataFrame:
    entries = versions.current(spark, root) if entries is None else entries
    return versions.read(spark, root, entries, f"raw/{name}", EVENTS[name])


def mart_table(spark: SparkSession, root: str, name: str, entries=None) -> DataFrame:
    entries = versions.current(spark, root) if entries is None else entries
    if name in MART_LAYOUTS:
        return layouts.read(spark, root, entries, f"mart/{name}", MART_LAYOUTS[name])
    return versions.read(spark, root, entries, f"mart/{name}", MARTS[name])


def migrate(spark: SparkSession, root: str) -> int:
    """Write mart parts that are in older layouts again in the newest; returns how many there were.

    Readers upgrade them anyway, so this only saves them the work.
    """
    old = entries = versions.current(spark, root)
    for name, steps in MART_LAYOUTS.items():
        entries = layouts.rewritten(
            spark, root, entries, f"mart/{name}", steps, _version(), "report_date"
        )
    changed = sum(entries.get(key) != path for key, path in old.items())
    if changed:
        versions.publish(spark, root, entries)
    return changed


def _in_parallel(tasks: list) -> list:
    """Run independent Spark writes at the same time; the first error is raised."""
    with ThreadPoolExecutor(max_workers=max(1, len(tasks))) as pool:
        return [done.result() for done in [pool.submit(task) for task in tasks]]


def _part_of(name: str):
    """The part in which the newest version of a row is kept."""
    if name in BY_MONTH:
        return F.date_format(BY_MONTH[name], "yyyy-MM")
    if name in SPREAD:
        within = F.pmod(F.xxhash64(KEYS[name]), F.lit(SPREAD[name])).cast("string")
        return F.concat_ws(".", _bucket(name), within)
    return _bucket(name)


def _bucket(name: str):
    column, buckets = PLACE[name]
    number = F.pmod(F.xxhash64(column), F.lit(buckets)).cast("string")
    return F.concat(F.lit(f"{column}-"), number)


def _order(name: str) -> list[str]:
    """Columns by which the rows of a part are sorted, so that look-ups skip row groups."""
    return [] if name in BY_MONTH else [PLACE[name][0]]


def checked(name: str, frame: DataFrame) -> DataFrame:
    """The batch rows in the declared schema; refused if a declared value is missing."""
    rows = conform(frame, EVENTS[name])
    missing = null_counts(rows, [f.name for f in EVENTS[name] if not f.nullable])
    if missing:
        told = ", ".join(f"{column} in {n} rows" for column, n in sorted(missing.items()))
        raise ValueError(f"{name} events without a value: {told}")
    return rows


def stage_events(
    spark: SparkSession,
    root: str,
    entries: versions.Entries,
    batch: dict[str, DataFrame],
    seen: Callable[[dict[str, DataFrame], versions.Entries], None] | None = None,
) -> tuple[int, versions.Entries]:
    """Write the unseen events of a batch and the newest versions they change.

    Returns the rows added and the entries with the new folders; nothing is current yet. ``seen``
    is handed the changed rows by table and the new entries while the rows are still there.
    All tables are checked before anything is written. Stored ids and newest versions are read
    where the batch can meet them, and what is written follows the size of the batch.
    """
    version = _version()
    staging = f"{root}/staging/batch-{version}"
    try:
        return _staged(spark, root, entries, batch, version, staging, seen)
    finally:
        delete_folder(spark, staging)


def _staged(spark, root, entries, batch, version, staging, seen) -> tuple[int, versions.Entries]:
    # the batch is read several times, so it is taken from its source once
    named = [name for name in KEYS if name in batch]
    for name in named:
        conform(batch[name], EVENTS[name]).write.parquet(f"{staging}/{name}")
    batch = {n: checked(n, spark.read.schema(EVENTS[n]).parquet(f"{staging}/{n}")) for n in named}

    images = {n: f"{staging}/images-{n}" for n in named}

    def load(name):
        known = entries
        if any(t == f"raw/{name}" for t, _ in known) and not any(t == f"ids/{name}" for t, _ in known):
            # events stored before ids were indexed
            old = raw_table(spark, root, name, known)
            known = membership.add_run(spark, root, known, name, old, old.count(), f"{version}i")
        ids = membership.known_ids(spark, root, known, name, batch[name])
        unseen = idempotent_append(ids, batch[name])
        added, raw = versions.stage(unseen, root, f"raw/{name}", version)
        if not added:
            return 0, {}, set()
        new = raw_table(spark, root, name, {(f"raw/{name}", v): p for v, p in raw.items()})
        indexed = membership.add_run(spark, root, known, name, new, added, version)
        newest, gone = _add_newest(
            spark, root, name, known, new, added, version, images[name]
        )
        fresh = {k: p for k, p in indexed.items() if known.get(k) != p or entries.get(k) != p}
        gone |= {k for k in entries if k not in indexed}
        return added, {**{(f"raw/{name}", v): p for v, p in raw.items()}, **fresh, **newest}, gone

    total, made, gone, changed = 0, {}, set(), {}
    loads = _in_parallel([lambda name=name: load(name) for name in batch])
    for name, (added, parts, left) in zip(batch, loads, strict=True):
        total += added
        made |= parts
        gone |= left
        if added:
            changed[name] = spark.read.schema(f"{versions.ddl(EVENTS[name])}, sign int").parquet(
                images[name]
            )
    # marts aren't those of these events before they are refreshed
    gone |= {k for k in entries if total and k[0].startswith(BUILT)}
    after = {**{k: p for k, p in entries.items() if k not in gone}, **made}
    if not changed:
        return total, after
    if seen:
        seen(changed, after)
    ledger, campaign, counts = _in_parallel(
        [
            lambda: _kept_ledger(spark, root, entries, after, changed, version, staging),
            lambda: _kept_campaign(spark, root, entries, after, changed, version, staging),
            lambda: _kept_counts(spark, root, entries, after, changed, version, staging),
        ]
    )
    stale = (LEDGER.table, CAMPAIGN_LEDGER.table, COUNTS.table)
    kept = {k: p for k, p in after.items() if k[0] not in stale}
    return total, {**kept, **ledger, **campaign, **counts}


def _entries_of(entries: versions.Entries, *kinds: str) -> versions.Entries:
    return {k: p for k, p in entries.items() if k[0].startswith(kinds)}


def _kept_ledger(spark, root, old, new, changed, version, staging) -> versions.Entries:
    """Entries of the stored ledger with what the changed rows alter.

    Only the rows of the loans that they belong to are read, before and after. A root
    without a ledger, one on its first load among them, gets the changes of all its loans.
    """
    kept = _entries_of(old, LEDGER.table)
    if not changed.keys() & {"loan", "installment", "payment"}:
        return kept
    if not kept:
        t = {name: _newest(spark, root, name, new) for name in ("installment", "loan", "payment")}
        whole = exposure_ledger(t["installment"], t["loan"], t["payment"], ALWAYS)
        return signed.add(spark, root, kept, LEDGER, whole, version)
    loans = _changed_loans(spark, root, new, changed, staging)
    loans = _written(loans, f"{staging}/loans", "loan_id long")
    after = _loan_rows(spark, root, new, loans, f"{staging}/installments")
    table = "newest/installment"
    if _entries_of(old, table) == _entries_of(new, table):
        before = _loan_rows(spark, root, old, loans, f"{staging}/installments", again=True)
    else:
        before = _loan_rows(spark, root, old, loans, f"{staging}/old-installments")
    difference = ledger_difference(before, after)
    return signed.add(spark, root, kept, LEDGER, difference, version)


def _kept_campaign(spark, root, old, new, changed, version, staging) -> versions.Entries:
    """Entries of the campaign ledger with what the changed rows alter.

    New touches meet all applications in reach, stored touches the changed ones, and what they
    were credited with before is taken back. Touches and applications are read from the months
    around these days. A root without a campaign ledger gets that of all its touches.
    """
    kept = _entries_of(old, CAMPAIGN_LEDGER.table)
    if not changed.keys() & {"marketing_touch", "application", "loan"}:
        return kept
    names = ("marketing_touch", "application", "loan")
    if not kept:
        t = {name: _newest(spark, root, name, new) for name in names}
        whole = campaign_changes(t["marketing_touch"], t["application"], t["loan"])
        return signed.add(spark, root, kept, CAMPAIGN_LEDGER, whole, version)
    applied = _newest(spark, root, "application", new)
    touch_days_of(changed, applied).write.parquet(f"{staging}/touch-days")
    ddl = "customer_id long, campaign_id string, touch_date date"
    touch_days = spark.read.schema(ddl).parquet(f"{staging}/touch-days")
    months = {
        "marketing_touch": _months(touch_days, "touch_date"),
        "application": _months(touch_days, "touch_date", f"date_add(touch_date, {ATTRIBUTION_DAYS})"),
    }

    def rows(entries):
        t = {name: _newest(spark, root, name, entries) for name in names}
        return {n: f.filter(F.col("part").isin(months[n])) if n in months else f for n, f in t.items()}

    difference = campaign_difference(rows(old), rows(new), touch_days)
    return signed.add(spark, root, kept, CAMPAIGN_LEDGER, difference, version)


def _months(rows: DataFrame, *dates: str) -> list[str]:
    """Months, as parts are named, of date expressions of the rows; the calendar bounds them."""
    named = ", ".join(f"date_format({d}, 'yyyy-MM')" for d in dates)
    return [r[0] for r in rows.selectExpr(f"explode(array({named}))").distinct().collect()]


def _written(rows: DataFrame, path: str, ddl: str) -> DataFrame:
    """The rows, written once and read from there."""
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(ddl).parquet(path)


def _changed_loans(spark, root, entries, changed, staging) -> DataFrame:
    """Ids of the loans whose own row, installments or payments are among the changed rows."""
    found = [changed[n].select("loan_id") for n in ("loan", "installment") if n in changed]
    if "payment" in changed:
        # A payment counts for the loan of its installment, which its own loan id need not be.
        paid = changed["payment"].select("installment_id", "loan_id").distinct()
        paid = _written(paid, f"{staging}/paid", "installment_id long, loan_id long")
        hinted = rows_under(spark, root, "installment", entries, paid.select("loan_id").distinct())
        owners = hinted.select("installment_id", F.col("loan_id").alias("owner"))
        owned = paid.select("installment_id").distinct().join(owners, "installment_id", "left")
        owned = _written(owned, f"{staging}/owned", "installment_id long, owner long")
        found.append(owned.filter("owner is not null").select(F.col("owner").alias("loan_id")))
        strays = owned.filter("owner is null")
        if not strays.isEmpty():
            others = _newest(spark, root, "installment", entries).join(
                strays.select("installment_id"), "installment_id", "left_semi"
            )
            found.append(others.select("loan_id"))
    every = found[0]
    for one in found[1:]:
        every = every.unionAll(one)
    return every.distinct()


def _loan_rows(spark, root, entries, loans, path: str, again: bool = False) -> dict[str, DataFrame]:
    """Newest versions of some loans, of their installments and of the payments of these.

    The installments' ids are written to ``path``, unless they are there already.
    """
    installments = rows_under(spark, root, "installment", entries, loans)
    ddl = "installment_id long"
    ids = (
        spark.read.schema(ddl).parquet(path)
        if again
        else _written(installments.select("installment_id").distinct(), path, ddl)
    )
    return {
        "loan": rows_under(spark, root, "loan", entries, loans),
        "installment": installments,
        "payment": rows_under(spark, root, "payment", entries, ids),
    }


def rows_under(
    spark: SparkSession, root: str, name: str, entries: versions.Entries, parents: DataFrame
) -> DataFrame:
    """Newest versions whose :data:`PLACE` column is one of ``parents``, a frame of that column.

    Only parts that can hold them are read; few parents are also named in the scan's filter.
    """
    column = PLACE[name][0]
    keyed = parents.select(column, _bucket(name).alias("part"))
    few = keyed.limit(NAMED_KEYS + 1).collect()
    named = len(few) <= NAMED_KEYS
    parts = {r["part"] for r in (few if named else keyed.select("part").distinct().collect())}
    # recent parts hold all keys, and so do parts that were placed by another column
    wanted = {
        (table, part): path
        for (table, part), path in entries.items()
        if table == f"newest/{name}"
        and (part.split(".")[0] in parts or not part.startswith(f"{column}-"))
    }
    rows = _newest(spark, root, name, wanted).drop("part")
    if named:
        return rows.filter(F.col(column).isin([r[0] for r in few]))
    return rows.join(parents, column, "left_semi")


def _kept_counts(spark, root, old, new, changed, version, staging) -> versions.Entries:
    """Entries of the reference counts and of the check values after the changed rows."""
    kept = _entries_of(old, COUNTS.table)
    values = {name: old.get((f"{CHECK_VALUE}{name}", "value")) for name in CHECKED}
    if None in values.values():
        # events from before the counts were kept
        kept, values = {}, dict.fromkeys(CHECKED, 0)
        changed = {n: _newest(spark, root, n, new).withColumn("sign", F.lit(1)) for n in KEYS}
    changes = counted(changed)
    if changes is None:
        return {**kept, **_entries_of(old, CHECK_VALUE)}
    changes = _written(changes, f"{staging}/counts", versions.ddl(COUNTS.schema))
    buckets = signed.buckets_of(COUNTS, changes) if kept else []
    difference = value_changes(signed.read(spark, root, kept, COUNTS, buckets), changes)
    told = {
        (f"{CHECK_VALUE}{name}", "value"): str(int(value) + difference.get(name, 0))
        for name, value in values.items()
    }
    return {**signed.add(spark, root, kept, COUNTS, changes, version), **told}


def check_values(entries: versions.Entries) -> dict[str, int]:
    """Values of the reference checks for the current events, as far as they are kept up."""
    found = {name: entries.get((f"{CHECK_VALUE}{name}", "value")) for name in CHECKED}
    return {name: int(value) for name, value in found.items() if value is not None}


def _add_newest(
    spark, root, name, entries, new: DataFrame, added: int, version: str, images: str
) -> tuple[versions.Entries, set]:
    """Parts with the newest versions that the new events change, and the parts they replace.

    The changed rows are written to ``images``: with sign 1 those that are the newest now,
    with sign -1 those that they replace.

    The new events that are the newest of their key become a *recent* part, which goes before the
    others when the table is read. Recent parts are folded into the others, of which
    only those with a key of theirs are written again, when they
    hold more than a share of all events; so what a load writes follows its batch.
    """
    table, key = f"newest/{name}", KEYS[name]
    before = _newest(spark, root, name, entries).drop("part")
    ddl = f"{versions.ddl(EVENTS[name])}, sign int"
    changes_only = True
    signs = _written(merge_latest(before, new, key, changes_only), images, ddl)
    won = signs.filter("sign = 1").drop("sign")
    recent = {p: int(p.split("-")[1]) for (t, p) in entries if t == table and p.startswith(RECENT)}
    events = added + sum(int(p.split("-")[0]) for (t, p) in entries if t == f"ids/{name}")
    if (sum(recent.values()) + added) * FOLD <= events:
        rows, parts = versions.stage(
            won.withColumn("part", F.lit(RECENT)), root, table, version, "part", _order(name)
        )
        return {(table, f"{RECENT}-{rows}-{version}"): p for p in parts.values()}, set()
    base, late = _layers(spark, root, name, entries)
    changed = won if late is None else latest_version(late.unionByName(won), key)
    changed = changed.withColumn("part", _part_of(name))
    touched = {r["part"] for r in changed.select("part").distinct().collect()}
    # a correction may move a row to another month or loan
    moved = base.select(key, "part").join(changed.select(key), key, "left_semi")
    touched |= {r["part"] for r in moved.select("part").distinct().collect()}
    beside = base.filter(F.col("part").isin(sorted(touched)))
    kept = beside.join(changed.select(key), key, "left_anti")
    _, parts = versions.stage(
        kept.unionByName(changed), root, table, version, "part", _order(name)
    )
    gone = {(table, p) for p in {*touched, *recent}}
    return {(table, p): path for p, path in parts.items()}, gone


def load_events(spark: SparkSession, root: str, batch: dict[str, DataFrame]) -> int:
    """Add the unseen events of a batch and bring the newest versions up to date.

    Both change by one switch, so a broken load leaves everything as it was. Batch jobs
    and streams load through here alike.
    """
    _sweep(spark, root)
    added, entries = stage_events(spark, root, versions.current(spark, root), batch)
    if added:
        versions.publish(spark, root, entries)
    return added


def _sweep(spark: SparkSession, root: str) -> None:
    tables = [f"{kind}/{name}" for kind in ("raw", "newest", "ids", "bloom") for name in KEYS]
    tables += [LEDGER.table, CAMPAIGN_LEDGER.table, COUNTS.table, *[f"mart/{name}" for name in MARTS]]
    versions.sweep(spark, root, tables)


def _layers(spark, root, name, entries) -> tuple[DataFrame, DataFrame | None]:
    """Stored newest versions by part, and the recent ones that go before them, if there are any."""
    table = f"newest/{name}"
    stored = versions.read(spark, root, entries, table, EVENTS[name], "part")
    if not any(t == table and p.startswith(RECENT) for t, p in entries):
        return stored, None
    return stored.filter(F.col("part") != RECENT), stored.filter(F.col("part") == RECENT).drop("part")


def _newest(spark, root, name, entries) -> DataFrame:
    base, late = _layers(spark, root, name, entries)
    if late is None:
        return base
    # a recent row was the newest of its key when it came, so stored rows with its key are older
    late = latest_version(late, KEYS[name]).withColumn("part", _part_of(name))
    kept = base.join(late.select(KEYS[name]), KEYS[name], "left_anti")
    return kept.unionByName(late).select(*base.columns)


def canonical_tables(
    spark: SparkSession, root: str, entries=None, span: ReportSpan | None = None
) -> dict[str, DataFrame]:
    """The stored newest versions; nothing is written.

    With a ``span``, touches and applications are read from the months that its reports
    can depend on: :data:`REACH` days before it up to its end.
    """
    entries = versions.current(spark, root) if entries is None else entries
    tables = {}
    for name in KEYS:
        frame = _newest(spark, root, name, entries)
        if span and name in BY_MONTH:
            first = (span.start - timedelta(days=REACH)).strftime("%Y-%m")
            frame = frame.filter(F.col("part").between(first, span.end.strftime("%Y-%m")))
        tables[name] = frame.drop("part")
    return tables


# Days before a report date on which a touch or an application can still count in its marts and checks.
REACH = 31


def stage_marts(
    tables: dict[str, DataFrame],
    root: str,
    entries: versions.Entries,
    span: ReportSpan,
    marts=tuple(MARTS),
    only: dict[str, list[date]] | None = None,
    anew: bool = False,
) -> tuple[dict[str, int], versions.Entries]:
    """Write the marts of every date in the span; returns rows and entries, not yet current.

    With ``only``, a mart's dates outside its list are taken to be right: they are neither
    computed, but for gaps between listed dates, nor written. Portfolio, vintage and
    campaign come from the stored ledgers, or ``anew`` from the events.
    """
    spark = tables["loan"].sparkSession
    version = _version()
    dates = {name: span.dates if only is None else only.get(name, []) for name in marts}
    marts = [name for name in marts if dates[name]]
    for name in dates:
        entries = {**entries, (f"{BUILT}{name}", "span"): f"{span.start}..{span.end}"}

    def within(*names):
        days = [day for name in names if name in marts for day in dates[name]]
        return ReportSpan(min(days), max(days))

    def write(name, frame):
        if only is not None:
            frame = frame.filter(F.col("report_date").isin(dates[name]))
        marked = MART_LAYOUTS[name].mark(version) if name in MART_LAYOUTS else version
        rows, parts = versions.stage(frame, root, f"mart/{name}", marked, "report_date")
        return name, rows, parts

    def credit():
        span = within("daily_credit_kpi")
        frame = credit_kpi(tables["application"], tables["customer"], tables["loan"], span)
        return [write("daily_credit_kpi", frame)]

    def campaign():
        span = within("daily_campaign_kpi")
        if signed.stored(entries, CAMPAIGN_LEDGER) and not anew:
            ledger = signed.read(spark, root, entries, CAMPAIGN_LEDGER)
            return [write("daily_campaign_kpi", campaign_from_ledger(ledger, span))]
        frame = campaign_kpi(
            tables["marketing_touch"], tables["application"], tables["loan"], span
        )
        return [write("daily_campaign_kpi", frame)]

    def exposures():
        # Both marts roll up the same ledger, so it is written once.
        span = within("daily_portfolio_kpi", "vintage_kpi")
        path = f"{root}/staging/ledger-{version}"
        if signed.stored(entries, LEDGER) and not anew:
            always = signed.read(spark, root, entries, LEDGER)
            changes = LEDGER.totals(ledger_within(always, span))
        else:
            changes = exposure_ledger(
                tables["installment"], tables["loan"], tables["payment"], span
            )
        changes.write.mode("overwrite").parquet(path)
        ledger = spark.read.parquet(path)
        build = {"daily_portfolio_kpi": portfolio_from_changes, "vintage_kpi": vintage_from_changes}
        done = _in_parallel(
            [lambda n=n, f=f: write(n, f(ledger, span)) for n, f in build.items() if n in marts]
        )
        delete_folder(spark, path)
        return done

    tasks = []
    if "daily_credit_kpi" in marts:
        tasks.append(credit)
    if "daily_campaign_kpi" in marts:
        tasks.append(campaign)
    if "daily_portfolio_kpi" in marts or "vintage_kpi" in marts:
        tasks.append(exposures)
    counts = {}
    for done in _in_parallel(tasks):
        for name, rows, parts in done:
            counts[name] = rows
            entries = versions.replaced(entries, f"mart/{name}", parts, dates[name])
    return counts, entries


def refresh_marts(
    tables: dict[str, DataFrame],
    root: str,
    span: ReportSpan,
    marts=tuple(MARTS),
    anew: bool = False,
) -> dict[str, int]:
    """Recompute the marts of every date in the span and publish them by one switch."""
    spark = tables["loan"].sparkSession
    current = versions.current(spark, root)
    counts, entries = stage_marts(tables, root, current, span, marts, anew=anew)
    versions.publish(spark, root, entries)
    return counts


def refresh_changed(
    spark: SparkSession,
    root: str,
    batch: dict[str, DataFrame],
    span: ReportSpan,
    marts=tuple(MARTS),
) -> dict[str, list[date]]:
    """Load a batch and refresh the dates of the span that it can alter; returns them by mart.

    Dates that no mart has been built for since the last load are refreshed too. Events and
    marts change by one switch; a batch that is already stored changes nothing.
    """
    _sweep(spark, root)
    old = versions.current(spark, root)
    found: dict[str, list[date]] = {}

    def seen(changed, after):
        found.update(affected_dates(changed, canonical_tables(spark, root, after), span))

    added, entries = stage_events(spark, root, old, batch, seen)
    tables = canonical_tables(spark, root, entries, span)
    only = {}
    for name in marts:
        start, _, end = old.get((f"{BUILT}{name}", "span"), "").partition("..")
        unbuilt = {d for d in span.dates if not start or not start <= d.isoformat() <= end}
        only[name] = sorted(unbuilt | set(found.get(name, [])))
    if added or any(only.values()):
        _, entries = stage_marts(tables, root, entries, span, marts, only)
        versions.publish(spark, root, entries)
    return only


def _log_run(spark, root, report_date, status, loaded=0, rejected=0, error=None, restart=False):
    """Upsert the run's row. A restart resets it, any other status keeps its start."""
    now = datetime.now(UTC)
    finished = None if restart else now
    row = (
        report_date, status, f"batch:{report_date.isoformat()}", now, finished,
        loaded, rejected, error,
    )
    path = f"{root}/audit/pipeline_runs"
    stored = read_table(spark, path, RUN_LOG).filter(F.col("run_date") == F.lit(report_date))
    merged = keyed_upsert(
        stored,
        spark.createDataFrame([row], RUN_LOG),
        ["run_date"],
        keep_current=() if restart else ("started_at",),
    )
    # At most one row; taken out so the partition is not read while it is replaced.
    log_row = spark.createDataFrame(merged.collect(), RUN_LOG)
    overwrite_partitions(log_row, path, "run_date", [report_date])


def _record_checks(spark, root, report_date, checks: DataFrame) -> DataFrame:
    """Append the check results, upsert the day's summary; returns the stored results."""
    checked_at = datetime.now(UTC)
    results = checks.select(
        F.lit(report_date).alias("run_date"), "*", F.lit(checked_at).alias("checked_at")
    )
    path = f"{root}/audit/quality_results"
    append(conform(results, AUDIT["quality_results"]), path)
    stored = (
        read_table(spark, path, AUDIT["quality_results"])
        .filter(
            (F.col("run_date") == F.lit(report_date)) & (F.col("checked_at") == F.lit(checked_at))
        )
        .drop("run_date", "checked_at")
    )
    # A run always yields all checks, so replacing the date's partition is the upsert.
    overwrite_partitions(
        conform(dq_summary(stored, report_date), DQ_SUMMARY),
        f"{root}/mart/dq_summary",
        "report_date",
        [report_date],
    )
    return stored



def run(
    spark: SparkSession,
    root: str,
    batch: dict[str, DataFrame],
    report_date: date,
    lookback: int = 45,
) -> dict:
    """Load a day's batch, check it and refresh the look-back window of all marts.

    After an earlier success only the marts are refreshed. A failed hard check keeps
    the loaded events and the check rows and leaves the marts as they are. Events and marts
    become current together at the end, so an error leaves neither; rejects are kept by run
    date, so a repeated run doesn't store them twice.
    """
    previous = (
        read_table(spark, f"{root}/audit/pipeline_runs", RUN_LOG)
        .filter(F.col("run_date") == F.lit(report_date))
        .first()
    )
    span = report_span(report_date, lookback)
    if previous and previous.status == "success":
        refresh_marts(canonical_tables(spark, root, span=span), root, span)
        return {
            "status": "success",
            "loaded": previous.rows_loaded,
            "rejected": previous.rows_rejected,
            "idempotent_replay": True,
        }
    _log_run(spark, root, report_date, "running", restart=True)
    rejected = 0
    try:
        _sweep(spark, root)
        batch, rejects = dict(batch), None
        if "application" in batch:
            batch["application"], rejects = quarantine(
                batch["application"], negative_request_rule(), report_date
            )
        loaded, entries = stage_events(spark, root, versions.current(spark, root), batch)
        if rejects is not None:
            stamped = rejects.withColumn("rejected_at", F.lit(datetime.now(UTC)))
            rejected = overwrite_partitions(
                conform(stamped, REJECTED_EVENTS),
                f"{root}/audit/rejected_events",
                "run_date",
                [report_date],
            )
        tables = canonical_tables(spark, root, entries, span)
        # reference checks read applications whole, the volume check only the months it needs
        whole = canonical_tables(spark, root, entries)
        whole["recent_application"] = tables["application"]
        results = all_checks(whole, report_date, check_values(entries))
        checks = _record_checks(spark, root, report_date, results)
        verdict = gate(checks).first()
        if verdict.status == "success":
            _, entries = stage_marts(tables, root, entries, span)
        versions.publish(spark, root, entries)
        _log_run(
            spark, root, report_date, verdict.status, loaded, rejected, verdict.error_message
        )
        return {"status": verdict.status, "loaded": loaded, "rejected": rejected}
    except Exception as exc:
        message = f"{type(exc).__name__}: {exc}"
        _log_run(spark, root, report_date, "failed", 0, rejected, message)
        raise RunFailure(message) from exc


def backfill(
    spark: SparkSession,
    root: str,
    batch_of: Callable[[date], dict[str, DataFrame]],
    start: date,
    end: date,
) -> list[dict]:
    """Run every day of a range in order, then rebuild all marts of the range in one pass.

    Each day is loaded, checked, gated and logged with its own mart date only. The first
    day that isn't a success stops the backfill with an error; days before it stay.
    """
    results = []
    for day in ReportSpan(start, end).dates:
        result = run(spark, root, batch_of(day), day, lookback=0)
        if result["status"] != "success":
            raise RunFailure(f"backfill stopped on {day}: {result}")
        results.append(result)
    rebuild(spark, root, start, end)
    return results


def rebuild(spark: SparkSession, root: str, start: date, end: date) -> dict[str, int]:
    """Rebuild all marts for every date of a range from the events, in one pass."""
    span = ReportSpan(start, end)
    return refresh_marts(canonical_tables(spark, root, span=span), root, span, anew=True)


def validate(spark: SparkSession, root: str, report_date: date) -> DataFrame:
    """The six checks over the stored events; nothing is written."""
    return all_checks(canonical_tables(spark, root), report_date)


def export(spark: SparkSession, root: str, report_date: date, target: str) -> dict[str, int]:
    """Write the four marts of a date as CSV; returns rows per mart."""
    span = single(report_date)
    return {
        name: export_csv(
            mart_table(spark, root, name).filter(F.col("report_date") == span.last),
            f"{target}/{name}_{report_date.isoformat()}",
            order,
        )
        for name, order in EXPORT_ORDER.items()
    }
