"""Tables whose columns change over time, upgraded when they are read.

The folder of a stored part names the layout it was written in. A table's steps lead from each
layout to the next; parts in older layouts go through the steps they lack, as
projections over the scan, so nothing has to be rewritten before it can be read. Parts without a
mark are in layout 0.
"""

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import versions


@dataclass(frozen=True)
class Step:
    """Columns that a step sets, as "name type" with SQL over the older columns, and those it drops."""

    sets: dict[str, str] = field(default_factory=dict)
    drops: tuple[str, ...] = ()


@dataclass(frozen=True)
class Layouts:
    """The columns of layout 0 and the steps after it, in order."""

    first: T.StructType
    steps: tuple[Step, ...]

    def schema(self, layout: int | None = None) -> T.StructType:
        """Columns of a layout, the newest if none is named; set columns keep their place or come last."""
        fields = {f.name: f for f in self.first}
        for step in self.steps[:layout]:
            added = T.StructType.fromDDL(", ".join(step.sets)) if step.sets else []
            for column in added:
                fields[column.name] = column
            for name in step.drops:
                del fields[name]
        return T.StructType(list(fields.values()))

    def upgrade(self, rows: DataFrame, layout: int) -> DataFrame:
        """Rows of a layout with the columns of the newest."""
        for number, step in enumerate(self.steps[layout:], start=layout + 1):
            named = {named.split()[0]: rule for named, rule in step.sets.items()}
            types = {f.name: f.dataType for f in self.schema(number)}
            # every rule sees the columns as they were before the step
            rows = rows.withColumns({n: F.expr(rule).cast(types[n]) for n, rule in named.items()})
            rows = rows.drop(*step.drops)
        return rows.select(*self.schema().names)

    def mark(self, version: str) -> str:
        """A version id that tells that its parts are in the newest layout."""
        return f"{version}.l{len(self.steps)}"


def layout_of(path: str) -> int:
    found = re.search(r"version=[^/]*\.l(\d+)(/|$)", path)
    return int(found[1]) if found else 0


def read(
    spark: SparkSession, root: str, entries: versions.Entries, table: str, layouts: Layouts
) -> DataFrame:
    """The current parts of a table in its newest layout, whatever they were written in."""
    by_layout: dict[int, versions.Entries] = {}
    for (name, part), path in entries.items():
        if name == table:
            by_layout.setdefault(layout_of(path), {})[name, part] = path
    newest = len(layouts.steps)
    if later := [n for n in by_layout if n > newest]:
        raise ValueError(f"{table} holds parts in layout {max(later)}, known are {newest}")
    read_in = {n: versions.read(spark, root, p, table, layouts.schema(n)) for n, p in by_layout.items()}
    rows = [layouts.upgrade(frame, n) for n, frame in sorted(read_in.items())]
    if not rows:
        return spark.createDataFrame([], layouts.schema())
    every = rows[0]
    for one in rows[1:]:
        every = every.unionByName(one)
    return every


def rewritten(
    spark: SparkSession,
    root: str,
    entries: versions.Entries,
    table: str,
    layouts: Layouts,
    version: str,
    part: str,
) -> versions.Entries:
    """Entries in which every part is in the newest layout; parts that are already aren't touched.

    ``part`` is a column that no step sets, and whose values name the parts.
    """
    old = {
        (name, p): path
        for (name, p), path in entries.items()
        if name == table and layout_of(path) < len(layouts.steps)
    }
    if not old:
        return entries
    rows = read(spark, root, old, table, layouts)
    _, parts = versions.stage(rows, root, table, layouts.mark(version), part)
    return versions.replaced(entries, table, parts, [p for _, p in old])
