"""Parts written in older layouts are read in the newest."""

from datetime import date

import pytest
from conftest import rows
from pyspark.sql import types as T

from tidemark.plans import jobs
from tidemark.schemas import MARTS
from tidemark.sources import layouts, versions

DAY = date(2026, 3, 1)
STEPS = layouts.Layouts(
    T.StructType().add("d", T.DateType()).add("cents", T.IntegerType()).add("name", T.StringType()),
    (
        # both rules see the columns before the step
        layouts.Step({"amount decimal(18,2)": "cents / 100", "cents bigint": "cents * 10"}),
        layouts.Step({"label string": "upper(name)", "big boolean": "cents > 100"}, drops=("name", "cents")),
    ),
)


def test_two_steps_over_mixed_parts(spark, tmp_path):
    root, entries = str(tmp_path), {}
    stored = {
        "a": "SELECT DATE'2026-03-01' AS d, 250 AS cents, 'x' AS name",
        "b.l1": "SELECT DATE'2026-03-02' AS d, 9L AS cents, 'y' AS name, 0.5BD AS amount",
        "c.l2": "SELECT DATE'2026-03-03' AS d, 7.00BD AS amount, 'z' AS label, true AS big",
    }
    for version, sql in stored.items():
        _, parts = versions.stage(spark.sql(sql), root, "t", version, "d")
        entries |= {("t", p): path for p, path in parts.items()}
    assert [layouts.layout_of(p) for _, p in sorted(entries.items())] == [0, 1, 2]
    table = layouts.read(spark, root, entries, "t", STEPS)
    assert table.columns == STEPS.schema().names == ["d", "amount", "label", "big"]
    expected = [
        (date(2026, 3, 1), "2.50", "X", True),
        (date(2026, 3, 2), "0.50", "Y", False),
        (date(2026, 3, 3), "7.00", "z", True),
    ]
    told = "d", "CAST(amount AS STRING)", "label", "big"
    assert rows(table.selectExpr(*told)) == expected
    assert rows(table.filter("d = DATE'2026-03-02'").selectExpr(*told)) == expected[1:2]
    after = layouts.rewritten(spark, root, entries, "t", STEPS, "n", "d")
    assert {layouts.layout_of(p) for p in after.values()} == {2} and after.keys() == entries.keys()
    assert after["t", "2026-03-03"] == entries["t", "2026-03-03"]
    assert rows(layouts.read(spark, root, after, "t", STEPS).selectExpr(*told)) == expected
    assert layouts.rewritten(spark, root, after, "t", STEPS, "m", "d") == after


def test_empty_tables_and_unknown_layouts(spark, tmp_path):
    assert layouts.read(spark, str(tmp_path), {}, "t", STEPS).schema == STEPS.schema()
    with pytest.raises(ValueError, match="layout 9"):
        layouts.read(spark, str(tmp_path), {("t", "p"): "t/version=a.l9/d=p"}, "t", STEPS)


def test_a_mart_from_before_the_touch_date(spark, tmp_path):
    root, table = str(tmp_path), "mart/daily_campaign_kpi"
    row = (DAY, date(2026, 2, 20), "A", "sms", 1, 0, 0, 0, 0, None)
    mart = spark.createDataFrame([row], T.StructType([T.StructField(f.name, f.dataType) for f in MARTS["daily_campaign_kpi"]]))
    _, parts = versions.stage(mart.drop("touch_date"), root, table, "old", "report_date")
    versions.publish(spark, root, {(table, p): path for p, path in parts.items()})
    before = rows(jobs.mart_table(spark, root, "daily_campaign_kpi"))
    assert before[0][:2] == (DAY, DAY)
    assert jobs.migrate(spark, root) == 1
    assert rows(jobs.mart_table(spark, root, "daily_campaign_kpi")) == before
    assert jobs.migrate(spark, root) == 0
