"""Queries build the tables that they read, and no others."""

from datetime import datetime

import pytest

from tidemark.registry.queries import QUERIES
from tidemark.sources import driver_tables, storage


@pytest.fixture
def tables(spark, tmp_path):
    """A folder of small tables, one order with many lines, and the names of what is stored for it."""
    day = datetime(1998, 5, 1)
    customers = [(i, 100.0 * i) for i in range(20)]
    orders = [(i, i % 20, "FOP"[i % 3], 1000.0 + i, day) for i in range(60)]
    lines = [(i % 60, i, i % 7, 1 + i // 60, 50.0 + i, "NAR"[i % 3], day) for i in range(180)]
    lines += [(3, i % 11, i % 7, i, 10.0, "N", day.replace(day=1 + i % 9)) for i in range(90)]
    lines += [(3, 1, 1, 1, 10.0, "N", None), (None, 1, 1, 1, 10.0, "N", day), (6, 1, 1, 1, 1.0, None, day)]
    for name, rows, schema in (
        ("customer", customers, "c_custkey long, c_acctbal double"),
        ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"),
        ("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.fixture
def stored(monkeypatch):
    names = []

    def note(spark, scope, name, *args):
        names.append(name)
        return kept(spark, scope, name, *args)

    kept = storage.stored_once
    monkeypatch.setattr(storage, "stored_once", note)
    monkeypatch.setattr(driver_tables, "stored_once", note)
    return names


def test_rejects_need_applications_alone(spark, tables, stored):
    rejects = QUERIES["quarantine_rejects"](spark, tables).collect()
    assert {r["source_event_id"] for r in rejects} == {"application:0:v1"}
    assert not [n for n in stored if not n.endswith("_application")]


def test_marts_store_no_events_and_no_newest_versions(spark, tables, stored):
    assert QUERIES["rebuild_range"](spark, tables).count() > 0
    assert QUERIES["late_affected_dates"](spark, tables).count() > 0
    assert set(stored) == {"loan_rows", "installment_rows"}


def test_campaign_stores_what_its_reports_reach(spark, tables, stored):
    QUERIES["mart_campaign"](spark, tables).collect()
    assert not [n for n in stored if n.startswith(("raw_", "latest_"))]


def test_installments_are_numbered_alike_on_both_ways(spark, tables, monkeypatch):
    def rows():
        found = driver_tables._installment_rows(spark, tables)
        return sorted(map(tuple, found.collect()), key=str)

    usual = rows()
    monkeypatch.setattr(driver_tables, "LINE_BUCKETS", 8)
    monkeypatch.setattr(driver_tables, "LONG_ORDER", 0)
    assert rows() == usual  # order 3 has a third of all lines
    of_order = [r[2] for r in usual if r[1] == 31]
    # the line without a ship date counts as the first and is no installment
    assert sorted(of_order) == list(range(2, 95))
    assert len({r[0] for r in usual}) == len(usual)
