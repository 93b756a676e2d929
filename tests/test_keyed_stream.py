"""The stream with keyed state keeps each id once, however late and however often it comes."""

from datetime import UTC, date, datetime

import pyarrow as pa
import pytest
from conftest import rows

from tidemark.schemas import EVENTS
from tidemark.streaming import keyed

SCHEMA = EVENTS["payment"]


def paid(n, month, **more):
    return dict(
        payment_id=n, source_event_id=f"payment:{n}", payment_date=date(2026, month, 5),
        ingested_at=datetime(2026, month, 5, tzinfo=UTC), **more,
    )


@pytest.fixture
def landed(spark, make, tmp_path):
    def land(*batch):
        make("payment", *batch).write.mode("append").parquet(str(tmp_path / "landing"))
        keyed.stream_unseen(spark, str(tmp_path / "landing"), SCHEMA, str(tmp_path / "sink"), str(tmp_path / "check"))
        return spark.read.schema(SCHEMA).parquet(str(tmp_path / "sink"))

    return land


def test_a_late_event_is_kept_and_replays_add_nothing(landed):
    june = landed(paid(1, 6), paid(2, 6))
    assert june.count() == 2
    both = landed(paid(3, 1), paid(1, 6))
    assert rows(both, "payment_id", "payment_date") == [(1, date(2026, 6, 5)), (2, date(2026, 6, 5)), (3, date(2026, 1, 5))]
    again = landed(paid(1, 6), paid(2, 6), paid(3, 1))
    assert again.count() == 3
    # nothing new has landed
    assert landed(paid(2, 7)).count() == 3


def test_the_earliest_copy_of_a_micro_batch_wins(landed):
    copies = [paid(1, month, amount=month) for month in (6, 2, 9)] + [paid(2, 4)]
    assert rows(landed(*copies), "payment_id", "amount") == rows(landed(*copies[::-1]), "payment_id", "amount")
    kept = rows(landed(paid(1, 1)), "payment_id", "payment_date")
    assert kept == [(1, date(2026, 2, 5)), (2, date(2026, 4, 5))]


def test_a_changed_order_of_files_gives_the_same_rows(spark, make, tmp_path):
    found = []
    for name, order in (("a", (6, 2, 9)), ("b", (9, 6, 2))):
        for month in order:
            make("payment", paid(1, month, amount=month)).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        keyed.stream_unseen(spark, str(tmp_path / name), SCHEMA, str(tmp_path / f"{name}-sink"), str(tmp_path / f"{name}-check"))
        found.append(rows(spark.read.schema(SCHEMA).parquet(str(tmp_path / f"{name}-sink")), "payment_date", "amount"))
    assert found[0] == found[1] and len(found[0]) == 1


def test_an_event_without_an_id_is_refused(spark, make, tmp_path):
    rows_ = make("payment", paid(1, 1)).drop("source_event_id").selectExpr("*", "CAST(NULL AS STRING) AS source_event_id")
    rows_.write.parquet(str(tmp_path / "landing"))
    with pytest.raises(Exception, match="has no source_event_id"):
        keyed.stream_unseen(spark, str(tmp_path / "landing"), SCHEMA, str(tmp_path / "sink"), str(tmp_path / "check"))


def test_state_holds_ids_alone(spark, make, tmp_path):
    make("payment", paid(1, 1)).write.parquet(str(tmp_path / "landing"))
    stream = keyed.unseen(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "landing")))
    assert stream.isStreaming and stream.columns == SCHEMA.names


def test_first_copies_in_pieces(monkeypatch):
    monkeypatch.setattr(keyed, "HELD", 3)
    batches = [
        pa.RecordBatch.from_pydict({"k": ["a", "b", None], "t": [3, 1, 1]}),
        pa.RecordBatch.from_pydict({"k": ["a", "a", "c"], "t": [1, 2, 5]}),
        pa.RecordBatch.from_pydict({"k": ["c", "b"], "t": [4, None]}),
    ]
    kept = pa.Table.from_batches(list(keyed._first_copies("k", ["t"])(iter(batches)))).to_pylist()
    assert sorted((r["k"] or "", r["t"]) for r in kept) == [("", 1), ("a", 1), ("b", 1), ("c", 4)]
    assert list(keyed._first_copies("k", ["t"])(iter([]))) == []
