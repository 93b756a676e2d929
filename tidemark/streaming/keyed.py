"""Stream ingest that keeps the ids it has seen as keyed state.

The state store holds one entry for each event id and nothing else of the row. There is
no watermark, so no id is ever forgotten and no event is too late; a micro-batch reads and writes
the entries of its own ids, not the stored events. Set
``spark.sql.streaming.stateStore.providerClass`` to Spark's RocksDB provider
(:data:`ROCKS`) where the ids outgrow executor memory.
"""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.streaming.ingest import event_stream

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_RANK = "_arrival_rank"
# Rows that a task holds beside the first copies it has found so far.
HELD = 100_000


def _first_copies(id_col: str, order: list[str]):
    """A function over record batches that keeps the first row of each id among them."""

    def first(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in [id_col, *order]])
        ids = table[id_col].combine_chunks()
        if len(ids) < 2:
            return table
        # a null id differs from its neighbour: every row without an id stays
        new = pc.fill_null(pc.not_equal(ids[1:], ids[:-1]), True)
        keep = pa.concat_arrays([pa.array([True]), new])
        return table.filter(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, waiting, n = None, [], 0
        for batch in batches:
            waiting.append(batch)
            n += batch.num_rows
            if n >= HELD:
                rows = pa.Table.from_batches(waiting)
                kept = first(rows if kept is None else pa.concat_tables([kept, rows]))
                waiting, n = [], 0
        if waiting:
            rows = pa.Table.from_batches(waiting)
            kept = first(rows if kept is None else pa.concat_tables([kept, rows]))
        if kept is not None:
            yield from kept.to_batches()

    return run


def unseen(
    stream: DataFrame, id_col: str = "source_event_id", arrival: tuple[str, ...] = ("ingested_at",)
) -> DataFrame:
    """Rows of a stream whose id no earlier micro-batch had; one for each id.

    Within a micro-batch the earliest copy wins, ties by a hash of the row. Copies are
    dropped in the tasks that read them before the ids are exchanged, so an id with very many
    copies doesn't fill one task. Ids must not be null, as :func:`write_unseen` ensures.
    """
    ranked = stream.withColumn(_RANK, F.xxhash64(*stream.columns))
    first = _first_copies(id_col, [*arrival, _RANK])
    read = ranked.mapInArrow(first, ranked.schema)
    met = read.repartition(F.col(id_col)).mapInArrow(first, ranked.schema)
    return met.dropDuplicates([id_col]).select(*stream.columns)


def stream_unseen(
    spark: SparkSession,
    landing: str,
    schema,
    sink: str,
    checkpoint: str,
    max_files: int = 1000,
    id_col: str = "source_event_id",
    arrival: tuple[str, ...] = ("ingested_at",),
) -> None:
    """Bring everything that has landed into ``sink``, each event id once.

    The sink belongs to this stream: Spark's file sink lists the files of each finished
    micro-batch in it, so one that runs again adds nothing and readers never see half of it. Ids
    stored elsewhere aren't known; land those files here too. An event without an id stops the
    stream with an error.
    """
    write_unseen(event_stream(spark, landing, schema, max_files), sink, checkpoint, id_col, arrival)


def write_unseen(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    id_col: str = "source_event_id",
    arrival: tuple[str, ...] = ("ingested_at",),
) -> None:
    """The unseen rows of any stream into a sink of its own; see :func:`stream_unseen`."""
    told = F.lit(f"an event has no {id_col}")
    named = stream.withColumn(id_col, F.coalesce(F.col(id_col), F.raise_error(told)))
    query = (
        unseen(named.select(*stream.columns), id_col, arrival)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
