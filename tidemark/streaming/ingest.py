"""Streaming ingest of event files and mart refresh per micro-batch."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.span import ReportSpan
from tidemark.operators.ingest import idempotent_append
from tidemark.plans.jobs import refresh_changed
from tidemark.schemas import MARTS
from tidemark.sources.storage import append, read_table


def event_stream(
    spark: SparkSession, landing: str, schema, max_files: int = 1000, **options
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .options(**options)
        .parquet(landing)
    )


def append_unseen(
    sink: str, schema, id_col: str = "source_event_id", time_col: str = "ingested_at"
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: append the rows whose id the sink doesn't hold yet.

    No event is too old. The earliest copy within a micro-batch wins; a replayed
    micro-batch finds its ids stored and adds nothing.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        stored = read_table(batch.sparkSession, sink, schema)
        append(idempotent_append(stored, batch, id_col, (time_col,)), sink)

    return handle


def stream_ingest(
    spark: SparkSession, landing: str, schema, sink: str, checkpoint: str, max_files: int = 1000
) -> None:
    """Bring everything that has landed into the sink, each event id once."""
    stream = event_stream(spark, landing, schema, max_files)
    run_available(stream, append_unseen(sink, schema), checkpoint)


def refresh_batch(
    root: str, table: str, span: ReportSpan, marts: tuple[str, ...] = tuple(MARTS)
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: load the batch as a job does, then refresh what it alters.

    Events go through the load of :mod:`tidemark.plans.jobs`, so the stored newest
    versions hold them and later runs go on from there. Only report dates that a changed row
    can reach are computed and written; the first micro-batch builds the whole span. A
    replayed micro-batch adds and writes nothing.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        refresh_changed(batch.sparkSession, root, {table: batch}, span, marts)

    return handle


def run_available(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> None:
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
