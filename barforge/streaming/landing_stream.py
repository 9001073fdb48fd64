"""Bronze ingest from a landing folder as a file stream.

The same load as the batch extractor's upsert (S8), driven by Structured
Streaming instead of a scheduler: the file source's own commit log is the
high-water mark (only files not yet processed are read), each micro-batch
is normalised and MERGEd into bronze on (symbol, date). The upsert is
idempotent, so a micro-batch replayed after a failure leaves the same
table. ``availableNow`` processes everything present, then stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from barforge.plans.changes import record_changes
from barforge.schemas import LANDING
from barforge.sources import storage
from barforge.sources.landing import normalize_landing, to_bronze


def start_landing_stream(spark: SparkSession, landing_dir: str, bronze_path: str,
                         checkpoint_location: str | None = None, *, exchange_tz: str,
                         available_now: bool = True,
                         max_files_per_trigger: int | None = None,
                         changes_path: str | None = None) -> StreamingQuery:
    """Start the stream; call ``.awaitTermination()`` on the result to wait
    (``available_now=True`` stops once the folder is drained). With
    ``changes_path``, each micro-batch first records its changed symbols for
    the incremental silver refresh."""
    # Beside the table by default: the same for every application.
    ckpt = checkpoint_location or f"{bronze_path.rstrip('/')}__stream"
    reader = spark.readStream.schema(LANDING)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(landing_dir)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        rows = to_bronze(normalize_landing(batch, exchange_tz))
        change = storage.plan_upsert(batch.sparkSession, rows, bronze_path,
                                     keys=("symbol", "date"), partitions=storage.month_partition())
        session = batch.sparkSession
        storage.apply_upsert(session, change, before_publish=(
            lambda c: record_changes(session, changes_path, c.rows, f"batch-{batch_id}")) if changes_path else None)

    w = stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
