"""Incremental history refresh with Structured Streaming.

The reference refreshes on a schedule (full reload every few hours) and keeps the
price history as a timestamp-strategy snapshot. Here each new raw price file that
lands in a folder is one micro-batch; ``foreachBatch`` adds what it changes to the
history (SCD1) as one segment (sources.segments). With
``trigger(availableNow=True)`` the same query is the scheduled batch job: it
processes whatever arrived since the last run and stops.

Exactly-once: the stream's checkpoint (in the shared checkpoint folder) records which
files were consumed. Each segment names the stream and batch that wrote it; a replayed batch
(driver lost between the write and the checkpoint commit) finds its name in the manifest and is
skipped. Any other batch adds to the history, whatever its id: a stream with a new
checkpoint, whose ids start at 0 again, or a gap in the ids lose nothing. The manifest, a row for each
batch, is all that is read of the history besides the open versions of the batch's buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stationlens.functions.labels import surrogate_key
from stationlens.operators.history import timestamp_changes
from stationlens.plans.fuel import clean_prices
from stationlens.session import checkpoint_dir
from stationlens.sources.raw import RAW_PRICES
from stationlens.sources.segments import run_changes

KEY = "prix_snapshot_key"


def snapshot_rows(raw_prices: DataFrame) -> DataFrame:
    """Staged, valid price rows keyed by (entity, product) -- the snapshot source."""
    p = clean_prices(raw_prices).filter(~F.col("is_prix_invalide"))
    return p.select(surrogate_key("station_id", "carburant_nom").alias(KEY), "station_id", "carburant_nom",
                    "carburant_id", "prix_euros", "date_maj", "date_prix", "is_prix_invalide",
                    "is_prix_suspect", F.col("_loaded_at").alias("source_loaded_at"))


def merge_batch(history_base: str, stream_id: str | None = None):
    """foreachBatch function: add one batch's changes to the history.
    ``stream_id`` defaults to the running query's id, which its checkpoint keeps."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = stream_id or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        rows = snapshot_rows(batch)
        run_changes(spark, history_base, [KEY], rows, lambda known: timestamp_changes(
            known, rows, [KEY], "date_maj", ["prix_euros", "carburant_id"]), f"{stream}:{batch_id}")

    return run


def start_price_history_stream(spark: SparkSession, landing: str, history_base: str,
                               checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Watch ``landing`` for raw price Parquet files; maintain the history."""
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/price_history_stream"
    stream = spark.readStream.schema(RAW_PRICES).parquet(landing)
    writer = stream.writeStream.foreachBatch(merge_batch(history_base)).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="6 hours")
    return writer.start()
