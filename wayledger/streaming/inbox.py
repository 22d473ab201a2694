"""Continuous processing with Structured Streaming.

Both entry points use ``foreachBatch`` on the same operators as batch jobs. The stream's checkpoint
is kept beside the tables it fills, so a restarted stream goes on where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wayledger.config import Settings
from wayledger.operators.late_events import LateAggregates, LatePolicy
from wayledger.plans.pipeline import run_pipeline


def stream_late_aggregates(events: DataFrame, path: str, policy: LatePolicy | None = None, checkpoint: str | None = None, **trigger) -> StreamingQuery:
    """Keep per-hour aggregates corrected from a stream of telemetry rows.

    A micro-batch that is tried again after a failure counts no row twice: its rows are
    copies of those kept.
    """
    spark = events.sparkSession
    agg = LateAggregates(spark, path, policy)
    return (
        events.writeStream.foreachBatch(lambda batch, _: agg.apply(batch))
        .option("checkpointLocation", checkpoint or f"{path}/_stream")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_inbox(spark: SparkSession, settings: Settings, checkpoint: str | None = None, **trigger) -> StreamingQuery:
    """Run the pipeline whenever files come into the inbox.

    The stream only tells that files came; which of them are new, valid or repeated the pipeline
    decides by content, so a file told twice is loaded once.
    """
    names = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.[cC][sS][vV]").load(f"{settings.root}/raw/inbox").select("path")
    return (
        names.writeStream.foreachBatch(lambda batch, _: None if batch.isEmpty() else run_pipeline(spark, settings) and None)
        .option("checkpointLocation", checkpoint or f"{settings.layer('control')}/_inbox_stream")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
