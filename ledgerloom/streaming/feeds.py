"""Incremental form of the half-hourly publish-log job.

The job is stateless per row, so a file stream that is drained and stopped
replaces the full recompute: each run reads only files that arrived since.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.plans.catalogue import publish_events

PUBLISH_LOG_SCHEMA = """
    event_dtime timestamp_ntz, merchant_id string,
    enabled_products string, disabled_products string
"""


def publish_event_stream(spark: SparkSession, path: str) -> DataFrame:
    """Publish log files arriving under ``path`` to one row per product."""
    return publish_events(spark.readStream.schema(PUBLISH_LOG_SCHEMA).parquet(path))


def append_available(
    events: DataFrame, target: str, checkpoint: str
) -> StreamingQuery:
    """Append everything that has arrived to ``target`` and stop.

    ``checkpoint`` remembers which files were read: a folder that executors share,
    the same in every run and another for every pair of source and target.
    """
    return (
        events.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
