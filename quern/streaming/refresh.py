"""Daily refresh: what is new since the last run, as a batch or as a stream that ends when it has caught up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_rows(incoming: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key the index doesn't hold yet; repeated incoming keys come once."""
    return incoming.dropDuplicates([key]).join(known.select(key), key, "left_anti")


def catch_up(spark: SparkSession, folder: str, schema, checkpoint: str, handle: Callable[[DataFrame, int], None], files_at_once: int = 1000) -> None:
    """Hands files that came since the last call to ``handle``, and returns when none is left.

    The checkpoint remembers what was handled, so a run that is cut off is taken up again; ``handle`` sees a batch
    number by which it can write each batch once.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder)
    query = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def daily_counts(events: DataFrame, time: str, kind: str, late: str = "2 days") -> DataFrame:
    """Counts by day and kind; works on streams, where days older than ``late`` are final."""
    timed = events.withColumn("_at", F.col(time).cast("timestamp"))
    if timed.isStreaming:
        timed = timed.withWatermark("_at", late)
    days = timed.groupBy(F.window("_at", "1 day"), kind).agg(F.count(F.lit(1)).alias("n"))
    return days.select(F.col("window.start").cast("date").alias("day"), kind, "n")
