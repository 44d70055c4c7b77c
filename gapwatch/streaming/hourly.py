"""The sequence summary of each hour of arrivals, kept up to date as events come in."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwatch.operators.registry import attach_registry
from gapwatch.operators.summary import SUMMARY_COLUMNS, sequence_facts
from gapwatch.sources import feed


def stream_feed(spark: SparkSession, data_dir: str) -> DataFrame:
    """Received events of every feed file that appears below ``data_dir``."""

    def arriving(name: str) -> DataFrame:
        reader = spark.readStream.schema(feed.schema_of(name)).option("mode", "FAILFAST")
        return reader.option("pathGlobFilter", f"{name}*.json*").json(data_dir)

    return feed.union_events({name: feed.canonical_events(arriving(name), name) for name in feed.EVENT_TYPES})


def hourly_summary(
    events: DataFrame, registry: DataFrame, lateness: str = "10 minutes", width: str = "1 hour"
) -> DataFrame:
    """``window_start`` plus the summary columns, for each window of arrivals.

    The same two aggregations as in batch, so state is a row per block of 64
    serials and a row per sequence and window, and a huge sequence's state is
    spread by its blocks. A window is emitted, once, when the watermark
    (``lateness`` behind the latest arrival) passes its end; events later than
    that are not counted and would show up as loss. The registry is a table
    read anew for every batch of the stream. Batch frames work as well.
    """
    windowed = events.withWatermark("arrival", lateness).withColumn("window", F.window("arrival", width))
    described = attach_registry(sequence_facts(windowed, per=("window",)), registry)
    return described.withColumn(
        "started_before_window", F.col("implied_start") < F.col("window.start")
    ).select(F.col("window.start").alias("window_start"), *SUMMARY_COLUMNS)
