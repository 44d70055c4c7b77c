"""A stored summary that micro-batches are merged into: nothing is dropped, and a batch may be replayed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import LongType, StringType

from gapwatch.monitoring.windows import interval, merge_windows, window_blocks
from gapwatch.operators.summary import facts_from_blocks, summary_of, typed_blocks
from gapwatch.operators.validate import problem_of

#: One row per merged batch; written last, so a batch without it does not count.
COUNTS = ("received", "kept", "late", "rejected")
_COUNTS_SCHEMA = "received bigint, kept bigint, late bigint, rejected bigint, latest timestamp, batch bigint"


def merged_blocks(blocks: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """Typed blocks of several lots of events as those of all events together."""
    return blocks.groupBy(*per, "sequence_id", "block", "event_type").agg(
        F.sum("rows").alias("rows"),
        F.bit_or("bits").alias("bits"),
        F.min("first_copy").alias("first_copy"),
        F.min("last_copy").alias("last_copy"),
        F.min("started").alias("started"),
        F.min("first_arrival").alias("first_arrival"),
    )


class BlockStore:
    """A folder of typed blocks, one lot per batch, with late and rejected rows and the counts of each batch.

    * ``blocks`` the folded events of a batch, or of all batches up to one after ``compact``,
    * ``windows`` the same per window of arrivals, for ``boundary_completeness``,
    * ``late`` rows that came more than ``lateness`` behind the latest arrival of earlier batches;
      they are in the blocks as well, so a late serial is never taken for a loss,
    * ``rejected`` rows that lack a required field, with the reason; they are in no block,
    * ``counts`` per batch: received = kept + rejected, late is part of kept.

    Each lot is overwritten as a whole when its batch is merged again, with the
    rows it had before: whether a row is late depends on earlier batches alone.
    """

    def __init__(self, spark: SparkSession, folder: str, events_schema, lateness: str = "10 minutes", width: str = "1 hour"):
        self._spark, self._folder, self._lateness, self._width = spark, folder.rstrip("/"), lateness, width
        self._schema = {
            "counts": spark.createDataFrame([], _COUNTS_SCHEMA).schema,
            "blocks": typed_blocks(spark.createDataFrame([], events_schema)).schema.add("batch", LongType()),
            "windows": window_blocks(spark.createDataFrame([], events_schema), width).schema.add("batch", LongType()),
            "late": spark.createDataFrame([], events_schema).schema.add("batch", LongType()),
            "rejected": spark.createDataFrame([], events_schema).schema.add("reason", StringType()).add("batch", LongType()),
            "generations": spark.createDataFrame([], "upto bigint, batch bigint").schema,
        }
        # Each folder exists with a lot that holds nothing, so reading never meets a missing path.
        for name in self._schema:
            self._write(name, -1, spark.createDataFrame([], self._schema[name]).drop("batch"))

    def _write(self, name: str, batch: int, lot: DataFrame) -> None:
        lot.write.mode("overwrite").parquet(f"{self._folder}/{name}/batch={batch}")

    def _read(self, name: str) -> DataFrame:
        """All lots of one kind."""
        return self._spark.read.schema(self._schema[name]).option("basePath", f"{self._folder}/{name}").parquet(f"{self._folder}/{name}")

    def merge(self, events: DataFrame, batch: int) -> None:
        """Merges one batch; the function for ``foreachBatch``."""
        before = self._read("counts").filter(F.col("batch") < batch).agg(F.max("latest").alias("latest")).first()["latest"]
        is_late = F.lit(False) if before is None else F.col("arrival") < F.lit(before) - interval(self._lateness)
        checked = events.withColumn("reason", problem_of()).withColumn("is_late", F.coalesce(is_late, F.lit(False))).persist()
        try:
            kept = checked.filter("reason IS NULL")
            self._write("blocks", batch, typed_blocks(kept))
            self._write("windows", batch, window_blocks(kept, self._width))
            self._write("late", batch, kept.filter("is_late").drop("reason", "is_late"))
            self._write("rejected", batch, checked.filter("reason IS NOT NULL").drop("is_late"))
            valid = F.col("reason").isNull()
            self._write("counts", batch, checked.agg(
                F.count(F.lit(1)).alias("received"), F.count_if(valid).alias("kept"),
                F.count_if(valid & F.col("is_late")).alias("late"), F.count_if(~valid).alias("rejected"),
                F.max(F.when(valid, F.col("arrival"))).alias("latest")))
        finally:
            checked.unpersist()

    def _counted(self, name: str) -> DataFrame:
        """Lots of the batches whose counts were written."""
        done = self._read("counts").select("batch")
        return self._read(name).join(done, "batch", "left_semi")

    def counts(self) -> DataFrame:
        return self._read("counts").filter("batch >= 0").select("batch", *COUNTS, "latest")

    def late(self) -> DataFrame:
        return self._counted("late")

    def rejected(self) -> DataFrame:
        return self._counted("rejected")

    def blocks(self) -> DataFrame:
        """The typed blocks of all events merged so far."""
        upto, lots = self._generation(), self._counted("blocks").drop("batch")
        if upto is not None:
            lots = self._counted("blocks").filter(F.col("batch") > upto).drop("batch").unionByName(
                self._spark.read.parquet(f"{self._folder}/compacted/upto={upto}"))
        return merged_blocks(lots)

    def windows(self) -> DataFrame:
        """``window_blocks`` of all events merged so far, late ones in the window they arrived in."""
        return merge_windows(self._counted("windows"), self._width)

    def _generation(self) -> int | None:
        return self._read("generations").agg(F.max("upto")).first()[0]

    def compact(self) -> None:
        """Stores the merged blocks once, so reading no longer merges the lots of the batches so far.

        The generation is announced after its blocks are complete; lots stay where they are.
        """
        upto = self.counts().agg(F.max("batch")).first()[0]
        if upto is None or upto == self._generation():
            return
        self.blocks().write.mode("overwrite").parquet(f"{self._folder}/compacted/upto={upto}")
        self._write("generations", upto, self._spark.createDataFrame([(upto,)], "upto bigint"))

    def summary(self, registry: DataFrame, window_start: Column | None = None) -> DataFrame:
        """``sequence_summary`` of all events merged so far."""
        return summary_of(facts_from_blocks(self.blocks()), registry, window_start=window_start)


def merge_stream(events: DataFrame, store: BlockStore, checkpoint: str) -> DataStreamWriter:
    """A writer that merges each micro-batch of ``events`` into ``store``; start it with any trigger."""
    return events.writeStream.foreachBatch(store.merge).option("checkpointLocation", checkpoint)
