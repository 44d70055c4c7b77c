"""The hourly summary on a stream equals the batch summary of each hour."""

import bz2
import json
from datetime import timedelta

from conftest import DOWN, EVENTS, HOUR, PAGE, facts_of, rows_of
from pyspark.sql import functions as F

from gapwatch.operators.summary import sequence_summary
from gapwatch.streaming import hourly_summary, stream_feed


def _drain(frame, name, checkpoint):
    query = (
        frame.writeStream.outputMode("append").format("memory").queryName(name)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination(300)
    assert query.exception() is None
    return frame.sparkSession.table(name)


def test_stream_equals_batch_per_hour(spark, make_registry, tmp_path):
    rows = []
    for hour in range(2):
        for sequence in (1, 2):
            for serial in (0, 1, 1, 3, 70 + sequence):
                at = HOUR + timedelta(hours=hour, minutes=sequence, seconds=serial)
                rows.append((sequence, serial, serial * 100, at, PAGE if serial % 2 else DOWN))
    rows.append((3, 5, 400_000, HOUR + timedelta(seconds=30), PAGE))
    # Far later: moves the watermark past both hours.
    rows.append((9, 0, 0, HOUR + timedelta(hours=9), PAGE))
    events = spark.createDataFrame(rows, EVENTS)
    events.repartition(2).write.parquet(str(tmp_path / "in"))
    registry = make_registry([(1, "phone"), (2, "desktop")])

    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    # Files may come in any order, so none of this counts as late.
    found = _drain(hourly_summary(stream, registry, lateness="20 hours"), "early", str(tmp_path / "c1"))
    assert found.count() == 0  # no window is closed yet

    whole = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    found = _drain(hourly_summary(whole, registry), "hourly", str(tmp_path / "c2"))
    for hour in range(2):
        start = HOUR + timedelta(hours=hour)
        inside = events.filter((F.col("arrival") >= F.lit(start)) & (F.col("arrival") < F.lit(start + timedelta(hours=1))))
        expected = sequence_summary(inside, registry)
        got = found.filter(F.col("window_start") == F.lit(start)).drop("window_start")
        assert sorted(map(repr, rows_of(got))) == sorted(map(repr, rows_of(expected)))
    assert found.filter("sequence_id = 3").first()["started_before_window"] is True
    assert found.filter("sequence_id = 9").count() == 0  # its window is still open


def test_feed_files_are_picked_up(spark, make_registry, write_feed, feed_rows, tmp_path):
    directory = write_feed(feed_rows)
    with bz2.open(f"{directory}/mouse-down-later.json.bz2", "wt") as file:
        file.write(json.dumps({"eventTime": "2031-09-07T09:00:00Z", "navigation": 8, "serialId": 0, "relativeTimeMs": 1}))
    registry = make_registry([(n, "phone") for n in range(100, 105)])
    found = _drain(hourly_summary(stream_feed(spark, directory), registry), "feed", str(tmp_path / "c"))
    # All generated events lie in one hour; the late record only closes it.
    assert sorted(rows_of(found, "sequence_id", "lost_events", "duplicate_events", "segment")) == sorted(
        (n, f["lost"], f["copies"], "phone" if n < 105 else "unknown") for n, f in facts_of(feed_rows).items())
