"""Micro-batches merged into a stored summary: equal to batch, also after replays, with every row counted."""

import random
from datetime import timedelta

import pytest
from conftest import EVENTS, HOUR, PAGE, rows_of
from pyspark.sql import functions as F

from gapwatch.monitoring.windows import boundary_completeness, window_blocks
from gapwatch.operators.summary import sequence_summary
from gapwatch.streaming import BlockStore, merge_stream


def _lots(spark, seed, lots=3):
    """Events in lots, later lots later; some late, some broken."""
    draw = random.Random(seed)
    made = []
    for lot in range(lots):
        rows = []
        for _ in range(60):
            serial = draw.randrange(150)
            late = draw.random() < 0.1
            at = HOUR + timedelta(minutes=40 * lot + draw.random() * 30 - (90 if late else 0))
            rows.append((draw.randrange(4), serial, serial * 1000, at, draw.choice([PAGE, "other"])))
        rows += [(1, None, 5, HOUR, PAGE), (None, 3, 5, HOUR, PAGE), (2, 3, -1, HOUR, PAGE)][:draw.randrange(4)]
        made.append(spark.createDataFrame(rows, EVENTS))
    return made


def _sound(events):
    return events.filter("sequence_id IS NOT NULL AND serial_id >= 0 AND offset_ms >= 0 AND arrival IS NOT NULL")


def _all(lots):
    union = lots[0]
    for lot in lots[1:]:
        union = union.unionByName(lot)
    return union


def _same(one, other):
    assert sorted(map(repr, rows_of(one.select(sorted(one.columns))))) == sorted(map(repr, rows_of(other.select(sorted(other.columns)))))


@pytest.mark.parametrize("seed", range(1))
def test_batches_and_their_replays_agree_with_one_batch(spark, make_registry, tmp_path, seed):
    lots, registry = _lots(spark, seed), make_registry([(0, "phone"), (1, "desktop")])
    whole = _sound(_all(lots))
    store = BlockStore(spark, str(tmp_path / "store"), whole.schema)
    assert store.summary(registry).count() == 0
    for batch, lot in enumerate(lots):
        store.merge(lot, batch)
    counts = store.counts().orderBy("batch").collect()
    _same(store.summary(registry), sequence_summary(whole, registry))
    # A replay, of the last batch and of an earlier one, changes nothing.
    store.merge(lots[2], 2)
    store.merge(lots[1], 1)
    assert store.counts().orderBy("batch").collect() == counts
    _same(store.summary(registry), sequence_summary(whole, registry))
    # Late rows are in their window: nothing that came late is a loss.
    _same(boundary_completeness(store.windows()), boundary_completeness(window_blocks(whole)))


def test_every_row_is_counted(spark, tmp_path):
    lots = _lots(spark, 7)
    store = BlockStore(spark, str(tmp_path / "store"), lots[0].schema)
    for batch, lot in enumerate(lots):
        store.merge(lot, batch)
    latest = None
    for row, lot in zip(store.counts().orderBy("batch").collect(), lots):
        sound = _sound(lot)
        assert row["received"] == lot.count() == row["kept"] + row["rejected"] and row["kept"] == sound.count()
        late = 0 if latest is None else sound.filter(F.col("arrival") < F.lit(latest - timedelta(minutes=10))).count()
        assert row["late"] == late == store.late().filter(F.col("batch") == row["batch"]).count()
        reasons = store.rejected().filter(F.col("batch") == row["batch"])
        assert reasons.count() == row["rejected"] and reasons.filter("reason IS NULL").count() == 0
        newest = sound.agg(F.max("arrival")).first()[0]
        latest = newest if latest is None else max(latest, newest)
    assert store.late().count() > 0 and store.rejected().count() > 0


def test_compacting_changes_nothing_and_is_continued(spark, make_registry, tmp_path):
    lots, registry = _lots(spark, 3), make_registry([(0, "phone")])
    store = BlockStore(spark, str(tmp_path / "store"), lots[0].schema)
    for batch, lot in enumerate(lots[:2]):
        store.merge(lot, batch)
    store.compact()
    _same(store.summary(registry), sequence_summary(_sound(_all(lots[:2])), registry))
    for batch, lot in enumerate(lots[2:], 2):
        store.merge(lot, batch)
    again = BlockStore(spark, str(tmp_path / "store"), lots[0].schema)  # opened anew
    _same(again.summary(registry), sequence_summary(_sound(_all(lots)), registry))
    again.compact()
    _same(again.summary(registry), sequence_summary(_sound(_all(lots)), registry))


def test_an_unfinished_batch_does_not_count(spark, make_registry, tmp_path):
    lots, registry = _lots(spark, 4), make_registry([(0, "phone")])
    store = BlockStore(spark, str(tmp_path / "store"), lots[0].schema)
    store.merge(lots[0], 0)
    write = store._write

    def failing(name, batch, lot):
        if name == "counts":
            raise OSError("lost before the counts")
        write(name, batch, lot)

    store._write = failing
    with pytest.raises(OSError):
        store.merge(lots[1], 1)
    store._write = write
    _same(store.summary(registry), sequence_summary(_sound(lots[0]), registry))
    store.merge(lots[1], 1)
    _same(store.summary(registry), sequence_summary(_sound(_all(lots[:2])), registry))


def test_a_stream_fills_the_store(spark, make_registry, tmp_path):
    lots, registry = _lots(spark, 5), make_registry([(0, "phone")])
    for lot in lots:
        lot.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(lots[0].schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    store = BlockStore(spark, str(tmp_path / "store"), lots[0].schema)
    for _ in range(2):  # the second run finds nothing new
        query = merge_stream(stream, store, str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        query.awaitTermination(300)
        assert query.exception() is None
    _same(store.summary(registry), sequence_summary(_sound(_all(lots)), registry))
    assert store.counts().agg(F.sum("received")).first()[0] == _all(lots).count()
