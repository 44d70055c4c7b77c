"""The sample warehouse tables read as event sequences.

Readings, so that every measure meets data it has something to find in:

* *clicks*: ``events`` by user, with ``supplier`` as registry (its nation is the
  segment), which lacks part of the users. Arrival times are unique; serials
  repeat and have holes.
* *coarse clicks*: the same with offsets rounded down so that they tie.
* *stable clicks*: the same with types that agree between copies.
* *lines*: ``lineitem`` by order, with ``orders`` as registry. Many short
  sequences; arrivals tie, and some orders have no line.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwatch.sources.tables import events_from, registry_from

CLICK_TYPES = ("click", "error", "purchase", "signup", "view")
CLICK_SEGMENTS = tuple(str(nation) for nation in range(25))
LINE_SEGMENTS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _click_serial():
    return F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_from(
        read(spark, sf_dir, "events"),
        sequence_id="user_id",
        serial_id=_click_serial(),
        offset_ms=_click_serial() * 60000 + F.floor(F.col("value") * 1000),
        arrival="ts",
        event_type="event_type",
    )


def coarse_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks(spark, sf_dir).withColumn("offset_ms", F.floor(F.col("serial_id") / 4) * 240000)


def stable_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the type decided by the serial, so that copies always agree on it."""
    kind = F.get(F.array(*[F.lit(name) for name in CLICK_TYPES]), F.col("serial_id") % len(CLICK_TYPES))
    return clicks(spark, sf_dir).withColumn("event_type", kind)


def click_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = read(spark, sf_dir, "supplier")
    return registry_from(suppliers, sequence_id="s_suppkey", segment=F.col("s_nationkey").cast("string"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    serial = F.col("l_linenumber").cast("bigint") - 1
    return events_from(
        read(spark, sf_dir, "lineitem"),
        sequence_id="l_orderkey",
        serial_id=serial,
        offset_ms=serial * 86400000,
        arrival="l_shipdate",
        event_type="l_returnflag",
    )


def line_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    return registry_from(orders, sequence_id="o_orderkey", segment="o_orderpriority", registered_at="o_orderdate")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` by conversation: a control without gaps or copies."""
    return events_from(
        read(spark, sf_dir, "conversations"),
        sequence_id="conv_id",
        serial_id="turn",
        offset_ms=F.col("turn") * 1000,
        arrival=F.timestamp_seconds("turn"),
        event_type="role",
    )
