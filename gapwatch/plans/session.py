"""The one session setting results depend on."""

from pyspark.sql import SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Hour truncation and rendered timestamps must not depend on a machine's zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
