"""Results as files on shared storage, written by the executors that hold the rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _csv_ready(result: DataFrame) -> DataFrame:
    """Timestamps rendered as text with microseconds, arrays joined: CSV has neither."""
    columns = []
    for name, data_type in result.dtypes:
        if data_type.startswith("timestamp"):
            columns.append(F.col(name).cast("string").alias(name))
        elif data_type.startswith("array"):
            columns.append(F.array_join(name, "|").alias(name))
        else:
            columns.append(F.col(name))
    return result.select(*columns)


def write_csv(result: DataFrame, path: str) -> None:
    """A directory of CSV files with a header each, in the order of the result."""
    _csv_ready(result).write.mode("overwrite").option("header", True).csv(path)


def write_json(result: DataFrame, path: str) -> None:
    """A directory of JSON lines. Absent values are written as null, not left out."""
    result.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_parquet(result: DataFrame, path: str) -> None:
    result.write.mode("overwrite").parquet(path)


WRITERS = {"csv": write_csv, "json": write_json, "parquet": write_parquet}
