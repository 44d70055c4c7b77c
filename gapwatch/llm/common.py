"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed by the contracts: words are separated by these characters.
SPACES = " \t\n\x0b\x0c\r"
#: Rows, and bytes, that Spark hands to Python at once; bounds memory when texts are long.
BATCH_ROWS, BATCH_BYTES = 256, 16 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see (``spark.checkpoint.dir``).

    Where the setting is missing, a local session gets a folder of its own;
    any other master is an error, as its machines share no local folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="gapwatch-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written to the shared folder and read back: computed once, whatever machine is lost later."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/gapwatch/{label}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def small_batches(frame: DataFrame, rows: int = BATCH_ROWS) -> DataFrame:
    """Let Spark hand at most ``rows`` rows, or one row of more than BATCH_BYTES, to Python at once, in this session."""
    conf = frame.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return frame


def id_and_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The two columns the operators read, under fixed names; a null text is empty. Other columns are left behind."""
    return docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )


def table(columns: dict[str, Iterable], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal ``keys`` from batches that are sorted by them; a run may span batches."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = list(zip(*(batch.column(k).to_pylist() for k in keys)))
        start = 0
        for i in range(1, len(values) + 1):
            if i < len(values) and values[i] == values[start]:
                continue
            if held and held_key != values[start]:
                yield pa.Table.from_batches(held)
                held = []
            held_key = values[start]
            held.append(batch.slice(start, i - start))
            start = i
    if held:
        yield pa.Table.from_batches(held)
