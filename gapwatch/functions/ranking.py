"""Share of the total and rank for small aggregates, from one array of all their rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_share_and_rank(counts: DataFrame, measure: str, share: str, label: str) -> DataFrame:
    """Add ``share`` and ``rank`` and sort by rank, then label.

    ``counts`` has one row per label of an aggregate (event types), few enough
    for an array. A row's rank is one more than the number of larger measures,
    so equal measures share it; the total is the array's sum.
    """
    rows = counts.agg(F.collect_list(F.struct(*counts.columns)).alias("rows"))
    sized = rows.select(
        "rows", F.transform("rows", lambda row: row[measure]).alias("measures")
    ).select("rows", "measures", F.aggregate("measures", F.lit(0).cast("bigint"), lambda total, m: total + m).alias("total"))
    row = sized.select(F.explode("rows").alias("row"), "measures", "total")
    larger = F.size(F.filter("measures", lambda m: m > F.col(f"row.{measure}")))
    return row.select(
        "row.*",
        F.round(F.col(f"row.{measure}") / F.col("total"), 4).alias(share),
        (larger + 1).cast("bigint").alias("rank"),
    ).orderBy("rank", label)


def top_ranked(ranked: DataFrame, label: str) -> DataFrame:
    """One row, one array column ``winners``: every label on rank 1, ties included."""
    winners = F.collect_list(F.when(F.col("rank") == 1, F.col(label)))
    return ranked.agg(F.array_sort(winners).alias("winners"))
