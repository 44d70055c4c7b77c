"""Checks that fail a run instead of repairing or dropping rows.

Dropping a bad row would itself create the gap that is being measured.
"""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gapwatch.functions.payload import leaf_fields


# What a run requires of each column: a value, and where there is one the least it may be.
REQUIRED: dict[str, int | None] = {"sequence_id": None, "serial_id": 0, "offset_ms": 0, "arrival": None}


def _broken(column: str, least: int | None) -> Column:
    """Whether a row breaks the column's rule; a null breaks every rule."""
    holds = F.col(column).isNotNull() if least is None else F.col(column) >= least
    return ~F.coalesce(holds, F.lit(False))


def _described(column: str, least: int | None) -> str:
    return f"{column} is missing" + ("" if least is None else " or negative" if least == 0 else f" or below {least}")


def _problems(required: dict[str, int | None] = REQUIRED) -> dict[str, Column]:
    return {_described(column, least): _broken(column, least) for column, least in required.items()}


def problem_of() -> Column:
    """The first problem of a row, or null."""
    return F.coalesce(*[F.when(bad, F.lit(problem)) for problem, bad in _problems().items()])


def violations(events: DataFrame) -> DataFrame:
    """Rows ``(problem, rows)``, one per required-field problem, zero counts included."""
    problems = _problems()
    counted = events.agg(*[F.count_if(bad).alias(problem) for problem, bad in problems.items()])
    return counted.unpivot([], list(problems), "problem", "rows")


def assert_valid(events: DataFrame) -> DataFrame:
    """Return ``events`` unchanged, or raise naming every problem and its number of rows.

    Run it before any segment filter: a row that lost its key matches no
    registry row, so a filter would hide it.
    """
    broken = violations(events).filter("rows > 0").orderBy("problem").collect()
    if broken:
        raise ValueError("; ".join(f"{row['problem']} in {row['rows']} events" for row in broken))
    return events


def watch_violations(events: DataFrame) -> tuple[DataFrame, Observation]:
    """Count the same problems on the side of whatever job reads the returned frame first."""
    watch = Observation()
    problems = _problems()
    return events.observe(watch, *[F.count_if(bad).alias(problem) for problem, bad in problems.items()]), watch


def assert_parses(source: DataFrame) -> DataFrame:
    """Return ``source`` unchanged after converting every declared field of every row.

    A fail-fast read only rejects a wrong value in columns that are read, so a
    narrow query does not notice one in a payload field. This reads them all.
    """
    source.agg(*[F.count(F.col(leaf)) for leaf in leaf_fields(source.schema)]).collect()
    return source
