"""Walking and rendering nested columns."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def leaf_fields(schema: T.StructType) -> list[str]:
    """Dotted names of all fields that are not structs themselves."""
    leaves: list[str] = []
    for field in schema:
        if isinstance(field.dataType, T.StructType):
            leaves += [f"{field.name}.{leaf}" for leaf in leaf_fields(field.dataType)]
        else:
            leaves.append(field.name)
    return leaves


def payload_json(columns: Iterable[str | Column]) -> Column:
    """The given columns as one JSON text, to compare whole payloads; nulls are left out."""
    return F.to_json(F.struct(*columns))
