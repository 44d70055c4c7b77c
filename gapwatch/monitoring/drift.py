"""What producers send against what is declared: new, vanished and retyped fields of raw JSON records."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, FractionalType, IntegralType, StringType, StructType

#: Kinds of JSON values, by the first word of a variant's type.
_KINDS = {"BIGINT": "integer", "DECIMAL": "number", "DOUBLE": "number", "FLOAT": "number", "STRING": "text", "BOOLEAN": "boolean",
          "OBJECT": "object", "ARRAY": "array", "VOID": "null"}
#: Kinds a declared kind reads without loss.
_FITS = {"number": ("integer", "number")}


def _kind(data_type: DataType) -> str:
    for of, kind in ((StructType, "object"), (ArrayType, "array"), (BooleanType, "boolean"), (StringType, "text"),
                     (IntegralType, "integer"), (FractionalType, "number")):
        if isinstance(data_type, of):
            return kind
    return "text"


def declared_fields(schema: StructType, above: str = "") -> list[tuple[str, str]]:
    """``(path, kind)`` of every declared field, nested ones by dotted path."""
    fields = []
    for declared in schema:
        path = f"{above}{declared.name}"
        fields.append((path, _kind(declared.dataType)))
        if isinstance(declared.dataType, StructType):
            fields.extend(declared_fields(declared.dataType, f"{path}."))
    return fields


def sent_fields(records: DataFrame, column: str, depth: int = 3) -> DataFrame:
    """``(path, kind, rows)`` of all fields in JSON text, down to ``depth`` levels; broken text is path ``null``.

    A key is counted once per record and level; the values are parsed once.
    """
    level = records.select(F.try_parse_json(column).alias("value"), F.col(column).isNotNull().alias("there"))
    broken = level.filter("there AND value IS NULL").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 0").select(
        F.lit(None).cast("string").alias("path"), F.lit("broken").alias("kind"), "rows")
    level = level.filter("value IS NOT NULL").select(F.lit("").alias("above"), "value")
    first_word = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    kinds = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
    found = broken
    for _ in range(depth):
        inside = level.filter(first_word == "OBJECT").lateralJoin(
            records.sparkSession.tvf.variant_explode(F.col("value").outer())
            .select(F.col("key"), F.col("value").alias("inner")))
        level = inside.select(F.concat("above", "key").alias("path"), F.col("inner").alias("value"))
        found = found.unionByName(level.groupBy("path", F.coalesce(F.try_element_at(kinds, first_word), F.lit("other")).alias("kind")).agg(
            F.count(F.lit(1)).alias("rows")))
        level = level.select(F.concat("path", F.lit(".")).alias("above"), "value")
    return found


def field_drift(records: DataFrame, column: str, declared: StructType, depth: int = 3) -> DataFrame:
    """``(path, declared_kind, kind, rows, status)``: sent fields against the declared schema.

    ``status`` is ``declared``, ``new`` (a reader with this schema ignores it),
    ``retyped`` (it can't read the value), ``null``, ``broken`` (no JSON), or
    ``vanished``: declared, but in no record, with 0 rows.
    """
    known = records.sparkSession.createDataFrame(declared_fields(declared), "path string, declared_kind string")
    joined = sent_fields(records, column, depth).join(known, "path", "full_outer")
    fits = F.col("kind") == F.col("declared_kind")
    for wide, narrow in _FITS.items():
        fits = fits | ((F.col("declared_kind") == wide) & F.col("kind").isin(*narrow))
    status = (
        F.when(F.col("kind") == "broken", "broken").when(F.col("kind").isNull(), "vanished")
        .when(F.col("declared_kind").isNull(), "new").when(F.col("kind") == "null", "null")
        .when(fits, "declared").otherwise("retyped")
    )
    return joined.select("path", "declared_kind", "kind", F.coalesce("rows", F.lit(0)).alias("rows"), status.alias("status"))
