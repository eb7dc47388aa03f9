"""Schemas of the tables that the engine reads and writes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOCATION = T.StructType([T.StructField("page", T.IntegerType()), T.StructField("sheet", T.StringType()), T.StructField("slide", T.IntegerType())])
SECTION = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("block_id", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("heading_path", T.ArrayType(T.StringType())),
        T.StructField("content", T.StringType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("location", LOCATION),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)
FAILURE = "source string, error string, kind string"
#: The kinds of block, of verdict and of failure.
TYPES = ["heading", "paragraph", "table", "list_item", "code_block", "caption", "image"]
VERDICTS = ["ok", "degraded", "unusable"]
MISSING, BROKEN, UNEXPECTED = "missing_dependency", "parse_error", "unexpected"


def as_sections(df: DataFrame) -> DataFrame:
    """df with exactly the section columns, typed; columns that it lacks are null (an empty path, an empty map)."""
    empty = {"heading_path": F.array().cast("array<string>"), "metadata": F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))}
    return df.select(*((F.col(f.name) if f.name in df.columns else empty.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in SECTION))
