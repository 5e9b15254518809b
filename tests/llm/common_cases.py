"""Documents that every operator must take: nulls, empty, repeated and clashing columns."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType(
    [StructField("doc_id", LongType())]
    + [StructField(c, StringType()) for c in ("text", "lang", "source", "k", "n", "id", "words", "length")]
)


def documents(spark, pairs):
    """Documents with null columns whose names operators may use themselves."""
    return spark.createDataFrame([(i, t, None, "s", "x", None, "y", None, "z") for i, t in pairs], SCHEMA)
