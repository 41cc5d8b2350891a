"""Column types found in the data: one distributed pass over delimited files.

The types form a chain, null < integer < bigint < double < string, so the type
of a column is the greatest of its fields', and the greatest of several files
or partitions is the greatest of theirs: one grouped maximum with partial
aggregation, whatever the size. Blank fields are null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources import schemas
from tessera.sources.local import literal_table

CHAIN = ("null", "integer", "bigint", "double", "string")
SPARK_TYPES = {"null": T.StringType(), "integer": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}
REPORT = T.StructType([
    T.StructField("position", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("n_rows", T.LongType()), T.StructField("n_null", T.LongType()), T.StructField("width", T.IntegerType())])


def rank_of(field: Column) -> Column:
    """Place in the chain of a text field."""
    text = F.trim(field)
    whole = text.rlike(r"^[+-]?[0-9]+$")
    return (F.when(field.isNull() | (text == ""), 0)
            .when(whole & text.try_cast("int").isNotNull(), 1)
            .when(whole & text.try_cast("bigint").isNotNull(), 2)
            .when(text.try_cast("double").isNotNull() & ~text.rlike("(?i)[df]$"), 3)  # Java's 1d and 1f are no numbers here
            .otherwise(4))


def infer_types(fields: DataFrame) -> DataFrame:
    """position, name, type, n_rows, n_null, width (characters of the longest
    field) of every column of ``fields``, which are all text."""
    wanted = []
    for i, c in enumerate(fields.columns):
        col = F.col(f"`{c}`")
        wanted += [F.max(rank_of(col)).alias(f"r{i}"), F.count_if(F.trim(F.coalesce(col, F.lit(""))) == "").alias(f"n{i}"),
                   F.max(F.length(F.trim(col))).alias(f"w{i}")]
    got = fields.agg(F.count(F.lit(1)).alias("n"), *wanted).first()
    rows = [(i, c, CHAIN[got[f"r{i}"] or 0], got["n"], got[f"n{i}"], got[f"w{i}"] or 0) for i, c in enumerate(fields.columns)]
    return literal_table(fields.sparkSession, rows, REPORT)


def text_fields(spark: SparkSession, path: str, sep: str = schemas.DELIMITER, encoding: str = "UTF-8") -> DataFrame:
    """Delimited files with a header as text columns, none converted."""
    options = {"header": "true", "sep": sep, "encoding": encoding, "mode": "PERMISSIVE"}
    names = [c.strip() for c in spark.read.options(**options).csv(path).columns]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).options(**options, enforceSchema="false").csv(path)


def inferred_schema(report: DataFrame) -> T.StructType:
    rows = report.orderBy("position").collect()
    return T.StructType([T.StructField(r["name"], SPARK_TYPES[r["type"]]) for r in rows])


def read_inferred(spark: SparkSession, path: str, sep: str = schemas.DELIMITER, encoding: str = "UTF-8") -> DataFrame:
    """The files with the types that their fields allow: a pass for the types,
    then a typed scan, which prunes to the columns that are used."""
    schema = inferred_schema(infer_types(text_fields(spark, path, sep, encoding)))
    options = {"header": "true", "sep": sep, "encoding": encoding, "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    return spark.read.schema(schema).options(**options, enforceSchema="false").csv(path)
