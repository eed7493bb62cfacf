"""Documents whose fields nobody has declared, as VARIANT values that are typed on demand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT = "document"
# Types that numbers of JSON come as, by their digits.
NUMBERS = r"^(BIGINT|DOUBLE|DECIMAL.*)$"


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents, one per line, each as one VARIANT in `document`; a line that is no JSON is NULL."""
    return spark.read.text(path).select(F.try_parse_json("value").alias(DOCUMENT))


def found_schema(docs: DataFrame) -> str:
    """The schema that all documents fit, as Spark SQL writes it; fields that only some have are in it.

    One aggregation: tasks merge the schemas of their own documents. A field of two types that do not go together is
    a VARIANT in it.
    """
    return docs.agg(F.schema_of_variant_agg(DOCUMENT)).first()[0]


def field_kinds(docs: DataFrame) -> DataFrame:
    """For each field on the top level its `kind`s (NUMBER, STRING, ...) and the number `n` of documents with each.

    Documents that are no objects, NULLs among them, have no fields. Partial counts go over the shuffle, a row per field
    and kind and task.
    """
    spark = docs.sparkSession
    fields = docs.lateralJoin(spark.tvf.variant_explode(F.col(DOCUMENT).outer()))
    kind = F.regexp_replace(F.regexp_replace(F.schema_of_variant("value"), NUMBERS, "NUMBER"), r"^(OBJECT|ARRAY)<.*$", "$1")
    named = fields.filter(F.col("key").isNotNull()).select(F.col("key").alias("field"), kind.alias("kind"))
    return named.groupBy("field", "kind").agg(F.count("*").alias("n"))


def typed_fields(docs: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Columns of the documents: name to a path and a type, `"user": "$.userId INT"`; what does not fit is NULL."""

    def column(name: str, at: str):
        path, kind = at.rsplit(" ", 1)
        return F.try_variant_get(DOCUMENT, path, kind).alias(name)

    return docs.select(*(column(name, at) for name, at in fields.items()))
