"""JSON messages to typed columns; works on batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BAD = "_bad_json"


def expanded(record: Column) -> Column:
    """The fields of a struct as columns, computed once per row.

    Catalyst does not move a later filter below a generator. Below a plain `select("data.*")` it does, and
    parses the message again for every field that the filter names.
    """
    return F.inline(F.array(record))


def decode_json(
    df: DataFrame,
    schema: str | StructType,
    ts_col: str | None = "timestamp",
    column: str = "value",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Columns of the message in `column`, plus `event_time` parsed from `ts_col`.

    `keep` names columns of `df`, such as a topic's partition and offset, to carry along.

    A malformed message becomes a row of NULLs and an unreadable time a NULL: neither raises, in ANSI mode
    too, so that one bad message cannot stop a stream.
    """
    text = df.selectExpr(*keep, f"CAST({column} AS STRING) AS _text")
    decoded = text.select(*keep, expanded(F.from_json("_text", schema, {"mode": "PERMISSIVE"})))
    if ts_col:
        decoded = decoded.withColumn("event_time", F.try_to_timestamp(F.col(ts_col)))
    return decoded


def rejected_json(df: DataFrame, schema: str | StructType, column: str = "value") -> DataFrame:
    """Rows of `df` whose message is not one JSON value of the schema, with all their columns.

    NULL, empty and blank messages are rejects, and so is anything after the value.
    """
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    probe = StructType(list(declared.fields)).add(BAD, "string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    parsed = F.from_json(F.col(column).cast("string"), probe, options)
    # The parser stops after the first value; put into brackets, a message is an array of one value or no JSON.
    single = F.json_array_length(F.concat(F.lit("["), F.col(column).cast("string"), F.lit("]"))) == 1
    fits = F.coalesce(single & F.col("_parsed").isNotNull() & F.col(f"_parsed.{BAD}").isNull(), F.lit(False))
    return df.withColumn("_parsed", parsed).filter(~fits).drop("_parsed")
