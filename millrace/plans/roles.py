"""Stand-ins: the operators' inputs derived from the given tables, over all of their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import configure, fit_to_inputs
from millrace.sources import expanded, read_table

PROPS = "k INT"


def tables(spark: SparkSession, sf_dir: str, *names: str, streaming: bool = False) -> list[DataFrame]:
    """Given tables, with the session set up for a query over all of them."""
    configure(spark)
    frames = [read_table(spark, f"{sf_dir}/{name}.parquet") for name in names]
    fit_to_inputs(spark, *frames, streaming=streaming)
    return frames


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The one table a query reads."""
    return tables(spark, sf_dir, name)[0]


def drifting(lines: DataFrame) -> list[DataFrame]:
    """lineitem cut by ship date into frames that drift like periodic files do.

    The key is INT, then DOUBLE with an extra column, then the columns come in another order.
    """
    shipped = F.col("l_shipdate")
    second, third = (F.lit(day).cast("timestamp_ntz") for day in ("1998-01-01", "2000-01-01"))
    lines = lines.select(
        "l_linenumber", "l_returnflag", "l_extendedprice", "l_quantity", "l_orderkey", "l_shipdate"
    )
    return [
        lines.filter(shipped < second).drop("l_shipdate"),
        lines.filter((shipped >= second) & (shipped < third)).withColumn(
            "l_linenumber", F.col("l_linenumber").cast("double")
        ),
        lines.filter((shipped >= third) | shipped.isNull()).select(*reversed(lines.columns)),
    ]


def _with_property(events: DataFrame, filtered: bool) -> DataFrame:
    """Events with their property as column k; NULL if there is none.

    A plain column is not computed where nothing needs it, but would be computed again for a filter on it; with
    `filtered` it is parsed once per row, whether it is needed or not.
    """
    if not filtered:
        return events.withColumn("k", F.from_json("props", PROPS)["k"])
    parsed = F.coalesce(F.from_json("props", PROPS), F.struct(F.lit(None).cast("int").alias("k")))
    return events.select("*", expanded(parsed))


def readings(events: DataFrame, filtered: bool = False) -> DataFrame:
    """Events as sensor readings; an error event is a critical status. `filtered`: the query filters on humidity."""
    return _with_property(events, filtered).select(
        "event_id",
        F.col("user_id").cast("string").alias("sensor_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("value").alias("temperature"),
        F.col("k").cast("double").alias("humidity"),
        F.when(F.col("event_type") == "error", "critical").otherwise("normal").alias("status"),
    )


def reading_messages(events: DataFrame) -> DataFrame:
    """Sensor readings as the binary JSON messages of a topic."""
    message = F.struct(
        "sensor_id",
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        "temperature",
        "humidity",
        "status",
    )
    return readings(events).select("event_id", F.to_json(message).cast("binary").alias("value"))


def purchases(events: DataFrame) -> DataFrame:
    """Purchase events as transactions."""
    return events.filter(F.col("event_type") == "purchase").select(F.col("value").alias("amount"))


def purchase_messages(events: DataFrame) -> DataFrame:
    """Purchase events as the binary JSON messages of a topic."""
    message = F.struct(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("value").alias("amount"),
    )
    bought = events.filter(F.col("event_type") == "purchase")
    return bought.select(F.to_json(message).cast("binary").alias("value"))


def process_samples(events: DataFrame) -> DataFrame:
    """Events as process samples: the value is the CPU share, the property the memory."""
    memory = F.col("k").cast("double")
    return _with_property(events, filtered=True).select(
        F.col("user_id").alias("pid"),
        F.col("event_type").alias("name"),
        F.col("value").alias("cpu_pct"),
        (memory / 10).alias("mem_pct"),
        memory.alias("mem_mb"),
        F.col("ts").alias("sampled_at"),
        "event_id",
    )


def loose_documents(events: DataFrame) -> DataFrame:
    """Events as JSON lines: a third have a further field, and every fourth value is a text."""
    number = F.col("event_id")
    fields = {
        "_id": number,
        "userId": F.col("user_id"),
        "eventType": F.col("event_type"),
        "value": F.when(number % 4 > 0, F.col("value")),
        "text": F.when(number % 4 == 0, F.concat(F.lit("about "), F.col("value").cast("string"))),
        "note": F.when(number % 3 == 0, F.concat(F.lit("note "), number.cast("string"))),
        "metadata": F.from_json("props", PROPS),
    }
    line = F.to_json(F.struct(*(c.alias(name) for name, c in fields.items())))
    # One field of two types: a struct cannot hold it, so the text gets its name in the line.
    return events.select(F.replace(line, F.lit('"text":'), F.lit('"value":')).alias("value"))


def documents(events: DataFrame) -> DataFrame:
    """Events as nested documents."""
    return events.select(
        F.col("event_id").alias("_id"),
        F.col("user_id").cast("int").alias("userId"),
        F.col("event_type").alias("eventType"),
        "value",
        F.from_json("props", PROPS).alias("metadata"),
    )


DOCUMENT = "_id BIGINT, userId INT, eventType STRING, value DOUBLE, metadata STRUCT<k: INT>"


def log_text(events: DataFrame, broken: int = 0) -> DataFrame:
    """Events as system log lines; the service is the user. Every `broken`-th lacks its colon."""

    def text(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit("unknown"))

    return events.select(
        F.concat(
            F.date_format("ts", "MMM dd HH:mm:ss"),
            F.lit(" node1 app-"),
            text("user_id"),
            F.lit("["),
            F.col("event_id"),
            F.when(F.col("event_id") % broken == 0, "] - ").otherwise("]: ") if broken else F.lit("]: "),
            F.initcap(text("event_type")),
            F.lit(" with value "),
            text("value"),
        ).alias("value")
    )
