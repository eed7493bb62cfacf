"""System log text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.messages import expanded

# Time, host, `service[pid]:` and message; the time is `MMM dd HH:mm:ss` or ISO 8601.
# The mark that parts the fields is in none of them but the message.
MARK = "\x01"
LOG_LINE = r"^(\w{3} +\d+ [\d:]{8}|\d{4}-\d\d-\d\dT[^\s\x01]+) ([^\s\x01]+) ([^\[:\x01]+?)(?:\[\d+\])?: (.*)$"
PARTS = MARK.join(f"${group}" for group in range(1, 5))
FIELDS = ("logged_at", "host", "service", "message")


def read_logs(spark: SparkSession, path: str, containing: str | None = None) -> DataFrame:
    """Log files, one row per line; text files split, so a large file is read by many tasks."""
    return log_fields(spark.read.text(path), containing=containing)


def _parts(column: str) -> Column:
    """The line's fields from one pass of the pattern; one item or NULL if the line has another layout.

    A line that holds the mark itself is tested against the pattern first, for it could pass for fields.
    """
    line = F.col(column)
    parts = F.split(F.regexp_replace(line, LOG_LINE, PARTS), MARK, 4)
    return F.when(~line.contains(MARK) | line.rlike(LOG_LINE), parts)


def log_fields(lines: DataFrame, column: str = "value", containing: str | None = None) -> DataFrame:
    """Extract logged_at, host, service and message; for lines of another layout see `rejected_lines`.

    With `containing`, lines without that text, in any case, are dropped before the costlier pattern
    runs on them.
    """
    if containing:
        lines = lines.filter(F.lower(column).contains(containing.lower()))
    parts = expanded(F.struct(_parts(column).alias("_parts")))
    fields = [F.get("_parts", at).alias(name) for at, name in enumerate(FIELDS)]
    return lines.select(parts).filter(F.size("_parts") == len(FIELDS)).select(*fields)


def rejected_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Rows whose line has another layout, empty and NULL lines among them."""
    fits = F.coalesce(F.size(_parts(column)) == len(FIELDS), F.lit(False))
    return lines.filter(~fits)


def log_time(logged_at: str = "logged_at", year: int = 1970) -> Column:
    """The time as a timestamp; the classic layout has no year, so it is given. NULL if unreadable."""
    text = F.regexp_replace(logged_at, " +", " ")
    classic = F.try_to_timestamp(F.concat(F.lit(f"{year} "), text), F.lit("yyyy MMM d HH:mm:ss"))
    return F.coalesce(F.when(text.rlike("^[0-9]"), F.try_to_timestamp(text)), F.when(text.rlike("^[A-Za-z]"), classic))
