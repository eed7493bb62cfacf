"""Deterministic placement and sampling from hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hex digits of MD5 that decide about a row: fractions are exact to one in 16 ** 15.
SAMPLE_DIGITS = 15
NULL_TEXT = "\\N"


def bucket_of(n: int, *keys: str) -> Column:
    """The partition a hash exchange or a bucketed table of width `n` puts the row in."""
    return F.pmod(F.hash(*keys), F.lit(n))


def sample_cut(fraction: float) -> str:
    """Digits below which a row is in the sample; a positive fraction too small to choose anything raises."""
    cut = round(fraction * 16**SAMPLE_DIGITS)
    if not 0 <= fraction <= 1 or (fraction > 0 and cut == 0):
        raise ValueError(f"no rows can be chosen by a fraction of {fraction}")
    return f"{cut:0{SAMPLE_DIGITS}x}" if fraction < 1 else "g"


def in_sample(fraction: float, seed: int, *by: str) -> Column:
    """True for about `fraction` of the rows, decided by the row's own `by` values.

    Unlike `DataFrame.sample`, the choice depends neither on file layout nor on task retries.
    """
    values = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)) for c in by]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *values).cast("binary"))
    return F.substring(digest, 1, SAMPLE_DIGITS) < F.lit(sample_cut(fraction))
