"""Column expressions shared by the operators.  All are JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How many buckets a text value may fall in.
CATEGORY_BUCKETS = 1000


def _hex_prefix_as_long(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def bucket(col: Column, buckets: int = CATEGORY_BUCKETS) -> Column:
    """Stable bucket of a text value; the same in every process and session."""
    hashed = F.pmod(_hex_prefix_as_long(F.md5(col), 8), F.lit(buckets))
    return F.when(col == "", F.lit(0).cast("bigint")).otherwise(hashed)


def try_number(col: Column) -> Column:
    """Double value of a text, NULL where it is not a number."""
    return col.try_cast("double")


def finite(col: Column) -> Column:
    """The value as double, NULL for NaN and the infinities.

    One NaN would otherwise poison mean and deviation, and Spark orders NaN
    above every number, so it would also count as exceeding any threshold.
    """
    value = col.cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def key_hash(seed: int, *keys: str) -> Column:
    """Seeded digest of a row key, the order in which rows are sampled."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def uniform(seed: int, *keys: str) -> Column:
    """Seeded uniform value in [0, 1) that depends on the row key only.

    Unlike ``rand`` it gives the same value under any partitioning and when a
    lost task is run again.
    """
    return _hex_prefix_as_long(key_hash(seed, *keys), 8) / F.lit(float(1 << 32))


def hour_of_iso(col: Column) -> Column:
    """Hour of an ISO-8601 text, NULL where the text is not a timestamp."""
    return F.hour(F.try_to_timestamp(col))


def time_cutoff(as_of: Column, window: str) -> Column:
    """``as_of`` minus a window such as ``'1 hour'``."""
    return as_of - F.expr(f"INTERVAL {window}")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is 0 when the denominator is 0 or NULL."""
    quotient = numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
    return F.coalesce(quotient, F.lit(0.0))


def capped_ratio(numerator: Column, denominator: Column, cap: float = 1.0) -> Column:
    return F.least(ratio(numerator, denominator), F.lit(cap))


def percent_text(share: Column, decimals: int = 1) -> Column:
    """A share of 0..1 as text, for example ``'23.5%'``."""
    return F.format_string(f"%.{decimals}f%%", share * 100)


def clean_name(name: str) -> str:
    return name.replace(" ", "")


def alert_id(when: Column, *parts: Column) -> Column:
    """Id made from the alert's own content, so a replayed row keeps its id."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.concat_ws("_", F.lit("ALT"), F.date_format(when, "yyyyMMdd"), digest)
