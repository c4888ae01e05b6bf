"""Scalar column functions.

Each returns a ``Column`` built only from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen and works the same on batch and streaming
DataFrames.  Arguments accept a column name or a ``Column``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
MASK_KEEP = 4                 # leading characters of a phone number kept
MASK_FILL = "*******"         # seven stars appended after them
AGE_BAND_YOUNG = 20           # ages below this are the youngest band
AGE_BAND_MID_MAX = 30         # ages up to this (inclusive) are the middle band
DAYS_PER_YEAR = 365           # ages are counted in 365-day years
# Token pattern of the keyword analyser: one token per Han character, else a
# run of letters and digits; text is lower-cased first.
TOKEN_PATTERN = r"\p{IsHan}|[\p{L}\p{N}&&[^\p{IsHan}]]+"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_ms(ts: str | Column) -> Column:
    """Timestamp (or timestamp_ntz, read as session-zone wall time) -> epoch ms."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def log_date(ts_ms: str | Column) -> Column:
    """Epoch ms -> ``yyyy-MM-dd`` in the session time zone."""
    return F.date_format(F.timestamp_millis(_c(ts_ms)), "yyyy-MM-dd")


def log_hour(ts_ms: str | Column) -> Column:
    """Epoch ms -> two-digit hour ``HH`` in the session time zone."""
    return F.date_format(F.timestamp_millis(_c(ts_ms)), "HH")


def mask_tel(tel: str | Column) -> Column:
    """Keep the first four characters and append seven stars.

    Shorter input keeps all of itself ('12' -> '12*******'); null stays null.
    """
    tel = _c(tel)
    return F.when(tel.isNotNull(), F.concat(F.substring(tel, 1, MASK_KEEP), F.lit(MASK_FILL)))


def create_date(create_time: str | Column) -> Column:
    """Date part of ``yyyy-MM-dd HH:mm:ss`` (text before the first space)."""
    return F.try_element_at(F.split(_c(create_time), " "), F.lit(1))


def create_hour(create_time: str | Column) -> Column:
    """Hour part of ``yyyy-MM-dd HH:mm:ss``; null when there is no time part."""
    time_part = F.try_element_at(F.split(_c(create_time), " "), F.lit(2))
    return F.try_element_at(F.split(time_part, ":"), F.lit(1))


def sku_price(price: str | Column) -> Column:
    """Price string -> double; unparseable text gives null instead of failing."""
    return _c(price).try_cast("double")


def age_365(birthday: str | Column, as_of: str | Column) -> Column:
    """Whole 365-day years between a ``yyyy-MM-dd`` birthday and ``as_of``.

    Truncates toward zero like integer division of elapsed milliseconds; a
    malformed birthday gives null.
    """
    as_of_col = F.lit(as_of) if isinstance(as_of, str) else as_of
    days = F.datediff(F.to_date(as_of_col), F.try_to_date(_c(birthday)))
    return (days.cast("long") / F.lit(DAYS_PER_YEAR)).cast("long").cast("int")


def age_band(age: str | Column) -> Column:
    """``lt20`` / ``20to30`` (both ends inclusive) / ``gt30``."""
    age = _c(age)
    return (
        F.when(age < AGE_BAND_YOUNG, F.lit("lt20"))
        .when(age <= AGE_BAND_MID_MAX, F.lit("20to30"))
        .otherwise(F.lit("gt30"))
    )


def ratio1(count: str | Column, total: str | Column) -> Column:
    """Percentage with one decimal, rounded half up; zero total gives 0.0."""
    count, total = _c(count), _c(total)
    share = F.floor(count.cast("double") * 1000.0 / total + 0.5) / 10.0
    return F.when(total == 0, F.lit(0.0)).otherwise(share)


def prev_day(date: str | Column) -> Column:
    """``yyyy-MM-dd`` -> the day before, same format."""
    date_col = F.lit(date) if isinstance(date, str) else date
    return F.date_format(F.date_sub(F.to_date(date_col), 1), "yyyy-MM-dd")


def alert_id(mid: str | Column, ts_ms: str | Column, bucket_seconds: int = 60) -> Column:
    """``mid + '_' + minute bucket`` of an epoch-ms time."""
    bucket = (_c(ts_ms) / F.lit(1000 * bucket_seconds)).cast("long")
    return F.concat_ws("_", _c(mid), bucket.cast("string"))


def tokens(text: str | Column) -> Column:
    """Analysed terms of a text: lower-cased letter/digit runs, Han chars alone."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(TOKEN_PATTERN), 0)
