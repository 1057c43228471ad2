"""Column expressions: blanks, defaults, time stamps, arrays. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Tokens that stand for "no value" in exported rows, and the export marker.
NULL_TOKENS = ("UNKNOWN", "内网IP", "0")
EXPORT_NULL = "\\N"

# The open end of a history row, and the label of a missing dimension.
OPEN_END = "9999-12-31"
UNKNOWN_LABEL = "未知"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def blank_to_null(col: Column | str) -> Column:
    """Trimmed text, or null when nothing but blanks is left."""
    return F.nullif(F.trim(_c(col)), F.lit(""))


def with_default(col: Column | str, default=UNKNOWN_LABEL) -> Column:
    return F.coalesce(_c(col), F.lit(default))


def normalise_null(col: Column | str, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Real null for null and for every token that means "no value"."""
    text = _c(col).cast("string")
    return F.when(~text.isin(*tokens), text)


def export_text(col: Column | str, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Text as an export row carries it: missing values become the export marker."""
    return F.coalesce(normalise_null(col, tokens), F.lit(EXPORT_NULL))


def epoch_millis(ts: Column | str) -> Column:
    return F.unix_millis(_c(ts).cast("timestamp"))


def millis_date(ms: Column | str) -> Column:
    return F.to_date(F.timestamp_millis(_c(ms)))


def hour_stamp(ms: Column | str) -> Column:
    """yyyyMMddHH as a number."""
    return F.date_format(F.timestamp_millis(_c(ms)), "yyyyMMddHH").cast("long")


def hour_of_day(ms: Column | str) -> Column:
    return F.hour(F.timestamp_millis(_c(ms))).cast("long")


def ip_to_long(ip: Column | str) -> Column:
    """Dotted IPv4 text to its number; null when the text is no address."""
    text = _c(ip)
    parts = F.split(text, "\\.")
    octet = [F.get(parts, F.lit(i)).try_cast("long") for i in range(4)]
    value = octet[0] * 16777216 + octet[1] * 65536 + octet[2] * 256 + octet[3]
    in_range = octet[0].between(0, 255)
    for o in octet[1:]:
        in_range = in_range & o.between(0, 255)
    return F.when((F.size(parts) == 4) & in_range, value)


def array_cardinality(arr: Column | str) -> Column:
    """Number of distinct non-null members."""
    return F.size(F.array_distinct(F.array_compact(_c(arr)))).cast("long")


def first_k(arr: Column | str, k: int) -> Column:
    """The k smallest distinct members, ascending."""
    return F.slice(F.sort_array(F.array_distinct(F.array_compact(_c(arr)))), 1, k)


def flatten_distinct(nested: Column | str) -> Column:
    """Distinct members over all inner arrays."""
    return F.array_distinct(F.flatten(_c(nested)))


def squared_distance(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(
        F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)),
        F.lit(0.0).cast("double"),
        lambda acc, d: acc + d.cast("double"),
    )


def day_offset(day: Column | str, days: int) -> Column:
    return F.date_add(_c(day).cast("date"), days)


def month_offset(day: Column | str, months: int) -> Column:
    return F.add_months(_c(day).cast("date"), months)


def text_to_epoch_seconds(text: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss", zone: str = "+08:00") -> Column:
    """Seconds since the epoch of a wall-clock text read in ``zone``."""
    wall = F.to_timestamp_ntz(_c(text), F.lit(pattern))
    return F.unix_seconds(F.convert_timezone(F.lit(zone), F.lit("UTC"), wall).cast("timestamp"))
