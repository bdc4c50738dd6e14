"""Column -> Column helpers (the reference's SQL macros, as plain Spark expressions).

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; nothing is a Python UDF.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

# --- fixed values that must equal the reference's -------------------------
# Payment type code -> label (codes 0..6, everything else 'Unknown').
PAYMENT_LABELS = {
    0: "Flex Fare trip",
    1: "Credit Card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_DEFAULT = "Unknown"
# Vendor id -> label (other ids give NULL).
VENDOR_LABELS = {
    1: "Creative Mobile Technologies, LLC",
    2: "VeriFone Inc.",
    4: "Unknown Vendor",
}
# Token standing in for NULL inside a surrogate key, and the separator.
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"
# --------------------------------------------------------------------------


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: ColumnOrName) -> Column:
    """Stable text rendering used inside hashes.

    Strings, integers, decimals, dates and timestamps render the same in
    Spark and in SQL warehouses; doubles do not (``1.0E10``), so callers
    should pass money/distances as decimals.
    """
    return _c(c).cast("string")


def row_id(*cols: ColumnOrName, sep: str = "") -> Column:
    """MD5 row id over fields concatenated *without* separator by default
    (NULL -> empty string), as the monthly ELT flows build ``unique_row_id``.
    ``("ab","c")`` and ``("a","bc")`` therefore collide unless ``sep`` is set."""
    parts = [F.coalesce(as_text(c), F.lit("")) for c in cols]
    return F.md5(F.concat_ws(sep, *parts))


def surrogate_key(*cols: ColumnOrName) -> Column:
    """MD5 over ``'-'``-joined text fields with a NULL token."""
    parts = [F.coalesce(as_text(c), F.lit(SURROGATE_NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def _label(c: ColumnOrName, labels: dict, default) -> Column:
    c = _c(c)
    expr = None
    for code, name in labels.items():
        expr = F.when(c == code, F.lit(name)) if expr is None else expr.when(c == code, F.lit(name))
    return expr.otherwise(F.lit(default))


def payment_description(c: ColumnOrName) -> Column:
    return _label(c, PAYMENT_LABELS, PAYMENT_DEFAULT)


def vendor_name(c: ColumnOrName) -> Column:
    return _label(c, VENDOR_LABELS, None).cast("string")


def cents_to_dollars(c: ColumnOrName, precision: int = 16, scale: int = 2) -> Column:
    """``(x / 100)`` as ``decimal(16,2)``; exact when ``x`` is decimal."""
    return (_c(c) / F.lit(100)).cast(T.DecimalType(precision, scale))


# Time arithmetic never goes through the session time zone: differences of
# two timestamps of the same type are taken with timestampdiff (exact for
# naive and zoned values alike), and a naive timestamp's epoch is its wall
# clock read as UTC.
def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def micros_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Elapsed microseconds (both sides of the same timestamp type)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def _micro_of_second(c: ColumnOrName) -> Column:
    """Microseconds within the second (zone offsets are whole seconds)."""
    sec = F.extract(F.lit("SECOND"), _c(c))
    return ((sec - F.floor(sec)) * 1_000_000).cast("long")


def seconds_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole-second boundaries crossed from start to end (``date_diff('second')``):
    00:00:00.9 -> 00:00:02.1 is 2, not the truncated elapsed 1."""
    us = micros_between(start, end) + _micro_of_second(start) - _micro_of_second(end)
    return (us / F.lit(1_000_000)).cast("long")


def minutes_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    return (seconds_between(start, end) / F.lit(60)).cast("decimal(18,4)")


def hours_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Elapsed hours (fractional) between two timestamps."""
    return (micros_between(start, end).cast("decimal(20,0)") / F.lit(3_600_000_000)).cast("decimal(18,4)")


def naive_epoch_micros(c: ColumnOrName) -> Column:
    """Epoch microseconds of a TIMESTAMP_NTZ value, its wall clock read as UTC."""
    return F.timestamp_diff("MICROSECOND", epoch_ntz(), _c(c))


def naive_to_instant(c: ColumnOrName) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP at the same UTC wall clock (zone-free)."""
    return F.timestamp_micros(naive_epoch_micros(c))


def instant_to_naive(c: ColumnOrName) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ holding its UTC wall clock (zone-free)."""
    return epoch_ntz() + F.make_dt_interval(secs=(F.unix_micros(_c(c)).cast("decimal(20,0)") / 1_000_000)
                                          .cast("decimal(18,6)"))


def is_valid_trip(pickup: ColumnOrName, dropoff: ColumnOrName, distance: ColumnOrName) -> Column:
    """False on missing times, non-positive duration or non-positive distance."""
    p, d = _c(pickup), _c(dropoff)
    return (F.when(p.isNull() | d.isNull(), F.lit(False))
            .when(seconds_between(p, d) <= 0, F.lit(False))
            .when(F.coalesce(_c(distance), F.lit(0)) <= 0, F.lit(False))
            .otherwise(F.lit(True)))


def month_start(c: ColumnOrName) -> Column:
    """First day of the month as DATE."""
    return F.trunc(_c(c).cast("date"), "MM")


def year_in(c: ColumnOrName, years) -> Column:
    """``year(c) IN (years)`` written as half-open timestamp ranges (adjacent
    years merged) so the predicate reaches the Parquet scan."""
    import datetime as _dt
    ys = sorted(set(int(y) for y in years))
    runs: list[list[int]] = []
    for y in ys:
        if runs and y == runs[-1][1] + 1:
            runs[-1][1] = y
        else:
            runs.append([y, y])
    col = _c(c)
    cond = None
    for lo, hi in runs:
        r = (col >= F.lit(_dt.datetime(lo, 1, 1))) & (col < F.lit(_dt.datetime(hi + 1, 1, 1)))
        cond = r if cond is None else cond | r
    return cond if cond is not None else F.lit(False)


def to_epoch_millis(c: ColumnOrName, naive: bool = True) -> Column:
    """Timestamp -> epoch milliseconds, flooring sub-ms.  A naive timestamp's
    wall clock is read as UTC; ``naive=False`` for TIMESTAMP columns."""
    if naive:
        return F.floor(naive_epoch_micros(c) / 1000).cast("long")
    return F.unix_millis(_c(c))


def from_epoch_millis(c: ColumnOrName, naive: bool = True) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ at the UTC wall clock (or a
    TIMESTAMP instant with ``naive=False``)."""
    inst = F.timestamp_millis(_c(c))
    return instant_to_naive(inst) if naive else inst


def parse_timestamp(c: ColumnOrName, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text -> TIMESTAMP_NTZ by pattern (no time zone involved)."""
    return F.to_timestamp_ntz(_c(c), F.lit(fmt))


def concat_skip_null(*cols: ColumnOrName, sep: str = "") -> Column:
    """String concatenation that skips NULL parts (Spark ``concat`` would
    return NULL; warehouses' ``||``/``concat`` skip it)."""
    return F.concat_ws(sep, *[_c(c) for c in cols])


def period_name(service: ColumnOrName, ts: ColumnOrName) -> Column:
    """``<service>_tripdata_<yyyy>-<MM>``: the monthly file name stem."""
    return F.concat(F.lower(_c(service)), F.lit("_tripdata_"), F.date_format(_c(ts), "yyyy-MM"))


# Full microsecond precision in JSON text (Spark's default drops below ms).
JSON_TS_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                   "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def to_json_text(cols: Iterable[ColumnOrName]) -> Column:
    """Row -> JSON message text (timestamps keep microseconds)."""
    return F.to_json(F.struct(*[_c(c) for c in cols]), JSON_TS_OPTIONS)


def from_json_text(c: ColumnOrName, schema: T.StructType | str) -> Column:
    """JSON message text -> typed struct (declared schema, no inference)."""
    return F.from_json(_c(c), schema, JSON_TS_OPTIONS)


_SNAKE_1 = re.compile(r"(.)([A-Z][a-z]+)")
_SNAKE_2 = re.compile(r"([a-z0-9])([A-Z])")


def snake_case(name: str) -> str:
    """``PULocationID`` -> ``pu_location_id``, ``VendorID`` -> ``vendor_id``."""
    s = _SNAKE_1.sub(r"\1_\2", name)
    s = _SNAKE_2.sub(r"\1_\2", s)
    return s.replace("__", "_").lower()
