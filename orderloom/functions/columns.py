"""Column functions used by the batch pipeline.

Everything here returns a ``Column`` built from built-in Spark SQL
functions, so it stays inside whole-stage codegen. No Python UDFs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Canonical labels of the reference (case-folded lookup,
# anything else becomes "Unknown").
SEGMENTS = ("Consumer", "Corporate", "Small Business")
REGIONS = ("North", "South", "East", "West", "Central")
CHANNELS = ("Web", "Mobile App", "Marketplace")
UNKNOWN = "Unknown"

# Statuses that count as realized revenue, and the return status.
REALIZED_STATUSES = ("Delivered", "Shipped")
RETURNED_STATUS = "Returned"

_MAX_LEN = 2147483647
_EXACT_CENTS = float(2**53)  # whole numbers below it are exact in a DOUBLE


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: str | Column) -> Column:
    return F.trim(col_(c))


def blank_to_null(c: str | Column) -> Column:
    """``NULLIF(trim(c), '')``."""
    return F.nullif(F.trim(col_(c)), F.lit(""))


def canonicalize(c: str | Column, labels: Iterable[str], default: str = UNKNOWN) -> Column:
    """Case- and space-insensitive lookup into ``labels``; NULL and misses -> ``default``."""
    key = F.lower(F.trim(col_(c)))
    expr = None
    for label in labels:
        hit = key == F.lit(label.lower())
        expr = F.when(hit, F.lit(label)) if expr is None else expr.when(hit, F.lit(label))
    return expr.otherwise(F.lit(default))


def sentence_case(c: str | Column) -> Column:
    """Upper-case the first character and lower-case the rest (not initcap)."""
    t = F.trim(col_(c))
    return F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, _MAX_LEN)))


# Spark's text-to-number cast trims every ASCII control character at the
# edges; the reference engine trims only space, \t, \n, \v, \f and \r.
_CONTROL_EDGE = r"^[\x00-\x08\x0e-\x1f]|[\x00-\x08\x0e-\x1f]$"


# Spark reads a Java float suffix ('10d', '1e5f') as a number; the reference's engine does not.
_FLOAT_SUFFIX = r"[0-9.][dDfF]\s*$"
# ... and that engine reads '1_000' as 1000
_DIGIT_GROUPS = r"(?<=[0-9])_(?=[0-9])"
_HEX = r"^\s*0[xX][0-9a-fA-F]{1,8}\s*$"
# Texts that none of these rules touches: one test tells them, the other tests are for the rest.
_PLAIN_NUMBER = r"^-?[0-9]+(\.[0-9]+)?$"
_PLAIN_INTEGER = r"^-?[0-9]{1,9}$"


def try_double(c: str | Column) -> Column:
    s = col_(c)
    plain = F.regexp_replace(s, _DIGIT_GROUPS, "")
    other = F.when(~s.rlike(_CONTROL_EDGE) & ~s.rlike(_FLOAT_SUFFIX), plain.try_cast("double"))
    return F.when(s.rlike(_PLAIN_NUMBER), s.try_cast("double")).otherwise(other)


def try_integer(c: str | Column) -> Column:
    """Text to INT the tolerant way: '3.7' -> 4, '1e2' -> 100, junk -> NULL.

    A plain ``try_cast(x AS INT)`` refuses decimals; going through DOUBLE and
    rounding half away from zero accepts the same texts the reference does.
    """
    s = col_(c)
    hexadecimal = F.conv(F.substring(F.trim(s), 3, 8), 16, 10).try_cast("int")
    other = F.when(s.rlike(_HEX), hexadecimal).otherwise(F.round(try_double(c)).try_cast("int"))
    return F.when(s.rlike(_PLAIN_INTEGER), s.try_cast("int")).otherwise(other)


# A timestamp text is a full date (a bare year such as '2024' is none), alone or with at
# least hours and minutes behind one space or T; '/' may stand for '-' in the date.
_TIMESTAMP = r"^\s*(\d{4})([-/])(\d{1,2})\2(\d{1,2})(?:$|[ T]\d{1,2}:\d{1,2}.*$)"
_DATE = r"^(\s*\d{4})/(\d{1,2})/(\d{1,2})"
_MIDNIGHT = r"[ T]24:00(:00(\.0+)?)?\s*$"
# the usual form, which needs no rewriting
_PLAIN_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}(?: (?:[01]\d|2[0-3]):\d{2}:\d{2})?$"


def try_timestamp(c: str | Column) -> Column:
    s = col_(c)
    dashed = F.regexp_replace(s, _DATE, "$1-$2-$3")
    next_day = F.date_add(F.regexp_replace(dashed, _MIDNIGHT, "").try_cast("date"), 1).try_cast("timestamp_ntz")
    read = F.when(dashed.rlike(_MIDNIGHT), next_day).otherwise(dashed.try_cast("timestamp_ntz"))
    return F.when(s.rlike(_PLAIN_TIMESTAMP), s.try_cast("timestamp_ntz")).when(s.rlike(_TIMESTAMP), read)


def money_round(c: str | Column) -> Column:
    """Round a DOUBLE to cents as ``round(x * 100) / 100``.

    Spark's ``round(x, 2)`` rounds the decimal text of x (1.005 -> 1.01);
    scaling first rounds the binary value (1.005 -> 1.0), which is what the
    reference's engine does.
    """
    return F.round(col_(c) * F.lit(100.0)) / F.lit(100.0)


def exact_sum(c: str | Column) -> Column:
    """SUM of cent amounts, exact and independent of row order.

    Each value is already rounded to cents, so it is summed as a BIGINT count
    of cents (exact, and a fixed-width hash-aggregate buffer, unlike a wide
    DECIMAL); cents / 100.0 is the DOUBLE nearest the exact total, the same
    value a DECIMAL sum cast to DOUBLE gives. Amounts too large to be exact
    in cents, infinities and NaN are summed as DOUBLEs beside them, so none is
    left out; a BIGINT sum that overflows is an error under ANSI rules.
    """
    cents = col_(c) * F.lit(100.0)
    exact = F.abs(cents) < F.lit(_EXACT_CENTS)  # false for NaN, which sorts above every number
    small = F.sum(F.when(exact, F.round(cents)).cast("bigint")) / F.lit(100.0)
    large = F.sum(F.when(~exact, col_(c)))
    return F.when(large.isNull(), small).otherwise(F.coalesce(small, F.lit(0.0)) + large)


def realized(status: str | Column = "order_status") -> Column:
    return col_(status).isin(*REALIZED_STATUSES)


def realized_amount(amount: str | Column = "net_revenue", status: str | Column = "order_status") -> Column:
    """``CASE WHEN status IN (realized) THEN amount ELSE 0 END``."""
    return F.when(realized(status), col_(amount)).otherwise(F.lit(0.0))


def realized_revenue() -> Column:
    return exact_sum(realized_amount())


def percent(part: Column, whole: Column) -> Column:
    """``100.0 * part / NULLIF(whole, 0)`` in DOUBLE."""
    return F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def return_rate(status: str | Column = "order_status") -> Column:
    """Percent of lines that were returned (per line, not per order)."""
    return percent(F.count_if(col_(status) == F.lit(RETURNED_STATUS)), F.count(F.lit(1)))


def date_key(ts: str | Column) -> Column:
    """yyyyMMdd as INT."""
    return F.date_format(col_(ts), "yyyyMMdd").cast("int")


def month_start(ts: str | Column) -> Column:
    return F.trunc(F.to_date(col_(ts)), "month")
