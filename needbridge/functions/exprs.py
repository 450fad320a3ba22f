"""Scalar building blocks.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen; no Python UDF is involved.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A date written y-m-d with '-', '/' or ' ' (same separator twice), optionally
# followed by a time of day.  Anything else is not a date.
_DATE_TEXT = r"^(\d{4})([-/ ])(\d{1,2})\2(\d{1,2})([ T]\d{1,2}:\d{2}.*)?$"


def safe_date(c: str | Column) -> Column:
    """Lenient text → DATE that agrees with the reference engine's TRY_CAST.

    Spark's own ``try_cast`` accepts '2024' and '2024-04' and rejects
    '2024/04/01'; the reference accepts the latter and rejects the former.
    So: trim, require a full y-m-d (with one repeated separator), rebuild it
    as ISO, and only then cast.  A trailing time part must be a valid time.

    Ten characters with '-' in the ISO places and a digit at the end are cast
    at once: that cast rejects what the pattern rejects.  All else is matched
    in a lambda, which keeps five pattern calls a date out of the compiled row
    loop.
    """
    s = F.trim(as_col(c))
    day_end = F.substring(s, 10, 1)
    iso = ((F.length(s) == 10) & (F.substring(s, 5, 1) == "-") & (F.substring(s, 8, 1) == "-")
           & (day_end >= "0") & (day_end <= "9"))
    return F.when(iso, s.try_cast("date")).otherwise(F.get(F.transform(F.array(s), _written_date), F.lit(0)))


def _written_date(s: Column) -> Column:
    ok = s.rlike(_DATE_TEXT)
    ymd = F.concat_ws(
        "-",
        F.regexp_extract(s, _DATE_TEXT, 1),
        F.regexp_extract(s, _DATE_TEXT, 3),
        F.regexp_extract(s, _DATE_TEXT, 4),
    )
    tod = F.regexp_extract(s, _DATE_TEXT, 5)
    with_time = F.concat(ymd, F.lit(" "), F.substring(tod, 2, 1 << 20))
    parsed = (
        F.when(tod == "", ymd.try_cast("date"))
        .otherwise(with_time.try_cast("timestamp_ntz").cast("date"))
    )
    return F.when(ok, parsed)


#: The characters that Unicode calls space separators.
SPACES = " \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000"


def trim_spaces(c: str | Column) -> Column:
    """Trim every Unicode space separator, a no-break space too; tabs and newlines stay."""
    return F.btrim(as_col(c), F.lit(SPACES))


def false_if_null(pred: Column) -> Column:
    """SQL ``CASE WHEN pred THEN TRUE ELSE FALSE END``: null counts as false."""
    return F.coalesce(pred, F.lit(False))


def flag(pred: Column) -> Column:
    return false_if_null(pred)


def allow_list(c: str | Column, allowed: Sequence[str], other: str) -> Column:
    """``CASE WHEN c NOT IN (..) THEN other ELSE c END`` (null stays null)."""
    c = as_col(c)
    return F.when(~c.isin(*allowed), F.lit(other)).otherwise(c)


def allow_list_violation(c: str | Column, allowed: Sequence[str]) -> Column:
    """True when c is outside the list; null → false."""
    return false_if_null(~as_col(c).isin(*allowed))


def row_sum_flags(cols: Iterable[str | Column]) -> Column:
    """Sum of boolean flags as 0/1; null if any flag is null (plain ``+``)."""
    total = None
    for c in cols:
        v = as_col(c).cast("int")
        total = v if total is None else total + v
    return total


def pct(n: str | Column, d: str | Column, digits: int = 2) -> Column:
    """``ROUND(n * 100.0 / NULLIF(d, 0), digits)`` as a DOUBLE.

    The quotient is formed in double precision and rounded half away from
    zero on its shortest decimal form, which is what the reference engine
    does for this expression.
    """
    n, d = as_col(n), as_col(d)
    q = (n.cast("double") * F.lit(100.0)) / F.nullif(d, F.lit(0)).cast("double")
    return F.round(q, digits)


def round_half_even(c: str | Column, digits: int = 2) -> Column:
    """Banker's rounding of a double (the dataframe-library rounding)."""
    scale = F.lit(float(10 ** digits))
    return F.rint(as_col(c).cast("double") * scale) / scale


def tier(
    numerator: str | Column,
    base: str | Column,
    tiers: Sequence[tuple[float, str]],
    default: str,
) -> Column:
    """Ordered CASE: first tier whose ``numerator >= fraction * base`` holds.

    Fractions are exact decimals, so 0.25 * 100 compares as exactly 25.
    A null numerator or base fails every branch and gets ``default``.
    """
    numerator, base = as_col(numerator), as_col(base)
    expr = None
    for frac, label in tiers:
        cond = numerator >= F.lit(Decimal(str(frac))) * base
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def padded_id(prefix: str, key: str | Column, width: int) -> Column:
    """Zero-padded surrogate id of a non-negative integer key, like ``zfill``.

    ``lpad`` alone would cut a key longer than ``width``; such keys are
    kept whole.  (Plain string functions: ``format_string`` would call
    the JVM's formatter once per row.)
    """
    s = as_col(key).cast("long").cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0")))


def age_years(dob: str | Column, as_of: str) -> Column:
    """Whole years as ``days // 365`` at an explicit as-of date."""
    return F.floor(F.datediff(F.lit(as_of).cast("date"), as_col(dob)) / F.lit(365)).cast("int")
