"""Scalar column helpers shared by the cleaners and the reports.

Everything here returns a ``pyspark.sql.Column`` built from built-in
functions, so it stays inside whole-stage codegen (no Python on the data
path).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, DoubleType, IntegerType

# Money is *summed* as decimal: each double enters as its shortest decimal
# form (the form Spark's own ``round(double)`` works on) and the sum is exact.
# An exact sum does not depend on the order in which partitions and partial
# aggregates are combined, so a total (and the cent it rounds to) is the
# same under any partitioning, and a multi-level aggregate equals a
# single-level one.  18 decimal places keep every digit of a shortest form
# for amounts below 10^20.
MONEY_SUM_TYPE = DecimalType(38, 18)


def round2(c: Column | str) -> Column:
    """``round(x, 2)`` HALF_UP, as double.

    On a double this is Spark's rounding of the value's shortest decimal
    form (``3.0149999999999997`` -> 3.01, ``1.005`` -> 1.01; NaN stays NaN);
    on an exact decimal sum it is plain decimal rounding."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 2).cast(DoubleType())


def money_sum(c: Column | str) -> Column:
    """Aggregate: the exact (order-independent) sum of a money column.

    A struct, so that sums of sums (``money_total``) stay exact: the decimal
    sum, the plain double sum, and whether the decimal one is incomplete (a
    value is NaN, infinite or 10^20 and more, or the sum overflows).  Read it
    with ``money_value``, ``money_round`` or ``money_mean``."""
    c = F.col(c) if isinstance(c, str) else c
    exact = c.try_cast(MONEY_SUM_TYPE)
    return _money(F.try_sum(exact), F.sum(c.cast(DoubleType())), F.max(c.isNotNull() & exact.isNull()))


def money_total(c: Column | str) -> Column:
    """Aggregate: the sum of ``money_sum`` structs."""
    c = F.col(c) if isinstance(c, str) else c
    return _money(F.try_sum(c["exact"]), F.sum(c["plain"]), F.max(c["inexact"]))


def _money(exact: Column, plain: Column, inexact: Column) -> Column:
    return F.struct(exact.alias("exact"), plain.alias("plain"), (inexact | (exact.isNull() & plain.isNotNull())).alias("inexact"))


def money_value(total: Column | str) -> Column:
    """The sum as a double: the plain double sum (NaN and infinity included)
    where no exact one exists, NULL without values."""
    total = F.col(total) if isinstance(total, str) else total
    return F.when(total["inexact"], total["plain"]).otherwise(total["exact"].cast(DoubleType()))


def money_round(total: Column | str) -> Column:
    """The sum rounded to cents."""
    total = F.col(total) if isinstance(total, str) else total
    return F.when(total["inexact"], round2(total["plain"])).otherwise(round2(total["exact"]))


def money_mean(total: Column | str, n: Column | str) -> Column:
    """The mean of a money sum over the count of its non-NULL values, rounded
    to cents: of the exact sum in decimal (the HALF_UP cent of the true mean, no
    binary division noise), else of the plain one; NULL when the count is 0."""
    total = F.col(total) if isinstance(total, str) else total
    n = F.col(n) if isinstance(n, str) else n
    return F.when(total["inexact"], round2(F.try_divide(total["plain"], n))).otherwise(round2(F.try_divide(total["exact"], n)))


def pct(part: Column | str, whole: Column | str) -> Column:
    """``round2(part / whole * 100)``; NULL when ``whole`` is 0 or NULL."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return round2(F.try_divide(part, whole) * F.lit(100))


def ratio2(num: Column | str, den: Column | str) -> Column:
    """``round2(num / den)``; NULL when ``den`` is 0 or NULL."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return round2(F.try_divide(num, den))


def growth_pct(cur: Column | str, prev: Column | str) -> Column:
    """Percent change from ``prev`` to ``cur``; NULL unless ``prev`` > 0."""
    cur = F.col(cur) if isinstance(cur, str) else cur
    prev = F.col(prev) if isinstance(prev, str) else prev
    return F.when(prev.isNotNull() & (prev > 0), round2((cur - prev) / prev * F.lit(100)))


def to_double(c: Column | str) -> Column:
    """Lenient numeric parse: text or number to double, bad text to NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast(DoubleType())


def to_int(c: Column | str) -> Column:
    """Lenient integer parse: ``'3.7'`` -> 3 (truncation), bad text or
    out-of-int-range values -> NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast(DoubleType()).try_cast(IntegerType())


def to_day(c: Column | str) -> Column:
    """Timestamp, timestamp text or date text to DATE; bad text to NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast(DateType())


def clean_text(c: Column | str) -> Column:
    """Trim leading/trailing spaces (tabs and newlines are kept)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(c)


def clean_code(c: Column | str) -> Column:
    """Trim and lower-case: e-mails and status codes."""
    return F.lower(clean_text(c))


def parse_run_date(value: str | _dt.date) -> _dt.date:
    """Validate a ``yyyyMMdd`` run date; fail fast instead of a NULL batch tag."""
    if isinstance(value, _dt.date):
        return value
    text = str(value).strip()
    if len(text) != 8 or not text.isdigit():
        raise ValueError(f"run date must be yyyyMMdd, got {value!r}")
    return _dt.datetime.strptime(text, "%Y%m%d").date()


def run_date_lit(value: str | _dt.date) -> Column:
    """The batch tag ``ingestion_date`` as a DATE literal (constant-folded)."""
    return F.lit(parse_run_date(value)).cast(DateType())


def months_between_periods(y1: Column, m1: Column, y0: Column, m0: Column) -> Column:
    """Whole calendar months from (y0, m0) to (y1, m1)."""
    return (y1 - y0) * F.lit(12) + (m1 - m0)
