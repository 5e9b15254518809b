"""Column -> Column helpers. Built-in expressions only, so everything stays in
whole-stage codegen; no Python UDF anywhere in the library.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.config import UNKNOWN_LABEL

# Money is exact inside the engine: prices parse to PRICE, line amounts are
# rounded to cents (AMOUNT), sums stay decimal, and only the final projection
# turns a money column into a double. A price that is a finite number but has
# no exact place in PRICE raises; it is never dropped or rounded.
PRICE = "decimal(27,10)"
AMOUNT = "decimal(18,2)"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: str | Column) -> Column:
    """Strip leading/trailing spaces (Spark ``trim`` strips only U+0020)."""
    return F.trim(col_(c))


def clean_label(c: str | Column) -> Column:
    """Trimmed text -> lower case; NULL or empty -> 'unknown'."""
    t = F.trim(col_(c))
    return F.when(t.isNull() | (t == F.lit("")), F.lit(UNKNOWN_LABEL)).otherwise(F.lower(t))


def _whole(c: str | Column, kind: str) -> Column:
    """Text -> integer as a non-ANSI cast takes it: an optional sign and digits,
    of a fraction only the part before the point ('.' is 0); other text
    (exponents too) and numbers out of range -> NULL. Plain integers take one
    strict cast; only what that rejects is looked at by pattern."""
    t = F.trim(col_(c))
    before = F.substring_index(t, ".", 1)
    cut = F.coalesce(before.try_cast(kind), F.when(~before.rlike("[0-9]"), F.lit(0).cast(kind)))
    return F.coalesce(t.try_cast(kind), F.when(t.rlike(r"^[\x00-\x20]*[+-]?[0-9]*[.][0-9]*[\x00-\x20]*$"), cut))


def safe_int(c: str | Column) -> Column:
    """Tolerant text -> int ('2.7' -> 2, '1e3' -> NULL)."""
    return _whole(c, "int")


def safe_long(c: str | Column) -> Column:
    return _whole(c, "bigint")


def safe_bool(c: str | Column) -> Column:
    return col_(c).try_cast("boolean")


def safe_price(c: str | Column) -> Column:
    """Tolerant text -> exact price. Text that is no finite double -> NULL; a
    float suffix ('5d', '5f') is part of a number, as in a cast to double.
    What PRICE cannot hold (over 17 digits before the point) raises under ANSI;
    digits after the tenth behind the point are rounded. Plain numbers take two
    strict casts; only a finite number that PRICE rejects has its suffix cut, or
    is a hexadecimal one."""
    t = F.trim(col_(c))
    value = t.try_cast("double")
    finite = F.abs(value) < F.lit(float("inf"))  # NaN is above every number
    other = F.when(t.rlike("[xX]"), value.cast(PRICE)).otherwise(F.regexp_replace(t, "[dDfF]$", "").cast(PRICE))
    return F.when(finite, F.coalesce(t.try_cast(PRICE), other))


def safe_date(c: str | Column) -> Column:
    return col_(c).try_cast("date")


def safe_timestamp(c: str | Column) -> Column:
    """Text -> timestamp with the default parser; malformed -> NULL."""
    return F.try_to_timestamp(col_(c))


def line_amount(price: str | Column, qty: str | Column) -> Column:
    """round(price * quantity, 2), HALF_UP, exact decimal; too large an amount raises."""
    return F.round(col_(price) * col_(qty), 2).cast(AMOUNT)


def money_round(c: str | Column) -> Column:
    return F.round(col_(c), 2)


def to_double(c: str | Column) -> Column:
    """Boundary conversion for money columns (exact decimal -> double)."""
    return col_(c).cast("double")


def money_to_double(df, money_cols):
    """Select every column of ``df`` in order, money columns cast to double."""
    return df.select(*[to_double(c).alias(c) if c in money_cols else F.col(c) for c in df.columns])


def bool_label(c: str | Column, true_label: str, false_label: str) -> Column:
    """NULL and false both map to ``false_label``."""
    return F.when(col_(c) == F.lit(True), F.lit(true_label)).otherwise(F.lit(false_label))


def pct_change(current: str | Column, previous: str | Column) -> Column:
    """round((current - previous) / previous * 100, 2); NULL when previous is 0.

    Computed as ((current - previous) * 100) / previous in decimal so the
    half-up rounding is exact. The zero guard is needed under ANSI too.
    """
    cur, prev = col_(current), col_(previous)
    return F.when(prev == 0, F.lit(None)).otherwise(F.round((cur - prev) * 100 / prev, 2))


def year_month_key(d: str | Column) -> Column:
    """'YYYY-MM' from a date."""
    d = col_(d)
    return F.concat(F.year(d).cast("string"), F.lit("-"), F.lpad(F.month(d).cast("string"), 2, "0"))


def year_week_key(d: str | Column, iso_year: bool = False) -> Column:
    """'YYYY-Www': calendar year joined to ISO week (source behaviour:
    2021-01-01 -> '2021-W53'); ``iso_year=True`` uses the ISO week-year."""
    d = col_(d)
    y = F.extract(F.lit("YEAROFWEEK"), d) if iso_year else F.year(d)
    return F.concat(y.cast("string"), F.lit("-W"), F.lpad(F.weekofyear(d).cast("string"), 2, "0"))
