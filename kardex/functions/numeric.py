"""Numeric column helpers.

Money is carried as DECIMAL(18,4) so that sums are exact and rounding of a sum is exact
half-away-from-zero, as in the reference's SQL engine. Ratios and averages are DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
RATE = "decimal(12,6)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_double(col, scale: int) -> Column:
    """ROUND(x, n) for DOUBLE with the reference engine's rule: round(x * 10^n) / 10^n.

    Spark's own ``round`` rounds the decimal text of the double (``round(1.005, 2) = 1.01``);
    scaling first makes both engines agree (``1.005 -> 1.0``, ``2.675 -> 2.68``).
    """
    f = float(10 ** scale)
    return F.round(_c(col).cast("double") * F.lit(f), 0) / F.lit(f)


def round_money(col, scale: int = 2) -> Column:
    """Exact half-away rounding of a DECIMAL value, returned as DOUBLE."""
    return F.round(_c(col), scale).cast("double")


def safe_div(num, den) -> Column:
    """num / NULLIF(den, 0) in DOUBLE; null instead of an ANSI divide-by-zero error."""
    d = _c(den).cast("double")
    return _c(num).cast("double") / F.when(d != 0, d)


def parse_count(col) -> Column:
    """Dirty text -> BIGINT: numbers are truncated ('3.7' -> 3), junk and null become 0."""
    return F.coalesce(F.expr("try_cast(try_cast({} as double) as bigint)".format(_sql_ref(col))), F.lit(0).cast("bigint"))


def _sql_ref(col) -> str:
    if isinstance(col, str):
        return "`" + col.replace("`", "``") + "`"
    raise TypeError("parse_count takes a column name")


def signed_by_type(amount, type_col, negative_type: str = "E") -> Column:
    """Sign flip by document type: credit notes subtract."""
    return F.when(_c(type_col) == negative_type, -_c(amount)).otherwise(_c(amount))
