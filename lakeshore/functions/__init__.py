"""Column-expression helpers (JVM-side built-ins only, no Python UDFs in the hot path)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums of doubles depend on the order of addition in their last bits.  A value with at most
# six decimals and below 2^53 millionths (all money and distances) is summed as a whole number
# of millionths, which is the same in any order, stays in primitive aggregation buffers and is
# turned into a double once per group.  A group with any other value (more decimals, larger,
# NaN, infinite), or whose total leaves 64 bits, is summed as plain doubles, so no digit and
# no job is ever lost.
MILLION = "1000000D"
MOST_MILLIONTHS = (1 << 53) - 1


def _column(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _millionths_sql(column: str) -> str:
    return f"TRY_CAST(RINT({column} * {MILLION}) AS BIGINT)"


def millionths(col: str | Column) -> Column:
    """The value in whole millionths; NULL where it is none (NaN, infinite, too large)."""
    return F.rint(_column(col) * F.lit(1e6)).try_cast("bigint")


def is_lossy(col: str | Column) -> Column:
    """Whether a non-NULL value is changed by :func:`millionths`."""
    n = millionths(col)
    held = n.between(-MOST_MILLIONTHS, MOST_MILLIONTHS) & (n / F.lit(1e6) == _column(col))
    return _column(col).isNotNull() & ~F.coalesce(held, F.lit(False))


def choose_sum(total: Column, lossy: Column, plain: Column) -> Column:
    """The total of millionths as a double, unless a value was lossy or the total overflowed."""
    return F.coalesce(F.when(lossy == 0, (total * F.lit(Decimal("0.000001"))).cast("double")), plain)


def exact_sum(col: str | Column) -> Column:
    """Sum of a double column as DOUBLE, independent of the order where the values allow."""
    return choose_sum(F.try_sum(millionths(col)), F.count_if(is_lossy(col)), F.sum(_column(col)))


def exact_sum_sql(column: str) -> str:
    """:func:`exact_sum` as the SQL text that the query files hold."""
    n = _millionths_sql(column)
    held = f"{n} BETWEEN -{MOST_MILLIONTHS} AND {MOST_MILLIONTHS} AND {n} / {MILLION} = {column}"
    return (f"COALESCE(CASE WHEN COUNT_IF({column} IS NOT NULL AND NOT COALESCE({held}, FALSE)) = 0 "
            f"THEN CAST(TRY_SUM({n}) * 0.000001BD AS DOUBLE) END, SUM({column}))")


def exact_avg(col: str | Column) -> Column:
    """Average = exact sum / count of non-NULL values (NULL for an empty group)."""
    return F.try_divide(exact_sum(col), F.count(_column(col)).cast("double"))


def round_half_up(col: str | Column, scale: int) -> Column:
    """Round to ``scale`` decimals, half away from zero, on the decimal value.

    Going through DECIMAL(38,9) first absorbs binary noise (12.3454999999 vs 12.3455000001
    from two interpolation formulas round the same way), so the result does not depend on
    the engine's double arithmetic.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast("decimal(38,9)"), scale).cast("double")
