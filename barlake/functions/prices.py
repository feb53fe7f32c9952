"""Price arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def nan_to_null(col: Column) -> Column:
    """In Spark ``NaN > x`` is true, unlike pandas; treat NaN as missing."""
    return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col)


def move_pct(close: Column, reference: Column) -> Column:
    """(close - reference) / reference * 100; a zero reference gives 0."""
    return F.when(reference == 0, F.lit(0.0)).otherwise(
        (close - reference) / reference * F.lit(100.0)
    )


def should_alert(close: Column, reference: Column, threshold_pct: float) -> Column:
    """Alert when a reference exists and the absolute move is strictly above the threshold."""
    return reference.isNotNull() & (F.abs(move_pct(close, reference)) > F.lit(float(threshold_pct)))


def simple_return(close: Column, previous_close: Column) -> Column:
    """close / previous - 1; null when either side is missing or previous is 0."""
    return F.try_divide(close, previous_close) - F.lit(1.0)



# Sums of prices are exact, so they do not depend on the order in which partial
# sums meet (tasks, frames, engines). A double's shortest decimal form fits
# DECIMAL(38, 18) up to 1e20 and is taken to 18 places behind the point. Where a
# value or a sum does not fit, the mean is the plain double average.
EXACT_PRICE = "decimal(38,18)"


def exact_mean(col: Column, over: WindowSpec | None = None) -> Column:
    """Mean of the non-null values, as an aggregate or over a window frame.

    The exact sum divided by the count; null when there are no values.
    """
    digits = col.try_cast(EXACT_PRICE)
    parts = [F.try_sum(digits), F.count(digits), F.count(col), F.avg(col)]
    if over is not None:
        parts = [p.over(over) for p in parts]
    total, fitting, n, plain = parts
    exact = F.try_divide(total.cast("double"), n.cast("double"))
    return F.when((fitting == n) & total.isNotNull(), exact).otherwise(plain)
