"""Numbers: division and interval text under the rule that blank isn't zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def divide(a: Column, b: Column) -> Column:
    """Null if either is null or the divisor is 0."""
    return F.try_divide(a, b)


def log_relative(now: Column, before: Column) -> Column:
    """Null if a price is null, zero or below."""
    return F.log(F.try_divide(now.cast("double"), before.cast("double")))


def interval_text(low: Column, high: Column) -> Column:
    """``+1.00% a +2.00%`` of two index levels on base 100; null if either is."""
    text = F.format_string("%+.2f%% a %+.2f%%", low - 100, high - 100)
    return F.when(low.isNotNull() & high.isNotNull(), text)
