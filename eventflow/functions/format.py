"""Text forms of metrics for display.  Labels only; results keep the numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def thousands(c: Column | str) -> Column:
    """``2756101`` -> ``2,756,101``."""
    return F.format_number(F.col(c) if isinstance(c, str) else c, 0)


def percent_label(c: Column | str) -> Column:
    """``2.6022`` -> ``2.60 %`` (half-up rounding of the JVM formatter)."""
    return F.format_string("%.2f %%", F.col(c) if isinstance(c, str) else c)
