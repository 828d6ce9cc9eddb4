"""Conversion funnel from per-type totals (not per-visitor paths)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.operators.live import DEFAULT_TYPES

# Names of the three rates of the default funnel.
DEFAULT_RATE_NAMES = ("view_to_cart", "cart_to_tx", "overall")


def safe_pct(num: Column, den: Column) -> Column:
    """``num / den * 100`` as double, 0.0 when ``den`` is not positive."""
    return F.when(den > 0, num.cast("double") / den.cast("double") * F.lit(100.0)).otherwise(F.lit(0.0))


def funnel(
    totals: DataFrame,
    count_col: str = "event_count",
    stages: Sequence[str] = DEFAULT_TYPES,
    rate_names: Sequence[str] = DEFAULT_RATE_NAMES,
) -> DataFrame:
    """One row: ``<stage>_count`` per stage (0 when absent) and three rates:
    stage1/stage0, stage2/stage1, stage2/stage0 in percent.  A rate may exceed 100.

    ``totals`` is any table of ``(event, count_col)``: the window metric, the event
    distribution, or raw rows with a count column of 1.  One pass, one global
    aggregation with partial aggregation before the final step.
    """
    if len(stages) != 3 or len(rate_names) != 3:
        raise ValueError("funnel takes three stages and three rate names")
    counts = totals.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("event") == F.lit(s), F.col(count_col))), F.lit(0))
            .cast("long")
            .alias(f"{s}_count")
            for s in stages
        ]
    )
    a, b, c = (F.col(f"{s}_count") for s in stages)
    return counts.select(
        "*",
        safe_pct(b, a).alias(rate_names[0]),
        safe_pct(c, b).alias(rate_names[1]),
        safe_pct(c, a).alias(rate_names[2]),
    )
