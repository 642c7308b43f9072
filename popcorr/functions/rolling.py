"""Null-safe rolling Pearson correlation over a ROWS frame.

``corr(x, y).over(w)`` raises DIVIDE_BY_ZERO under ANSI mode on a flat
window, and wrapping it in ``when`` does not stop the eager evaluation.  We
therefore build r from ``covar_pop`` and ``stddev_pop`` and divide with
``try_divide``; a window in which x or y does not vary (or that has fewer
than two complete pairs) yields NULL - exactly "r undefined".

All aggregates share one window spec, so Catalyst plans a single exchange and
a single sort for any number of correlations over the same frame.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

# The frame is 7 *rows* (trading days), not 7 calendar days.
ROLLING_ROWS = 7


def rows_window(partition_cols, order_cols, rows: int = ROLLING_ROWS) -> WindowSpec:
    return (Window.partitionBy(*partition_cols).orderBy(*order_cols)
            .rowsBetween(-(rows - 1), Window.currentRow))


def rolling_pearson(x, y, w: WindowSpec, digits: int = 6) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    both = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    xx = F.when(both, x.cast("double"))
    yy = F.when(both, y.cast("double"))
    varies = ((F.min(xx).over(w) < F.max(xx).over(w))
              & (F.min(yy).over(w) < F.max(yy).over(w)))
    r = F.try_divide(F.covar_pop(xx, yy).over(w),
                     F.stddev_pop(xx).over(w) * F.stddev_pop(yy).over(w))
    return F.round(F.when(varies, r), digits)
