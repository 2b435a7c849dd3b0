"""Statistics over a window."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def corr_over(x: Column, y: Column, window: WindowSpec) -> Column:
    """Pearson correlation over ``window``; NULL where it is undefined.

    ``corr`` divides by zero on a constant side, which ANSI mode raises. A pair
    with a NULL member counts on neither side.
    """
    px = F.when(y.isNotNull(), x)
    py = F.when(x.isNotNull(), y)
    spread = F.stddev_pop(px).over(window) * F.stddev_pop(py).over(window)
    return F.try_divide(F.covar_pop(px, py).over(window), spread)
