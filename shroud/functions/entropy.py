"""Shannon entropy as one aggregate over a (value, count) table."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from shroud.functions.columns import col_of


def entropy_agg(count: str | Column, base: float = 2.0) -> Column:
    """Aggregate expression: entropy of the distribution given by ``count``.

    Closed form ``log(T) - sum(c log c) / T`` so a grouped table needs one
    aggregate (partial aggregation applies).  Empty input gives 0.0; tiny
    negative float noise (single value) is clipped to 0.
    """
    c = col_of(count).cast("double")
    total = F.sum(c)
    nats = F.log(total) - F.sum(c * F.log(c)) / total
    bits = nats / F.lit(math.log(base))
    return F.greatest(F.coalesce(bits, F.lit(0.0)), F.lit(0.0))
