"""Row generation from array columns.

Spark infers ``size(array) > 0`` for a plain ``explode`` and pushes it below the
projections that build the array, re-evaluating (and, for chained array steps,
multiplying) them in the filter.  ``posexplode_outer`` gets no inferred filter;
the empty-array row it emits is removed by a filter on the generated position,
which cannot move below the generator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_with_pos(df: DataFrame, keep: list, array: Column | str, pos: str = "pos",
                     value: str = "value") -> DataFrame:
    """(keep..., pos, value) for every element; no row for an empty or NULL array."""
    arr = F.col(array) if isinstance(array, str) else array
    out = df.select(*keep, F.posexplode_outer(arr).alias(pos, value))
    return out.where(F.col(pos).isNotNull())
