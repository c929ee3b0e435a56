"""Share of a group total, as a window over the group.

The frames this is used on hold one row per group and code (or category) after
aggregation, so a window partition is as small as the list of codes. Where nobody reads
the share, Catalyst prunes the window; a join with the totals could not be dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ampere.functions.casts import safe_divide


def share_of_total(df: DataFrame, groups: Sequence[str], value: str, share_col: str) -> DataFrame:
    total = F.sum(value).over(Window.partitionBy(*groups))
    return df.withColumn(share_col, safe_divide(F.col(value), total))
