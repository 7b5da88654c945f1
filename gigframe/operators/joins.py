"""Join helpers with an explicit size discipline.

Tables of fixed size (a lookup list, a one-row total, a top-N list) are broadcast
directly: their size does not grow with the data. Everything else is left to the
planner: AQE turns a sort-merge join into a broadcast join only when the measured
shuffle size is below ``spark.sql.adaptive.autoBroadcastJoinThreshold``, and splits
skewed partitions beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fixed_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a table whose row count is bounded by construction."""
    return F.broadcast(df)
