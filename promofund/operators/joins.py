"""Join helpers: broadcasts only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest table (bytes of its files) broadcast by ``checked_broadcast``.
MAX_BROADCAST_BYTES = 32 << 20


def checked_broadcast(written: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``written`` only while its files are small.

    Meant for step tables already written, whose size the file listing gives
    without a job. Above the limit the DataFrame is returned unchanged and the
    join stays a shuffle join, which AQE may still turn into a broadcast after
    measuring the shuffled side.
    """
    n_bytes = int(written._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(written) if n_bytes <= max_bytes else written
