"""Size checks behind every broadcast.

A side is broadcast only if its rows and its bytes are within bounds; beyond
them the caller's shuffle plan is used. Callers check frames that are
checkpointed or cheap to compute: the check aggregates them once, in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows and bytes of text that a broadcast side may hold.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 << 20


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    text = [F.coalesce(F.octet_length(c), F.lit(0)) for c, t in df.dtypes if t == "string"]
    width = sum(text, F.lit(16 * len(df.columns)))
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes
