"""Join helpers with explicit, checked size bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Largest side we broadcast by our own decision.  Anything bigger goes
# through a shuffle join (AQE may still convert it at runtime from
# measured sizes).
BROADCAST_ROW_LIMIT = 2_000_000


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast ``df`` only after counting it; otherwise return it as is."""
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df


def scalar(df: DataFrame, column: str):
    """Read a single aggregate value (a count, a sum) to the driver.

    ``df`` must be a one-row aggregate; the value is a number, bounded by
    construction."""
    row = df.select(column).first()
    return None if row is None else row[0]
