"""Size checks for data that is broadcast or held on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame


class TooLargeError(ValueError):
    pass


def require_small(df: DataFrame, max_rows: int, what: str = "table") -> int:
    """Count at most ``max_rows + 1`` rows and fail if the bound is passed.

    Used before a table is broadcast or collected (class lists, model
    centroids, image lists); the bound is what makes the broadcast safe."""
    n = df.limit(max_rows + 1).count()
    if n > max_rows:
        raise TooLargeError(f"{what} has more than {max_rows} rows; refusing to broadcast/collect")
    return n


def collect_small(df: DataFrame, max_rows: int, what: str = "table") -> list:
    """Collect a table known to be small (model weights, class lists) in one
    job, failing if it holds more than ``max_rows`` rows."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise TooLargeError(f"{what} has more than {max_rows} rows; refusing to collect")
    return rows
