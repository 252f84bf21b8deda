"""Joins of long tables with tables of one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def attach(rows: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join per-key values onto rows without moving the rows when that is safe.

    ``small`` (one row per key) is stored first, so the planner knows its real
    size: under the broadcast threshold the rows stay where they are, above it
    the join shuffles and adaptive skew handling splits hot keys.
    """
    return rows.join(materialize(small, "attached"), list(keys), how)


def with_anchor(
    windows: DataFrame,
    rows: DataFrame,
    cols: Sequence[str],
    at: str,
    prefix: str,
    key: str = "device_id",
    row: str = "row_i",
) -> DataFrame:
    """Add the values at row ``at`` of each window, as ``prefix + column``.

    For rows already cut down to the anchors; see ``with_anchors`` for a whole series.
    """
    values = rows.select(
        F.col(key).alias("_k"),
        F.col(row).alias("_r"),
        *[F.col(c).alias(f"{prefix}{c}") for c in cols],
    )
    return windows.join(
        values, (F.col(key) == F.col("_k")) & (F.col(at) == F.col("_r")), "left"
    ).drop("_k", "_r")


def with_anchors(
    windows: DataFrame,
    rows: DataFrame,
    at: dict[str, tuple[str, Sequence[str]]],
    key: str = "device_id",
    row: str = "row_i",
) -> DataFrame:
    """Add row values of a whole series to windows: ``prefix -> (row column, columns)``.

    The rows are read once for all prefixes and only the named ones are kept; a
    table of row numbers small enough to broadcast leaves the rows where they
    are. The result is stored.
    """
    windows = materialize(windows, "windows")
    points = None
    for column, _ in at.values():
        one = windows.select(F.col(key).alias("_k"), F.col(column).cast("bigint").alias("_r"))
        points = one if points is None else points.unionByName(one)
    cols = list(dict.fromkeys(c for _, named in at.values() for c in named))
    picked = materialize(
        rows.select(key, row, *cols)
        .join(points.distinct(), (F.col(key) == F.col("_k")) & (F.col(row) == F.col("_r")))
        .drop("_k", "_r"),
        "anchors",
    )
    for prefix, (column, named) in at.items():
        windows = with_anchor(windows, picked, named, column, prefix, key, row)
    return materialize(windows, "anchored")
