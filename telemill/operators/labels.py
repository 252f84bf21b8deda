"""Ground truth: failure rows, labels and time to failure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import NO_FAILURE_TTF, PRE_FAILURE_S
from .joins import attach


def first_crossing(
    df: DataFrame,
    col: str,
    limit: Column,
    key: str = "device_id",
    row: str = "row_i",
    fallback: str | None = None,
) -> DataFrame:
    """First row per key where ``col`` is below ``limit``; else the fallback row, else the last."""
    hit = F.min(F.when(F.col(col) < limit, F.col(row)))
    other = F.max(fallback if fallback else row)
    return df.groupBy(key).agg(F.coalesce(hit, other).alias("fail_row"))


def label_values(
    row: Column,
    fail_row: Column,
    freq_s: int,
    start_row: Column | None = None,
    pre_s: int = PRE_FAILURE_S,
    inclusive_extra: int = 0,
    open_end: bool = True,
    full_countdown: bool = False,
) -> dict[str, Column]:
    """``label`` and ``time_to_failure_s`` around one failure row (null = none).

    ``open_end`` keeps FAILURE to the end of the series; otherwise only the
    failure row has it. ``inclusive_extra`` adds rows to the warning span.
    ``full_countdown`` counts down from the first row instead of the warning span.
    """
    lead = fail_row - (pre_s // freq_s) - inclusive_extra
    first = F.greatest(lead, start_row if start_row is not None else F.lit(0))
    failed = (row >= fail_row) if open_end else (row == fail_row)
    warned = (row >= first) & (row < fail_row)
    label = (
        F.when(failed, F.lit("FAILURE")).when(warned, F.lit("PRE_FAILURE")).otherwise(F.lit("NORMAL"))
    )
    counted = failed | (row < fail_row if full_countdown else warned)
    left = F.greatest((fail_row - row) * F.lit(int(freq_s)), F.lit(0)).cast("double")
    return {
        "label": label,
        "time_to_failure_s": F.when(counted, left).otherwise(F.lit(NO_FAILURE_TTF)),
    }


def label_from(
    df: DataFrame,
    fail_rows: DataFrame,
    freq_s: int,
    key: str = "device_id",
    row: str = "row_i",
    **options,
) -> DataFrame:
    """Label rows against a table of (key, ``fail_row``); keys without one stay NORMAL."""
    joined = attach(df, fail_rows.select(key, "fail_row"), [key], "left")
    return joined.withColumns(
        label_values(F.col(row), F.col("fail_row"), freq_s, **options)
    ).drop("fail_row")


def label_tail(
    df: DataFrame,
    faulty: str,
    freq_s: int,
    pre_s: int = PRE_FAILURE_S,
    key: str = "device_id",
    row: str = "row_i",
) -> DataFrame:
    """Label a series that ends in its failure, where ``faulty`` is true."""
    last = df.groupBy(key).agg(F.max(F.when(F.col(faulty), F.col(row))).alias("fail_row"))
    return label_from(df, last, freq_s, key, row, pre_s=pre_s)


def label_episode(
    df: DataFrame,
    episodes: DataFrame,
    freq_s: int,
    key: str = "device_id",
    row: str = "row_i",
    inclusive_extra: int = 0,
    pre_s: int = PRE_FAILURE_S,
) -> DataFrame:
    """Label a long series around a failure inside it (key, ``start_row``, ``fail_row``)."""
    joined = attach(
        df, episodes.select(key, F.col("start_row").alias("_start"), "fail_row"), [key], "left"
    )
    return joined.withColumns(
        label_values(
            F.col(row),
            F.col("fail_row"),
            freq_s,
            F.col("_start"),
            pre_s,
            inclusive_extra,
            open_end=False,
        )
    ).drop("fail_row", "_start")
