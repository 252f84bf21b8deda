"""Noise, drift, ambient and duty modulation, device offsets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import PUMP_P_DISCHARGE
from ..functions.curves import (
    ambient_resistance,
    ambient_temperature,
    around,
    duty_factor,
)
from ..functions.draws import Draws
from .joins import attach
from .chunks import CHUNK, CHUNK_ROWS, running, with_chunk


def noise(col: str, sd, keys, draws: Draws, scale=1.0, stream: str = "noise") -> Column:
    return draws.standard_normal(keys, f"{stream}_{col}") * (F.lit(sd) * F.lit(scale))


def add_noise(
    df: DataFrame,
    sd_by_col: dict[str, float],
    draws: Draws,
    scale: Column | float = 1.0,
    keys: Sequence[str] = ("device_id", "row_i"),
) -> DataFrame:
    """Fresh noise on every signal with a non-zero spread."""
    return df.withColumns(
        {
            c: F.col(c) + noise(c, sd, keys, draws, scale)
            for c, sd in sd_by_col.items()
            if sd > 0
        }
    )


def add_drift(
    df: DataFrame,
    cols: Sequence[str],
    sd: float,
    draws: Draws,
    key: str = "device_id",
    row: str = "row_i",
    chunk_rows: int = CHUNK_ROWS,
    longest: int | None = None,
) -> DataFrame:
    """Random walk on the named signals, starting with a step at row 0.

    Where no ``row`` reaches ``longest`` and that is no more than a chunk, nothing is carried from
    chunk to chunk, and rows placed by ``key`` stay where they are.
    """
    steps = {f"_z_{c}": draws.normal([key, row], f"drift_{c}", 0.0, sd) for c in cols}
    if longest is not None and longest <= chunk_rows:
        so_far = Window.partitionBy(key).orderBy(row).rowsBetween(Window.unboundedPreceding, 0)
        walk = {f"_w_{c}": F.sum(f"_z_{c}").over(so_far) for c in cols}
        return (
            df.withColumns(steps)
            .withColumns(walk)
            .withColumns({c: F.col(c) + F.coalesce(f"_w_{c}", F.lit(0.0)) for c in cols})
            .drop(*[f"_{p}_{c}" for p in "zw" for c in cols])
        )
    chunked = with_chunk(df, row, chunk_rows).withColumns(steps)
    walked = running(chunked, [key], {f"_w_{c}": (f"_z_{c}", "sum") for c in cols}, [row])
    return walked.withColumns({c: F.col(c) + F.col(f"_w_{c}") for c in cols}).drop(
        CHUNK, *[f"_{p}_{c}" for p in "zw" for c in cols]
    )


def add_ambient(df: DataFrame, cols: Sequence[str], amplitude, time_h: str = "time_h") -> DataFrame:
    """Outside temperature added to the temperature signals."""
    delta = ambient_temperature(F.col(time_h), amplitude)
    return df.withColumns({c: F.col(c) + delta for c in cols})


def add_ambient_coupled(
    df: DataFrame, resistance: str, speed: str, amplitude, time_h: str = "time_h"
) -> DataFrame:
    """Temperature effect on winding resistance; speed moves ten times as much against it."""
    delta = ambient_resistance(F.col(time_h), amplitude)
    return df.withColumns(
        {resistance: F.col(resistance) + delta, speed: F.col(speed) - delta * 10.0}
    )


def add_duty(
    df: DataFrame,
    centres: dict[str, Column | str],
    depth,
    night_drop: float,
    smooth: bool,
    time_h: str = "time_h",
) -> DataFrame:
    """Scale each signal's deviation from its centre by the duty factor."""
    factor = duty_factor(F.col(time_h), depth, night_drop, smooth)
    return df.withColumn("_duty", factor).withColumns(
        {
            c: around(F.col(c), F.col(m) if isinstance(m, str) else m, F.col("_duty"))
            for c, m in centres.items()
        }
    ).drop("_duty")


def with_series_mean(
    df: DataFrame, cols: Sequence[str], key: str = "device_id", prefix: str = "mean_"
) -> DataFrame:
    """Attach each key's mean of the named signals (pre-aggregated before the shuffle)."""
    means = df.groupBy(key).agg(*[F.avg(c).alias(f"{prefix}{c}") for c in cols])
    return attach(df, means, [key])


def apply_pump_offsets(
    df: DataFrame,
    speeds: Sequence[str],
    flows: Sequence[str],
    v_offset: Column,
    p_offset: Column,
    p_nominal: float = PUMP_P_DISCHARGE,
) -> DataFrame:
    """Voltage offset moves the speeds, pressure offset scales the flows."""
    return df.withColumns(
        {
            **{c: F.col(c) + v_offset * 0.8 for c in speeds},
            **{c: F.col(c) + F.col(c) * (p_offset / F.lit(p_nominal)) for c in flows},
        }
    )
