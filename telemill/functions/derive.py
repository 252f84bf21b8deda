"""Derived signals as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import PROP_TORQUE


def flow_gap(inflow: Column, outflow: Column) -> Column:
    """Inflow that does not come out again, never below zero."""
    return F.greatest(inflow - outflow, F.lit(0.0))


def hours(seconds: Column) -> Column:
    return seconds / F.lit(3600.0)


def with_pump_columns(df: DataFrame) -> DataFrame:
    """Add ``time_h``, ``pump_speed_rads`` and ``flow_gap_m3s``."""
    return df.withColumns(
        {
            "time_h": hours(F.col("time_s")),
            "pump_speed_rads": F.col("shaft_speed_rads"),
            "flow_gap_m3s": flow_gap(F.col("flow_in_m3s"), F.col("flow_out_m3s")),
        }
    )


def with_power(
    df: DataFrame, speed: str, current: str, voltage, torque_coeff: float = PROP_TORQUE
) -> DataFrame:
    """Add load torque, mechanical power and electrical power."""
    v = F.col(speed)
    torque = F.lit(torque_coeff) * v * v
    return df.withColumns(
        {
            "torque_load_Nm": torque,
            "mechanical_power_W": torque * F.abs(v),
            "electrical_power_W": F.lit(voltage) * F.col(current),
        }
    )


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep the listed columns under their new names; drop the others."""
    return df.select(*[F.col(old).alias(new) for old, new in mapping.items()])


def fixed_text(x: Column, digits: int) -> Column:
    """Number as text with fixed decimals, rounded on its exact binary value, halves to even.

    The fraction is cut into two halves of its bits, so that its product with a power
    of ten has no rounding error before the comparison with one half.
    """
    scale, half_bits = 10**digits, float(1 << 26)
    size = F.abs(x.cast("double"))
    whole = F.floor(size)
    part = size - whole
    high = F.floor(part * half_bits) / half_bits
    low = (part - high) * float(scale)
    steps = F.floor(high * float(scale))
    beyond = (high * float(scale) - steps - 0.5) + low
    up = (beyond > 0) | ((beyond == 0) & ((whole * scale + steps) % 2 == 1))
    units = whole * scale + steps + F.when(up, 1).otherwise(0)
    tail = units % scale
    text = ((units - tail) / scale).cast("bigint").cast("string")
    if digits > 0:
        text = F.concat(text, F.lit("."), F.lpad(tail.cast("string"), digits, "0"))
    signed = F.concat(F.when(x < 0, "-").otherwise(""), text)
    return F.when(size < 1e12, signed).otherwise(F.format_string(f"%.{digits}f", x))
