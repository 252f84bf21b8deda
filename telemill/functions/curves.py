"""Closed-form curves of time as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import CHANGE_AT_S, CYCLE_S, PUMP_V_HIGH, PUMP_V_NOM


def ease(r: Column, length) -> Column:
    """Cosine rise from 0 at ``r = 0`` to 1 at ``r = length``."""
    return F.lit(0.5) * (F.lit(1.0) - F.cos(F.lit(math.pi) * r / length))


def clip(x: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(x, F.lit(lo)), F.lit(hi))


def degrade(t: Column, nominal, failed, span) -> Column:
    """Exponential wear from ``nominal`` at 0 to ``failed`` at ``span``."""
    nominal, failed, span = F.lit(nominal), F.lit(failed), F.lit(span)
    share = F.least(F.try_divide(t, span), F.lit(1.0))
    frac = (F.exp(F.lit(3.0) * share) - 1.0) / F.lit(math.exp(3.0) - 1.0)
    return F.when(span <= 0, failed).otherwise(nominal + (failed - nominal) * frac)


def cyclic(
    t: Column,
    low: float = PUMP_V_NOM,
    high: float = PUMP_V_HIGH,
    cycle: int = CYCLE_S,
    ramp: int = 100,
) -> Column:
    """Half a cycle low, half high, ``ramp`` seconds of slope at each change.

    The slope is one unit per second, so ``high - low`` should equal ``ramp``.
    """
    at = t % F.lit(cycle)
    half = cycle / 2.0
    return (
        F.when(at < half, F.lit(low))
        .when(at < half + ramp, F.lit(low) + (at - half))
        .when(at < cycle - ramp, F.lit(high))
        .otherwise(F.lit(low) - (at - cycle))
    )


def step(t: Column, before, after, at: int = CHANGE_AT_S) -> Column:
    """``before`` until ``at``, ``after`` from then on."""
    return F.when(t >= at, F.lit(after)).otherwise(F.lit(before))


def ramp(t: Column, before, after, at: int = CHANGE_AT_S, span: int = 2 * 3600) -> Column:
    """Linear change from ``before`` to ``after`` over ``span``, then hold."""
    share = clip((t - at) / F.lit(float(span)), 0.0, 1.0)
    return F.lit(before) + share * (F.lit(after) - F.lit(before))


def ambient_temperature(time_h: Column, amplitude) -> Column:
    """Daily swing, coldest at 4 h, plus a yearly one, coldest at day 0."""
    a = F.lit(amplitude)
    daily = -a * F.cos(F.lit(2 * math.pi) * (time_h - 4.0) / 24.0)
    yearly = -a * 0.5 * F.cos(F.lit(2 * math.pi) * (time_h / 24.0) / 365.0)
    return daily + yearly


def ambient_resistance(time_h: Column, amplitude) -> Column:
    """Change of winding resistance with daily and yearly temperature."""
    a = F.lit(amplitude)
    daily = a * 0.01 * F.sin(F.lit(2 * math.pi) * (time_h - 14.0) / 24.0)
    yearly = a * 0.005 * F.sin(F.lit(2 * math.pi) * time_h / 8760.0)
    return daily + yearly


def duty_factor(time_h: Column, depth, night_drop: float, smooth: bool) -> Column:
    """Share of full duty: 1 by day, less at night, 30 % of ``depth`` less at weekends.

    Day 0 is a Monday. With ``smooth`` the night level is blended in over
    5-7 h and 17-19 h outside the 6-18 h core.
    """
    depth = F.lit(depth)
    hour = time_h % 24.0
    weekday = F.floor(time_h / 24.0) % 7
    level = F.when((hour >= 6) & (hour < 18), F.lit(1.0)).otherwise(1.0 - night_drop * depth)
    if smooth:
        lit = clip((hour - 5.0) / 2.0, 0.0, 1.0) * clip((19.0 - hour) / 2.0, 0.0, 1.0)
        level = 1.0 - (1.0 - level) * (1.0 - lit)
    return level * F.when(weekday >= 5, 1.0 - 0.3 * depth).otherwise(F.lit(1.0))


def around(x: Column, centre, factor: Column) -> Column:
    """Scale the deviation of ``x`` from ``centre``."""
    centre = F.lit(centre)
    return centre + (x - centre) * factor
