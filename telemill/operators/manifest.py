"""Device manifest: sampling and default values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.draws import Draws
from .chunks import global_rank


def device_ids(df: DataFrame, index: str, prefix: str, base_seed: int) -> DataFrame:
    """Add ``device_id`` (prefix, six-digit number) and ``seed`` (base + number)."""
    return df.withColumns(
        {
            "device_id": F.format_string(f"{prefix}_%06d", F.col(index)),
            "seed": F.lit(base_seed).cast("bigint") + F.col(index),
        }
    )


def numbered_devices(spark: SparkSession, n: int, prefix: str, base_seed: int) -> DataFrame:
    return device_ids(spark.range(n).withColumnRenamed("id", "device_no"), "device_no", prefix, base_seed)


def assign_quota(
    df: DataFrame,
    key: str,
    quotas: Sequence[tuple[str, float]],
    seed: int,
    name: str = "failure_type",
) -> DataFrame:
    """Give exactly ``int(n * fraction)`` rows each class, in random order.

    What the fractions leave over stays null (healthy). ``key`` must be unique.
    """
    shares = [f for _, f in quotas]
    if min(shares, default=0.0) < 0 or sum(shares) > 1 + 1e-9:
        raise ValueError("fractions must be non-negative and sum to at most 1")
    text = F.md5(F.concat_ws("|", F.lit(int(seed)), F.col(key), F.lit("quota")))
    ranked = global_rank(df, text, "_rank", [key])
    label = F.lit(None).cast("string")
    below = F.lit(0).cast("bigint")
    bounds = []
    for cls, share in quotas:
        upper = below + F.floor(F.col("_total") * F.lit(float(share)))
        bounds.append((cls, below, upper))
        below = upper
    for cls, lo, hi in bounds:
        label = F.when((F.col("_rank") >= lo) & (F.col("_rank") < hi), F.lit(cls)).otherwise(label)
    return ranked.withColumn(name, label).drop("_rank", "_total")


def only_if(condition: Column, value: Column) -> Column:
    """``value`` where the condition holds, null elsewhere."""
    return F.when(condition, value)


def default_start_day(start: Column, days: Column, keys, draws: Draws) -> Column:
    """Failure day; a missing one falls at 70-90 % of the duration."""
    return F.coalesce(start, days * draws.uniform(keys, "default_start", 0.7, 0.9))


def default_severity(severity: Column, keys, draws: Draws) -> Column:
    """Severity; 0 asks for a random one between 0.5 and 2."""
    return F.when(severity == 0, draws.uniform(keys, "default_severity", 0.5, 2.0)).otherwise(severity)


MACHINES = {
    "pump": ("device", K.PUMP_FAILURES, K.PUMP_DECOYS, K.PUMP_V_NOM),
    "motor": ("motor", K.MOTOR_FAILURES, K.MOTOR_DECOYS, K.MOTOR_V_NOM),
}


def sample_manifest(
    devices: DataFrame,
    index: str,
    machine: str,
    duration_days: float = K.FLEET_DAYS,
    base_seed: int = K.FLEET_SEED,
    fractions: Sequence[tuple[str, float]] | None = None,
    method: str = "md5",
) -> DataFrame:
    """One row of settings per device, drawn from the fleet's distributions."""
    prefix, failures, decoys, v_nom = MACHINES[machine]
    quotas = fractions or [(f, K.FAILURE_FRACTION) for f in failures]
    draws = Draws(base_seed, method)
    key = [index]
    named = device_ids(devices.select(index), index, prefix, base_seed)
    typed = assign_quota(named, index, quotas, base_seed)
    days = float(duration_days)
    options = F.array(*[F.lit(d) for d in decoys])
    cols = {
        "duration_days": F.lit(days),
        "failure_start_day": only_if(
            F.col("failure_type").isNotNull(),
            draws.uniform(key, "start", 0.3 * days, 0.95 * days),
        ),
        "failure_severity": draws.lognormal(key, "severity", 0.0, 0.4, 0.3, 3.0),
        "ambient_var_K": draws.uniform(key, "ambient", 2.0, 12.0),
        "duty_cycle_var": draws.uniform(key, "duty", 0.1, 0.8),
        "decoy_freq_per_day": draws.exponential(key, "decoy_freq", 2.0, 0.0, 8.0),
        "decoy_types": draws.subset(
            options, draws.randint(key, "decoy_n", 1, len(decoys) + 1), key, "decoy_type"
        ),
        "noise_scale": draws.uniform(key, "noise", 0.5, 2.0),
        "v_offset": draws.normal(key, "v_offset", 0.0, v_nom * 0.02),
    }
    if machine == "pump":
        cols["p_offset"] = draws.normal(key, "p_offset", 0.0, K.PUMP_P_DISCHARGE * 0.03)
    order = ["device_id", "seed", "duration_days", "failure_type", *list(cols)[1:]]
    return typed.withColumns(cols).select(index, *order)
