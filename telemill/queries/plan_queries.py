"""Whole builds: long series, scenario sets, sample data sets, fleets."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions.draws import Draws
from ..operators.lut import build_lut
from ..operators.manifest import sample_manifest
from ..plans import fleet as FL
from ..plans import scenarios as SN
from ..plans.motor import MotorInputs, build_motor
from ..plans.pump import PumpInputs, build_pump
from ..session import new_path, use_compiled_code
from . import plan_sql
from .base import Registry, r6, table
from .draw_queries import QUOTA

register = Registry()
DAYS = 2.0
#: The long series run over a weekend and into a second week.
SERIES_DAYS = 9.0

# One text per signal, read the same way by both engines.
PUMP_TEXT = {
    "shaft_speed_rads": "350 + avg(l_quantity)",
    "flow_out_m3s": "0.001 + avg(l_discount) / 100",
    "thrust_bearing_K": "290 + avg(l_tax) * 500",
    "radial_bearing_K": "290 + avg(l_tax) * 600",
    "fluid_temp_K": "290 + avg(l_discount) * 200",
    "flow_in_m3s": "0.001 + avg(l_tax) / 100",
    "pump_speed_rads": "349 + avg(l_quantity)",
    "impeller_area_A": "avg(l_linenumber)",
    "r_thrust": "avg(l_linenumber) / 1000",
    "r_radial": "avg(l_quantity) / 1000000",
}


def pump_inputs(spark, sf, freq_s) -> PumpInputs:
    """Order lines by position as the measured profile and episodes of a pump."""
    cycle = K.CYCLE_S // freq_s
    startup = K.STARTUP_CYCLES * cycle
    lines = table(spark, sf, "lineitem")
    signals = [F.expr(t).alias(c) for c, t in PUMP_TEXT.items()]
    i = F.col("i")
    profile = (
        lines.groupBy((F.col("l_orderkey") % (startup + cycle)).alias("i"))
        .agg(*signals)
        .select(
            F.when(i < startup, "startup").otherwise("cycle").alias("phase"),
            F.when(i < startup, i).otherwise(i - startup).alias("idx"),
            *PUMP_TEXT,
        )
    )
    decoy_rows = (K.HORIZON_S - K.CHANGE_AT_S) // freq_s + 1
    fail_rows = K.HORIZON_S // freq_s + 1
    n = F.col("l_linenumber") - 1
    decoy = F.element_at(
        F.array(*[F.lit(f"decoy_{d}") for d in K.PUMP_DECOYS]), (n % 4 + 1).cast("int")
    )
    fail = F.element_at(
        F.array(*[F.lit(f"failure_{f}") for f in K.PUMP_FAILURES]), (n % 3 + 1).cast("int")
    )
    calm = F.col("l_linestatus") == "O"
    episodes = lines.groupBy(
        F.when(calm, decoy).otherwise(fail).alias("kind"),
        (F.col("l_orderkey") % F.when(calm, decoy_rows).otherwise(fail_rows)).alias("idx"),
    ).agg(*signals)
    return PumpInputs(profile, episodes)


RESPONSE_TEXT = {
    "rotational_velocity_rads": "100 - 1.5 * p_size + p_retailprice / 1000",
    "current_rms_A": "2 + 0.1 * p_size + p_retailprice / 10000",
    "torque_load_Nm": "0.01 + 0.0001 * p_size + p_retailprice / 10000000",
    "mechanical_power_W": "20 - 0.2 * p_size + p_retailprice / 1000",
    "electrical_power_W": "40 + 0.2 * p_size + p_retailprice / 1000",
}
AXES = {
    **{axis: (lo, hi) for axis, (_, lo, hi) in K.MOTOR_WEAR.items()},
    **K.MOTOR_INPUTS,
}


def motor_inputs(spark, sf) -> MotorInputs:
    """Parts as bench runs: size stands for how far the input was moved."""
    runs = table(spark, sf, "part").select(
        "p_size", *[F.expr(t).alias(c) for c, t in RESPONSE_TEXT.items()]
    )
    lut = None
    for axis, (lo, hi) in AXES.items():
        a = min(lo, hi)
        points = runs.withColumn(
            "param", F.lit(lo) + (F.col("p_size") - 1) / F.lit(49.0) * F.lit(hi - lo)
        )
        one = build_lut(points, "param", K.MOTOR_RESPONSES, a, max(lo, hi), axis)
        lut = one if lut is None else lut.unionByName(one)
    healthy = runs.where("p_size = 1").agg(*[F.avg(c).alias(c) for c in K.MOTOR_RESPONSES])
    return MotorInputs(healthy, lut)


def suppliers(spark, sf):
    """Machines to build; every build reads them, so its wide stages get code that the JVM compiles."""
    use_compiled_code(spark)
    return table(spark, sf, "supplier").select("s_suppkey")


@register("pump_series", plan_sql.pump_series(PUMP_TEXT, SERIES_DAYS))
def pump_series(spark, sf, freq_s=300, method="md5"):
    manifest = sample_manifest(suppliers(spark, sf), "s_suppkey", "pump", SERIES_DAYS)
    out = build_pump(
        manifest, pump_inputs(spark, sf, freq_s), freq_s, maintenance_per_month=15.0, method=method
    )
    return out.withColumns({c: r6(c) for c in [*K.PUMP_SIGNALS, "flow_gap_m3s"]})


@register("motor_series", plan_sql.motor_series(RESPONSE_TEXT, AXES, SERIES_DAYS))
def motor_series(spark, sf, freq_s=300, method="md5"):
    manifest = sample_manifest(suppliers(spark, sf), "s_suppkey", "motor", SERIES_DAYS)
    out = build_motor(
        manifest, motor_inputs(spark, sf), freq_s, maintenance_per_month=15.0, method=method
    )
    return out.withColumns({c: r6(c) for c in K.MOTOR_SIGNALS})


@register("pump_scenario_set", plan_sql.pump_scenarios(PUMP_TEXT, SN.PUMP_SCENARIOS))
def pump_scenario_set(spark, sf):
    out = SN.pump_scenarios(suppliers(spark, sf), "s_suppkey", pump_inputs(spark, sf, 300), 300)
    return out.withColumns({c: r6(c) for c in [*K.PUMP_SIGNALS, "flow_gap_m3s"]})


@register(
    "motor_scenario_set", plan_sql.motor_scenarios(RESPONSE_TEXT, AXES, SN.MOTOR_SCENARIOS)
)
def motor_scenario_set(spark, sf):
    out = SN.motor_scenarios(
        suppliers(spark, sf), "s_suppkey", motor_inputs(spark, sf), 300, draws=Draws(42)
    )
    return out.withColumns({c: r6(c) for c in K.MOTOR_SIGNALS})


def _sample(spark, sf, machine, inputs):
    series, _ = FL.sample_dataset(
        suppliers(spark, sf), "s_suppkey", machine, inputs, 300,
        duration_days=1.0, ambient_var_K=5.0, duty_cycle_var=0.5, method="md5",
    )
    return series


@register(
    "pump_sample_dataset",
    plan_sql.sample_dataset("pump", plan_sql.pump_series, 1.0, PUMP_TEXT),
)
def pump_sample_dataset(spark, sf):
    out = _sample(spark, sf, "pump", pump_inputs(spark, sf, 300))
    return out.withColumns({c: r6(c) for c in [*K.PUMP_SIGNALS, "flow_gap_m3s"]})


@register(
    "motor_sample_dataset",
    plan_sql.sample_dataset("motor", plan_sql.motor_series, 1.0, RESPONSE_TEXT, AXES),
)
def motor_sample_dataset(spark, sf):
    out = _sample(spark, sf, "motor", motor_inputs(spark, sf))
    return out.withColumns({c: r6(c) for c in K.MOTOR_SIGNALS})


@register(
    "fleet_build",
    QUOTA.replace("p_partkey", "s_suppkey").replace("from part", "from supplier").format(
        seed=12345, a="bearing", b="impeller", c="radial"
    ).join(
        [
            "with ",
            """ select printf('device_%06d', s_suppkey) as device_id, 12345 + s_suppkey as seed,
      failure_type, 'completed' as status, 2881::bigint as num_rows from typed""",
        ]
    ),
)
def fleet_build(spark, sf):
    """Builds and writes the pump fleet at one row a minute, then reports its manifest."""
    run = FL.build_fleet(
        suppliers(spark, sf), "s_suppkey", "pump", pump_inputs(spark, sf, 60),
        new_path(spark, "pump-fleet"), DAYS,
    )
    return run.manifest.select("device_id", "seed", "failure_type", "status", "num_rows")


@register(
    "fleet_resume",
    f"""select printf('device_%06d', s_suppkey) as device_id, 'completed' as status,
      {int(DAYS * 86400 / 300) + 1}::bigint as num_rows, {int(DAYS * 86400 / 300) + 1}::bigint as stored_rows,
      {int(DAYS * 86400 / 300) + 1}::bigint as different_rows, case when s_suppkey % 10 = 3 then 3
        when s_suppkey % 2 = 0 then 2 else 1 end::bigint as run
    from supplier""",
)
def fleet_resume(spark, sf):
    """Odd devices first, then all, then again; the settings of some are unusable until the third run."""
    all_, inputs, out = suppliers(spark, sf), pump_inputs(spark, sf, 300), new_path(spark, "resumed-fleet")
    odd = all_.where("s_suppkey % 2 = 1")
    broken = all_.where("s_suppkey % 10 = 3").select(
        F.format_string("device_%06d", "s_suppkey").alias("device_id"), F.lit(float("nan")).alias("noise_scale")
    )
    for part, settings in ((odd, broken), (all_, broken), (all_, None)):
        FL.build_fleet(part, "s_suppkey", "pump", inputs, out, DAYS, 300, settings=settings)
    rows = FL.read_devices(spark, out).groupBy("device_id").agg(
        F.count(F.lit(1)).alias("stored_rows"), F.count_distinct("row_i").alias("different_rows")
    )
    manifest = FL.stored_manifest(spark, out).select("device_id", "status", "num_rows", F.col("data_version").alias("run"))
    return manifest.join(rows, "device_id", "left")
