"""Short scenarios: one normal, three failures and six decoys per machine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.curves import degrade, ramp, step
from ..functions.derive import flow_gap
from ..functions.draws import Draws
from ..operators import overlay as O
from ..operators.labels import first_crossing, label_from, label_tail
from ..operators.lut import curve_array, with_curve
from ..operators.modulate import add_drift, add_noise
from ..operators.spine import ROWS_PER_TASK, day_rows, place, tile, with_one_row
from ..session import materialize
from ..sources.records import write_csv
from ..sources.series import write_by_key
from .motor import MotorInputs, pick
from .pump import PumpInputs

# --- fixed values: scenario name, group, kind, failure type, decoy type -----
PUMP_SCENARIOS = [
    ("normal", "all", "normal", None, None),
    ("pump_bearing_wear", "bearing", "failure", "bearing", None),
    ("decoy_highload_step", "bearing", "decoy", None, "highload_step"),
    ("decoy_highload_ramp", "bearing", "decoy", None, "highload_ramp"),
    ("pump_impeller_wear", "impeller", "failure", "impeller", None),
    ("decoy_back_pressure_step", "impeller", "decoy", None, "bp_step"),
    ("decoy_back_pressure_ramp", "impeller", "decoy", None, "bp_ramp"),
    ("pump_radial_wear", "radial", "failure", "radial", None),
    ("decoy_radial_highload_step", "radial", "decoy", None, "highload_step"),
    ("decoy_radial_highload_ramp", "radial", "decoy", None, "highload_ramp"),
]
MOTOR_SCENARIOS = [
    ("normal", "all", "normal", None, None),
    ("motor_winding_degradation", "winding", "failure", "winding", None),
    ("decoy_load_step", "winding", "decoy", None, "load_step"),
    ("decoy_load_ramp", "winding", "decoy", None, "load_ramp"),
    ("motor_bearing_wear", "bearing", "failure", "bearing", None),
    ("decoy_voltage_sag_step", "bearing", "decoy", None, "voltage_sag_step"),
    ("decoy_voltage_sag_ramp", "bearing", "decoy", None, "voltage_sag_ramp"),
    ("motor_demagnetization", "demag", "failure", "demag", None),
    ("decoy_duty_step", "demag", "decoy", None, "duty_step"),
    ("decoy_duty_ramp", "demag", "decoy", None, "duty_ramp"),
]
# --- fixed values: what the lookup says of each scenario ---------------------
DESCRIPTIONS = {
    "pump": [
        "Healthy pump — all sensors stable",
        "Thrust bearing wear — Tt rises above healthy baseline",
        "High-load step — speed ↑, Tt rises from load (not wear)",
        "High-load ramp — speed ↑ gradually, Tt rises proportionally",
        "Impeller wear — A shrinks, flow capacity degrades",
        "Back pressure step — flow drops but A stays constant",
        "Back pressure ramp — flow drops gradually, A constant",
        "Radial bearing wear — Tr rises above healthy baseline",
        "High-load step — speed ↑, Tr rises from load (not wear)",
        "High-load ramp — speed ↑ gradually, Tr rises proportionally",
    ],
    "motor": [
        "Healthy motor — all signals stable",
        "Winding degradation — R rises, speed drops, current rises",
        "Load step — speed drops from load increase (not winding)",
        "Load ramp — speed drops gradually from load (not winding)",
        "Bearing wear — friction rises, speed drops under same load",
        "Voltage sag step — speed drops from lower voltage (not wear)",
        "Voltage sag ramp — speed drops gradually (not wear)",
        "Demagnetization — K drops, speed/current characteristics change",
        "Duty cycle step — speed drops from reduced duty (not demag)",
        "Duty cycle ramp — speed drops gradually (not demag)",
    ],
}
CATALOGUES = {"pump": PUMP_SCENARIOS, "motor": MOTOR_SCENARIOS}
_FIELDS = ["scenario", "group", "kind", "failure_type", "decoy_type"]


def with_catalogue(units: DataFrame, machine: str) -> DataFrame:
    """Every unit once per scenario of the machine, with ``scenario_id``."""
    entries = [
        F.struct(
            F.lit(i).alias("scenario_id"),
            *[F.lit(v).cast("string").alias(n) for n, v in zip(_FIELDS, row)],
        )
        for i, row in enumerate(CATALOGUES[machine])
    ]
    return (
        units.withColumn("_s", F.explode(F.array(*entries)))
        .select("*", "_s.*")
        .drop("_s")
        .withColumn("faulty", F.col("kind") == "failure")
    )


def _rows(units: DataFrame, unit: str, machine: str, freq_s: int, horizon_s: int) -> DataFrame:
    """Rows of every scenario of every unit; ``device_id`` names the pair.

    The pairs are spread by ``device_id`` for the rows they grow to, since the units may be
    one small file; a series stays in one task.
    """
    named = with_catalogue(units, machine).withColumn(
        "device_id", F.concat_ws("_", F.col(unit).cast("string"), F.col("scenario_id"))
    )
    ends = {"_from": F.lit(0).cast("bigint"), "_to": F.lit(_last(freq_s, horizon_s)).cast("bigint")}
    return day_rows(place(named.withColumns(ends), ["device_id"]), freq_s)


def _last(freq_s: int, horizon_s: int) -> int:
    """Number of a scenario's last row."""
    return int(horizon_s) // int(freq_s)


def input_level(time_s: Column, decoy: Column, at: int, axis_levels: dict) -> Column:
    """Input value at a time: healthy until ``at``, then a step or a two-hour ramp."""
    low = {d: axis_levels[a][0] for d, a in K.MOTOR_DECOY_AXIS.items()}
    high = {d: axis_levels[a][1] for d, a in K.MOTOR_DECOY_AXIS.items()}
    out = None
    for d in low:
        shape = ramp if d.endswith("ramp") else step
        value = shape(time_s, low[d], high[d], at)
        out = F.when(decoy == d, value) if out is None else out.when(decoy == d, value)
    return out


def motor_scenarios(
    units: DataFrame,
    unit: str,
    inputs: MotorInputs,
    freq_s: int = K.SAVE_FREQ_S,
    horizon_s: int = K.HORIZON_S,
    change_at_s: int = K.CHANGE_AT_S,
    severity: Column | float = 1.0,
    draws: Draws = Draws(42),
) -> DataFrame:
    """All motor scenarios of all units: wear or input changes read off the curves."""
    lut = inputs.lut.select("axis", "param", *K.MOTOR_RESPONSES)
    curves = materialize(curve_array(lut, K.MOTOR_RESPONSES), "curves")
    rows = _rows(units.withColumn("_severity", F.lit(severity)), unit, "motor", freq_s, horizon_s)
    axis = F.coalesce("failure_type", pick("decoy_type", K.MOTOR_DECOY_AXIS))
    rows = rows.withColumn("axis", axis).join(curves, "axis", "left")
    level = inputs.healthy.select(
        *[F.col(c).alias(f"level_{c}") for c in K.MOTOR_RESPONSES]
    )
    rows = with_one_row(rows, level)
    t = F.col("time_s")
    nominal, failed = (
        pick("failure_type", {k: v[i] for k, v in K.MOTOR_WEAR.items()}) for i in (1, 2)
    )
    wear = degrade(t.cast("double"), nominal, failed, F.col("_severity") * float(horizon_s))
    changed = F.col("decoy_type").isNotNull() & (t >= change_at_s)
    rows = rows.withColumn(
        "_x",
        F.when(F.col("faulty"), wear).when(
            changed, input_level(t, F.col("decoy_type"), change_at_s, K.MOTOR_INPUTS)
        ),
    )
    rows = with_curve(rows, F.col("_x"), K.MOTOR_RESPONSES).drop("curve")
    signals = {c: F.coalesce(f"ep_{c}", f"level_{c}") for c in K.MOTOR_RESPONSES}
    for name, (column, healthy, _) in K.MOTOR_WEAR.items():
        signals[column] = F.when(F.col("failure_type") == name, F.col("_x")).otherwise(
            F.lit(healthy)
        )
    speed = K.MOTOR_RESPONSES[0]
    clean = rows.withColumns(signals)
    fails = first_crossing(
        clean.where("faulty").select(
            "device_id",
            "row_i",
            (F.col(speed) / F.col(f"level_{speed}")).alias("_share"),
        ),
        "_share",
        F.lit(K.MOTOR_FAIL_SPEED_FRACTION),
    )
    noisy = add_noise(clean, K.MOTOR_NOISE_SD, draws)
    longest = _last(freq_s, horizon_s) + 1
    walked = add_drift(noisy, K.MOTOR_RESPONSES, K.MOTOR_DRIFT_SD_SHORT, draws, longest=longest)
    labelled = label_from(walked, fails, freq_s)
    return labelled.select(
        unit, "scenario_id", "scenario", "row_i", *K.MOTOR_SIGNALS, "time_s", "time_h", "label",
        "time_to_failure_s",
    )


def pump_scenarios(
    units: DataFrame,
    unit: str,
    inputs: PumpInputs,
    freq_s: int = K.SAVE_FREQ_S,
    horizon_s: int = K.HORIZON_S,
    change_at_s: int = K.CHANGE_AT_S,
    draws: Draws = Draws(42),
) -> DataFrame:
    """All pump scenarios of all units.

    A failure plays its recorded episode from the start and ends with it; a
    decoy plays its episode from the change on; the rest is the healthy profile.
    Only the noise differs between units, so the series without it are worked out once.
    """
    clean = _clean_pump(units.sparkSession, inputs, freq_s, horizon_s, change_at_s)
    rows = _rows(units, unit, "pump", freq_s, horizon_s)
    # a left join, so that the opened rows can't become the broadcast side
    played = rows.join(clean, ["scenario_id", "row_i"], "left").where(
        ~F.col("faulty") | F.col("label").isNotNull()
    )
    return add_noise(played, K.PUMP_NOISE_SD, draws).select(
        unit, "scenario_id", "scenario", "row_i", *K.PUMP_SIGNALS, "time_s", "time_h", "label",
        "time_to_failure_s",
    ).withColumn("flow_gap_m3s", flow_gap(F.col("flow_in_m3s"), F.col("flow_out_m3s")))


def _clean_pump(
    spark: SparkSession, inputs: PumpInputs, freq_s: int, horizon_s: int, change_at_s: int
) -> DataFrame:
    """Signals and labels of every scenario's rows, before noise; stored.

    The rows of all units meet this table alone, by (``scenario_id``, ``row_i``). It is written by as
    few tasks as its rows need, since the footers of many small files would make it look too
    large to broadcast.
    """
    cycle = K.CYCLE_S // freq_s
    change = change_at_s // freq_s
    rows = _rows(spark.range(1), "id", "pump", freq_s, horizon_s)
    rows = tile(rows, inputs.profile, K.PUMP_SIGNALS, K.STARTUP_CYCLES * cycle, cycle)
    episodes = materialize(inputs.episodes.select("kind", "idx", *K.PUMP_SIGNALS), "episodes")
    name = F.when(F.col("faulty"), F.concat(F.lit("failure_"), "failure_type")).when(
        F.col("decoy_type").isNotNull(), F.concat(F.lit("decoy_"), "decoy_type")
    )
    at = F.when(F.col("faulty"), F.col("row_i")).otherwise(F.col("row_i") - change)
    rows = rows.withColumnRenamed("kind", "_scenario_kind").withColumn("kind", name)
    played = O.with_episode(rows, episodes, K.PUMP_SIGNALS, at, "ep_")
    found = F.col(f"ep_{K.PUMP_SIGNALS[0]}").isNotNull()
    values = {
        c: F.when(found, F.col(f"ep_{c}")).otherwise(F.col(c)) for c in K.PUMP_SIGNALS
    }
    whole = played.withColumns(values).where(~F.col("faulty") | found)
    labelled = label_tail(whole, "faulty", freq_s).select(
        "scenario_id", "row_i", *K.PUMP_SIGNALS, "label", "time_to_failure_s"
    )
    tasks = -(-len(PUMP_SCENARIOS) * (_last(freq_s, horizon_s) + 1) // ROWS_PER_TASK)
    return materialize(labelled.repartition(tasks), "pump-scenarios")


def scenario_lookup(units: DataFrame, machine: str, unit: str) -> DataFrame:
    """Lookup rows of the scenarios each unit runs, with their descriptions."""
    texts = F.array(*[F.lit(t) for t in DESCRIPTIONS[machine]])
    rows = with_catalogue(units.select(unit), machine)
    text = F.element_at(texts, F.col("scenario_id") + 1)
    return rows.select(
        unit,
        F.col("scenario_id").cast("int").alias("scenario_id"),
        "scenario", "group", "kind", "faulty", text.alias("description"),
    )


def write_scenario_set(series: DataFrame, lookup: DataFrame, out: str) -> None:
    """Write a scenario set: a CSV folder per scenario and the lookup beside them."""
    write_by_key(series, f"{out.rstrip('/')}/series", "scenario")
    write_csv(lookup, f"{out.rstrip('/')}/lookup")
