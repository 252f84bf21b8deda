"""Long motor series: the whole build."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.curves import ambient_resistance, around, degrade, duty_factor
from ..functions.draws import Draws
from ..operators import overlay as O
from ..operators.intervals import fit_windows, lay_over, schedule
from ..operators.labels import first_crossing
from ..operators.lut import curve_array, interp, with_curve
from ..operators.modulate import noise
from ..operators.spine import with_one_row
from ..session import materialize
from . import layers as Y

KEY = Y.KEY
SIGNALS, RESPONSES, PARAMS = K.MOTOR_SIGNALS, K.MOTOR_RESPONSES, K.MOTOR_PARAMS
SD = {c: K.MOTOR_NOISE_SD[c] for c in RESPONSES}
GROUPS = {"stop": RESPONSES}
SPEED, CURRENT = RESPONSES[:2]


@dataclass
class MotorInputs:
    """Measured tables: ``healthy`` (one row of responses) and ``lut``.

    ``lut`` has (axis, param, responses) for the axes winding, bearing, demag,
    load, voltage and duty, a few points each.
    """

    healthy: DataFrame
    lut: DataFrame


def pick(column: str, table: dict[str, object]):
    """Constant per value of a column."""
    out = None
    for name, value in table.items():
        cond = F.col(column) == name
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return out


def build_motor(
    manifest: DataFrame,
    inputs: MotorInputs,
    freq_s: int = K.SAVE_FREQ_S,
    maintenance_per_month: float = 0.0,
    maintenance_h: float = 4.0,
    decoy_h: tuple[float, float] = (1.0, 4.0),
    method: str = "xxhash64",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Signals, labels and events of every device in ``manifest``."""
    draws = Draws("seed", method)
    lut = materialize(inputs.lut.select("axis", "param", *RESPONSES), "response-lut")
    healthy = materialize(inputs.healthy.select(*RESPONSES), "healthy")
    level = healthy.select(*[F.col(c).alias(f"level_{c}") for c in RESPONSES])
    devices = with_one_row(Y.prepared(manifest, freq_s, draws), level)
    devices = materialize(_shifted(devices, lut), "motor-devices")

    def undutied(rows: DataFrame) -> DataFrame:
        """Healthy level, noise, drift, voltage offset, ambient coupling."""
        r = ambient_resistance(F.col("time_h"), F.col("ambient_var_K"))
        values = {}
        for c in RESPONSES:
            x = F.col(f"level_{c}") + noise(
                c, SD[c], [KEY, "row_i"], draws, F.col("noise_scale")
            )
            x = x + F.col(f"_w_{c}")
            if c in (SPEED, CURRENT):
                x = x + F.col(f"shift_{c}")
            values[c] = x - F.col("_r") * 10.0 if c == SPEED else x
        for column, nominal, _ in K.MOTOR_WEAR.values():
            values[column] = F.lit(nominal)
        values["resistance_ohm"] = values["resistance_ohm"] + F.col("_r")
        df = Y.beside(rows, Y.UNIT).withColumn("_r", r).withColumns(values)
        return df.select(*[c for c in rows.columns if not c.startswith("_w_")], *SIGNALS)

    walk = (RESPONSES, K.MOTOR_DRIFT_SD_LONG, draws)
    # The duty factor works around the mean of the whole series, which is summed up without the walk's order.
    settings = ["ambient_var_K", "noise_scale", *[f"level_{c}" for c in RESPONSES], f"shift_{SPEED}", f"shift_{CURRENT}"]
    means = (
        undutied(Y.open_for_sums(Y.place_days(devices, freq_s, *walk), freq_s, *walk, settings))
        .groupBy(KEY)
        .agg(*[F.avg(c).alias(f"mean_{c}") for c in RESPONSES])
    )
    devices = materialize(devices.join(materialize(means, "means"), KEY), "motor-devices")
    days = Y.place_days(devices, freq_s, *walk)

    def base(rows: DataFrame) -> DataFrame:
        duty = duty_factor(F.col("time_h"), F.col("duty_cycle_var"), 0.4, smooth=False)
        df = undutied(rows)
        names = df.columns
        return Y.beside(df, Y.UNIT).withColumn("_duty", duty).withColumns(
            {c: around(F.col(c), F.col(f"mean_{c}"), F.col("_duty")) for c in RESPONSES}
        ).select(*names)

    events = _events(
        devices, lut, draws, freq_s, maintenance_per_month, maintenance_h, decoy_h
    )
    curves = materialize(curve_array(lut, RESPONSES), "curves")
    failures = materialize(_failures(devices, curves, freq_s), "failures")
    points = Y.points_of(events, "start_row", "post_row")
    firsts = Y.points_of(failures, "first_row")
    walked = Y.walked_at(days, points.unionByName(firsts), freq_s, *walk)
    anchors = materialize(base(walked), "anchors")
    placed = Y.anchored(events, anchors, RESPONSES, start="start_row", post="post_row")
    others = {f"other_{c}": F.coalesce(f"target_{c}", f"post_{c}") for c in RESPONSES}
    placed = materialize(
        placed.withColumns(others).select(
            KEY, "start_row", "end_row", "kind", *[f"start_{c}" for c in RESPONSES], *others
        ),
        "motor-events",
    )

    def with_events(rows: DataFrame) -> DataFrame:
        """Maintenance and decoys over the base series, laid over the rows unless they came with them; parameters stay."""
        if "_event" in rows.columns:
            joined = Y.unpacked(rows, "_event")
        else:
            joined = lay_over(rows, placed, **Y.block_bucket(freq_s))
        kind = F.col("kind")
        mixed = O.apply_mixes(
            joined,
            [
                (kind == "maintenance", O.shutdown_mixes(freq_s)),
                (kind.isNotNull(), {"stop": O.target_mix()}),
            ],
            GROUPS,
            SD,
            draws,
        )
        event = F.coalesce(kind, F.lit("normal")).alias("event_type")
        return mixed.select(*[c for c in rows.columns if c != "_event"], event)

    fixed = materialize(with_events(Y.only_at(anchors, firsts)), "anchors")
    laid = {"_event": placed, "_phase": _phases(failures, fixed, freq_s)}
    unit = dict.fromkeys([*settings, "duty_cycle_var", *[f"mean_{c}" for c in RESPONSES], *keep])
    rows = with_events(base(Y.open_days(days, freq_s, *walk, laid, unit)))
    return _with_failures(rows, freq_s, draws, keep)


def _shifted(devices: DataFrame, lut: DataFrame) -> DataFrame:
    """Speed and current shift of a device's voltage offset.

    The curve runs on as a straight line where an offset leaves its range.
    """
    at = devices.withColumns(
        {
            "_axis_v": F.lit("voltage"),
            "_volts": F.lit(K.MOTOR_V_NOM) + F.col("v_offset"),
            "_nominal": F.lit(K.MOTOR_V_NOM),
        }
    )
    volts = lut.where("axis = 'voltage'").withColumnRenamed("axis", "_axis_v")
    pair = [SPEED, CURRENT]
    at = interp(at, volts, "_volts", pair, "_axis_v", prefix="_at_", extend=True)
    at = interp(at, volts, "_nominal", pair, "_axis_v", prefix="_nom_", extend=True)
    return at.withColumns(
        {f"shift_{c}": F.col(f"_at_{c}") - F.col(f"_nom_{c}") for c in pair}
    ).drop("_axis_v", "_volts", "_nominal", *[f"{p}{c}" for p in ("_at_", "_nom_") for c in pair])


def _events(devices, lut, draws, freq_s, per_month, maintenance_h, decoy_h) -> DataFrame:
    """Accepted maintenance and decoy windows, decoys with their target values."""
    maintenance = schedule(
        devices,
        "maintenance",
        draws,
        freq_s,
        F.lit(per_month / 30.0),
        (0.5 * maintenance_h, 1.5 * maintenance_h),
    ).withColumn("amplitude", F.lit(0.0))
    decoys = schedule(
        devices,
        "decoy",
        draws,
        freq_s,
        F.when(F.size("decoy_types") > 0, F.col("decoy_freq_per_day")).otherwise(F.lit(0.0)),
        decoy_h,
        types=F.col("decoy_types"),
        amplitude=(0.4, 1.0),
    )
    cols = [
        KEY, "event_day", "event_in_day", "start_row", "proposed_end", "end_row", "kind",
        "amplitude",
    ]
    # unknown kinds are left out before windows are fitted, so they push out no other
    kinds = {f"decoy_{k}": axis for k, axis in K.MOTOR_DECOY_AXIS.items()}
    decoys = decoys.where(F.col("kind").isin(list(kinds)))
    m, d = fit_windows(maintenance.select(*cols), decoys.select(*cols), (freq_s, 86400))
    low = pick("axis", {a: v[0] for a, v in K.MOTOR_INPUTS.items()})
    high = pick("axis", {a: v[1] for a, v in K.MOTOR_INPUTS.items()})
    d = d.withColumn("axis", pick("kind", kinds))
    d = d.withColumn("_x", low + F.col("amplitude") * (high - low))
    d = interp(d, lut, "_x", RESPONSES, prefix="target_").drop("axis", "_x")
    return m.withColumn("post_row", F.col("end_row")).unionByName(
        d.withColumn("post_row", F.lit(None).cast("bigint")), allowMissingColumns=True
    )


def _failures(devices, curves, freq_s) -> DataFrame:
    """Failing devices with their wear curve and the row where speed gives out."""
    wear = {k: v for k, v in K.MOTOR_WEAR.items()}
    f = (
        devices.where("failure_type is not null")
        .withColumn("axis", F.col("failure_type"))
        .join(curves, "axis")
        .withColumns(
            {
                "wear_column": pick("axis", {k: v[0] for k, v in wear.items()}),
                "nominal": pick("axis", {k: v[1] for k, v in wear.items()}),
                "failed": pick("axis", {k: v[2] for k, v in wear.items()}),
                "span_s": F.lit(float(K.HORIZON_S)) * F.col("failure_severity"),
                "fail_start": F.floor(F.col("failure_start_day") * 86400.0 / freq_s),
            }
        )
        .withColumn("wear_rows", F.floor(F.col("span_s") / freq_s))
        .where("fail_start < n_rows")
        .withColumn("kind", F.concat(F.lit("failure_"), "axis"))
    )
    limit = F.col(f"level_{SPEED}") * K.MOTOR_FAIL_SPEED_FRACTION
    curve_rows = (
        f.withColumn("_r", F.explode(F.expr("sequence(0L, greatest(wear_rows - 1, 0L))")))
        .withColumn("row_i", F.col("fail_start") + F.col("_r"))
        .where("row_i < n_rows")
        .withColumn("_end", F.least(F.col("fail_start") + F.col("wear_rows"), F.col("n_rows") - 1))
    )
    wear_at = degrade(
        F.col("_r") * F.lit(float(freq_s)), F.col("nominal"), F.col("failed"), F.col("span_s")
    )
    slowing = with_curve(curve_rows, wear_at, [SPEED])
    crossed = first_crossing(slowing, f"ep_{SPEED}", limit, fallback="_end")
    return f.join(crossed, KEY).select(
        KEY, "seed", "kind", "curve", "wear_column", "nominal", "failed", "span_s", "wear_rows",
        "fail_start", "fail_row", "n_rows", F.lit(0).cast("bigint").alias("first_row"),
    )


def _phases(failures, fixed, freq_s) -> DataFrame:
    """Windows of each failure with the values they need; stored."""
    f = Y.anchored(failures, fixed, SIGNALS, start="first_row")
    wear = degrade(
        (F.col("fail_row") - F.col("fail_start")) * F.lit(float(freq_s)),
        F.col("nominal"),
        F.col("failed"),
        F.col("span_s"),
    )
    phases = Y.failure_phases(f.withColumn("final_wear", wear), freq_s, K.DOWNTIME_S, K.RESTART_S)
    failing = F.col("phase") == "failure"
    return materialize(
        phases.withColumns(
            {
                "curve": F.when(failing, F.col("curve")),
                "failure_kind": F.col("kind"),
            }
        ).drop("kind", "seed", "n_rows", "first_row"),
        "motor-failures",
    )


def _with_failures(rows, freq_s, draws, keep) -> DataFrame:
    """Wear, downtime and restart over the series; labels and the final columns."""
    phase = F.col("phase")
    joined = O.with_wear(Y.unpacked(rows, "_phase"), RESPONSES, freq_s)
    active = (phase == "failure") & (O.since() < F.col("wear_rows"))
    mixed = O.apply_mixes(
        joined,
        [
            (active, {"stop": O.wear_mix()}),
            (phase == "post_failure", O.downtime_mixes(freq_s, noise_share=0.3)),
            (
                phase == "startup",
                O.restart_mixes(F.col("end_row") - F.col("start_row"), from_start=True),
            ),
            (phase.isin("failure", "repaired"), O.REPAIRED),
        ],
        GROUPS,
        SD,
        draws,
        "failure",
    )
    follows = {c: F.col("wear_column") == c for c in PARAMS}
    params = {
        c: F.when(active & follows[c], F.col("_wear"))
        .when((phase == "post_failure") & follows[c], F.col("final_wear"))
        .when(phase.isin("startup", "repaired"), F.col(f"start_{c}"))
        .otherwise(F.col(c))
        for c in PARAMS
    }
    return Y.beside(mixed.withColumns(params), Y.UNIT).select(
        *Y.final_columns(SIGNALS, keep, freq_s, inclusive_extra=1)
    )
