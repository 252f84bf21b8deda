"""Long pump series: the whole build."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.curves import ambient_temperature, around, duty_factor, ease
from ..functions.derive import flow_gap
from ..functions.draws import Draws
from ..operators import overlay as O
from ..operators.intervals import fit_windows, lay_over, schedule
from ..operators.modulate import apply_pump_offsets, noise
from ..operators.spine import profile_table, template_mean, tile_profile, with_one_row
from ..session import materialize
from . import layers as Y

KEY = Y.KEY
SIGNALS = K.PUMP_SIGNALS
STOPPED = {c: K.PUMP_NOISE_SD[c] for c in K.PUMP_SPEEDS + K.PUMP_FLOWS}
GROUPS = {"stop": list(STOPPED), "cool": K.PUMP_TEMPS, "hold": K.PUMP_STATES}


@dataclass
class PumpInputs:
    """Measured tables: ``profile`` (phase, idx, signals), ``episodes`` (kind, idx, signals).

    Episode kinds are ``decoy_*`` and ``failure_*``. Each table has at most a
    few hundred rows per phase or kind.
    """

    profile: DataFrame
    episodes: DataFrame


def build_pump(
    manifest: DataFrame,
    inputs: PumpInputs,
    freq_s: int = K.SAVE_FREQ_S,
    maintenance_per_month: float = 0.0,
    maintenance_h: float = 4.0,
    decoy_h: tuple[float, float] = (1.0, 6.0),
    method: str = "xxhash64",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Signals, labels and events of every device in ``manifest``.

    ``keep`` names manifest columns to carry into the result.
    """
    draws = Draws("seed", method)
    cycle = K.CYCLE_S // freq_s
    startup = K.STARTUP_CYCLES * cycle
    profile = materialize(inputs.profile.select("phase", "idx", *SIGNALS), "profile")
    episodes = materialize(inputs.episodes.select("kind", "idx", *SIGNALS), "episodes")
    mean = template_mean(profile, SIGNALS)
    tiles = profile_table(profile, SIGNALS, startup, cycle)
    devices = with_one_row(Y.prepared(manifest, freq_s, draws), mean)

    walk = (K.PUMP_TEMPS, K.PUMP_DRIFT_SD, draws)
    days = Y.place_days(devices, freq_s, *walk)

    def base(rows: DataFrame) -> DataFrame:
        """Tiled profile, noise, drift, ambient, duty, device offsets."""
        df = Y.beside(tile_profile(rows, tiles, startup, cycle), Y.UNIT)
        warm = ambient_temperature(F.col("time_h"), F.col("ambient_var_K"))
        duty = duty_factor(F.col("time_h"), F.col("duty_cycle_var"), 0.6, smooth=True)
        df = df.withColumns({"_warm": warm, "_duty": duty})
        values = {}
        for c in SIGNALS:
            x = F.col(c)
            if K.PUMP_NOISE_SD[c] > 0:
                x = x + noise(c, K.PUMP_NOISE_SD[c], [KEY, "row_i"], draws, F.col("noise_scale"))
            if c in K.PUMP_TEMPS:
                x = x + F.col(f"_w_{c}") + F.col("_warm")
            if c in STOPPED:
                x = around(x, F.col(f"mean_{c}"), F.col("_duty"))
            values[c] = x
        return apply_pump_offsets(
            df.withColumns(values).drop("_warm", "_duty"),
            K.PUMP_SPEEDS,
            K.PUMP_FLOWS,
            F.col("v_offset"),
            F.col("p_offset"),
        ).select(*[c for c in rows.columns if not c.startswith("_w_")], *SIGNALS)

    lengths = materialize(
        episodes.groupBy("kind").agg((F.max("idx") + 1).alias("_len")), "episode-lengths"
    )
    events = _events(
        devices, lengths, draws, freq_s, maintenance_per_month, maintenance_h, decoy_h
    )
    points = Y.points_of(events, "start_row", "post_row")
    failures = _failures(devices, lengths, freq_s)
    ends = Y.points_of(failures, "fail_start", "fail_row")
    walked = Y.walked_at(days, points.unionByName(ends), freq_s, *walk)
    anchors = materialize(base(walked), "anchors")
    placed = _placed(events, anchors, episodes, draws)

    def with_events(rows: DataFrame) -> DataFrame:
        """Maintenance and decoys over the base series, laid over the rows unless they came with them."""
        if "_event" in rows.columns:
            joined = O.with_episode(rows, episodes, SIGNALS, O.since("_event.start_row"), "ep_", F.col("_event.kind"))
            joined = Y.unpacked(joined, "_event")
        else:
            joined = lay_over(rows, placed, **Y.block_bucket(freq_s))
            joined = O.with_episode(joined, episodes, SIGNALS, O.since(), "ep_")
        kind = F.col("kind")
        mixed = O.apply_mixes(
            joined,
            [
                (kind == "maintenance", O.shutdown_mixes(freq_s)),
                (kind.isNotNull(), O.splice_mixes(list(GROUPS), F.col("amplitude"))),
            ],
            GROUPS,
            K.PUMP_NOISE_SD,
            draws,
        )
        event = F.coalesce(kind, F.lit("normal")).alias("event_type")
        return mixed.select(*[c for c in rows.columns if c != "_event"], event)

    fixed = materialize(with_events(Y.only_at(anchors, ends)), "anchors")
    phases = _phases(failures, fixed, episodes, freq_s)

    settings = ["ambient_var_K", "duty_cycle_var", "noise_scale", "v_offset", "p_offset", *[f"mean_{c}" for c in STOPPED]]
    unit = dict.fromkeys([*settings, *keep])
    laid = {"_event": placed, "_phase": phases}
    rows = with_events(base(Y.open_days(days, freq_s, *walk, laid, unit)))
    return _with_failures(rows, episodes, freq_s, draws, keep)


def _events(devices, lengths, draws, freq_s, per_month, maintenance_h, decoy_h) -> DataFrame:
    """Accepted maintenance and decoy windows of all devices."""
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
        amplitude=(0.4, 1.6),
    )
    # A decoy stops when its recorded episode runs out; unknown kinds are left out.
    decoys = decoys.join(lengths, "kind").withColumn(
        "end_row", F.least("proposed_end", F.col("start_row") + F.col("_len"))
    )
    cols = [
        KEY, "seed", "event_day", "event_in_day", "start_row", "proposed_end", "end_row", "kind",
        "amplitude",
    ]
    m, d = fit_windows(maintenance.select(*cols), decoys.select(*cols), (freq_s, 86400))
    return m.withColumn("post_row", F.col("end_row")).unionByName(
        d.withColumn("post_row", F.lit(None).cast("bigint"))
    )


def _placed(events, anchors, episodes, draws) -> DataFrame:
    """Event windows with the fixed values their rows are mixed from; stored."""
    at = Y.anchored(events, anchors, SIGNALS, pre="start_row", other="post_row")
    at = O.with_episode(at, episodes, SIGNALS, F.lit(0), "ep0_")
    spliced = O.splice_starts(SIGNALS, draws, F.col("amplitude"), K.PUMP_NOISE_SD)
    stops = F.col("kind") == "maintenance"
    starts = {
        f"start_{c}": F.when(stops, F.col(f"pre_{c}")).otherwise(spliced[f"start_{c}"])
        for c in SIGNALS
    }
    return materialize(
        at.withColumns(starts).select(
            KEY, "start_row", "end_row", "kind", "amplitude", *starts,
            *[f"other_{c}" for c in GROUPS["stop"] + GROUPS["cool"]],
        ),
        "pump-events",
    )


def _failures(devices, lengths, freq_s) -> DataFrame:
    """Failing devices with the rows their episode runs over."""
    start = F.floor(F.col("failure_start_day") * 86400.0 / freq_s)
    return (
        devices.where("failure_type is not null")
        .withColumn("kind", F.concat(F.lit("failure_"), "failure_type"))
        .join(lengths, "kind")
        .withColumn("fail_start", start)
        .where("fail_start < n_rows")
        .withColumn(
            "fail_row",
            F.least(
                F.col("fail_start") + F.floor(F.col("_len") / F.col("failure_severity")),
                F.col("n_rows"),
            )
            - 1,
        )
        .where("fail_row >= fail_start")
        .select(
            KEY, "seed", "kind", "failure_severity", "fail_start", "fail_row", "n_rows",
            *[f"mean_{c}" for c in GROUPS["hold"]],
        )
    )


def _phases(failures, fixed, episodes, freq_s) -> DataFrame:
    """Windows of each failure with the values they start from."""
    f = Y.anchored(failures, fixed, SIGNALS, pre="fail_start", last="fail_row")
    f = O.with_episode(f, episodes, SIGNALS, F.lit(0), "ep0_")
    r = F.col("fail_row") - F.col("fail_start")
    f = O.with_episode(
        f, episodes, SIGNALS, F.floor(r * F.col("failure_severity")).cast("bigint"), "end_"
    )
    b = F.least(F.lit(K.BLEND_ROWS), r + 1)
    a = F.when(r < b, ease(r, b)).otherwise(F.lit(1.0))
    hot = {
        c: (1.0 - a) * F.col(f"last_{c}")
        + a * (F.col(f"end_{c}") + F.col(f"pre_{c}") - F.col(f"ep0_{c}"))
        for c in SIGNALS
    }
    f = f.withColumns({f"hot_{c}": x for c, x in hot.items()})
    spliced = O.splice_starts(SIGNALS, None)
    healthy = {c: F.col(f"mean_{c}") for c in GROUPS["hold"]}
    phase = F.col("phase")
    starts = {
        f"start_{c}": F.when(phase == "failure", spliced[f"start_{c}"])
        .when(phase == "post_failure", F.col(f"hot_{c}"))
        .otherwise(healthy.get(c, F.lit(0.0)))
        for c in SIGNALS
    }
    return materialize(
        Y.failure_phases(f, freq_s, K.DOWNTIME_S, K.RESTART_S)
        .withColumns(starts)
        .select(
            KEY, "phase", "start_row", "end_row", F.col("kind").alias("failure_kind"),
            F.col("failure_severity").alias("severity"), "fail_start", "fail_row", *starts,
        ),
        "pump-failures",
    )


def _with_failures(rows, episodes, freq_s, draws, keep) -> DataFrame:
    """Failure, downtime and restart over the series; labels and the final columns."""
    phase = F.col("phase")
    kind = F.when(F.col("_phase.phase") == "failure", F.col("_phase.failure_kind"))
    idx = F.floor(O.since("_phase.start_row") * F.col("_phase.severity")).cast("bigint")
    joined = O.with_episode(rows, episodes, SIGNALS, idx, "ep_", kind)
    mixed = O.apply_mixes(
        Y.unpacked(joined, "_phase"),
        [
            (phase == "failure", O.splice_mixes(list(GROUPS), None)),
            (phase == "post_failure", O.downtime_mixes(freq_s)),
            (phase == "startup", O.restart_mixes(F.col("end_row") - F.col("start_row"))),
            (phase == "repaired", O.REPAIRED),
        ],
        GROUPS,
        K.PUMP_NOISE_SD,
        draws,
        "failure",
    )
    gap = flow_gap(F.col("flow_in_m3s"), F.col("flow_out_m3s"))
    return Y.beside(mixed, Y.UNIT).select(*Y.final_columns(SIGNALS, keep, freq_s), gap.alias("flow_gap_m3s"))
