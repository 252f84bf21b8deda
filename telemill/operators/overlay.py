"""What an event does to the signals of the rows in its window.

Inside a window every signal becomes a weighted sum of a few values: the row's
own value, a start value fixed for the window, a second fixed value, a recorded
episode, noise and the ambient level. An event kind is therefore a set of
weights per group of signals (``Mix``): ``stop`` for signals that fall to zero,
``cool`` for temperatures, ``hold`` for state. The weights are worked out once
per row and shared by all signals, which keeps the generated code small.

``start_*``, ``other_*`` and ``ep_*`` columns come with the window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    BLEND_ROWS,
    COOLING_TAU_S,
    PUMP_T_AMBIENT,
    RAMP_ROWS_MAX,
    RAMP_SHARE,
    STEP_ROWS,
)
from ..functions.curves import degrade, ease
from ..functions.draws import Draws
from ..session import materialize
from .intervals import BUCKET, lay_over
from .joins import with_anchors
from .lut import with_curve

KEY, ROW = "device_id", "row_i"


@dataclass
class Mix:
    """Weights of one event for one group of signals; None stands for 0."""

    own: Column | float | None = None
    start: Column | float | None = None
    other: Column | float | None = None
    episode: Column | float | None = None
    noise: Column | float | None = None
    level: Column | float | None = None


Mixes = dict[str, Mix]
UNCHANGED = Mix(own=1.0)


def since(start: str = "start_row") -> Column:
    return F.col(ROW) - F.col(start)


def _length() -> Column:
    return F.col("end_row") - F.col("start_row")


def event_noise(stream: str, col: str, draws: Draws, row: str = ROW) -> Column:
    """Standard normal of one signal in one row under an event."""
    return draws.standard_normal([KEY, row], f"{stream}_{col}")


def apply_mixes(
    joined: DataFrame,
    events: Sequence[tuple[Column, Mixes]],
    groups: dict[str, Sequence[str]],
    sd_by_col: dict[str, float],
    draws: Draws,
    stream: str = "event",
    ambient: float = PUMP_T_AMBIENT,
) -> DataFrame:
    """Replace the signals of rows whose window meets one of the conditions.

    Noise is drawn only where its weight isn't zero.
    """
    weights, hashes, used = {}, {}, {}
    for group in groups:
        for part in (f.name for f in fields(Mix)):
            given = [(cond, getattr(m.get(group, UNCHANGED), part)) for cond, m in events]
            if all(w is None for _, w in given):
                continue
            w = F.lit(None).cast("double")
            for cond, weight in reversed(given):
                w = F.when(cond, F.lit(0.0 if weight is None else weight)).otherwise(w)
            name = f"_{part}_{group}"
            weights[name] = w
            used.setdefault(group, []).append(part)
    values = {}
    for group, cols in groups.items():
        parts = used.get(group, [])
        if not parts:
            continue
        for c in cols:
            terms = {
                "own": F.col(c),
                "start": F.col(f"start_{c}"),
                "other": F.coalesce(F.col(f"other_{c}"), F.lit(0.0)) if "other" in parts else None,
                "episode": F.coalesce(F.col(f"ep_{c}"), F.lit(0.0)) if "episode" in parts else None,
                "level": F.lit(float(ambient)),
            }
            if "start" in parts and len(events) > 1:
                terms["start"] = F.coalesce(terms["start"], F.lit(0.0))
            total = None
            for part in parts:
                w = F.col(f"_{part}_{group}")
                if part == "noise":
                    sd = sd_by_col.get(c, 0.0)
                    if sd == 0:
                        continue
                    hashed = draws.hashed([KEY, ROW], f"{stream}_{c}")
                    if hashed is None:
                        drawn = event_noise(stream, c, draws)
                    else:
                        hashes[f"_h_{c}"] = F.when(weights[f"_noise_{group}"] != 0, hashed)
                        drawn = draws.normal_of(f"_h_{c}")
                    term = F.when(w != 0, w * F.lit(sd) * drawn).otherwise(F.lit(0.0))
                else:
                    term = w * terms[part]
                total = term if total is None else total + term
            first = F.col(f"_{parts[0]}_{group}")
            values[c] = F.when(first.isNotNull(), total).otherwise(F.col(c))
    return joined.withColumns({**weights, **hashes}).withColumns(values).drop(*weights, *hashes)


def _laid(
    rows: DataFrame, windows: DataFrame, bucket: tuple[int, int], mixes, groups, sd, draws, **kw
) -> DataFrame:
    """Lay windows over rows, apply one kind of event, keep the rows' columns."""
    joined = lay_over(rows, windows, bucket=bucket)
    inside = F.col("start_row").isNotNull()
    return apply_mixes(joined, [(inside, mixes)], groups, sd, draws, **kw).select(*rows.columns)


# -- maintenance -------------------------------------------------------------


def shutdown_mixes(freq_s: int) -> Mixes:
    """Controlled stop: ramp down, stand still, ramp up to the value after the window."""
    r, n = since(), _length()
    ramp = F.least(F.lit(RAMP_ROWS_MAX), F.floor(n / 4))
    width = F.greatest(ramp, F.lit(1))
    down, up = r < ramp, r >= n - ramp
    falling, rising = 1.0 - ease(r, width), ease(r - (n - ramp), width)
    hot = F.when(ramp > 0, 1.0 - ease(ramp - 1, width)).otherwise(F.lit(1.0))
    decay = hot * F.exp(-(r - ramp) / F.lit(float(COOLING_TAU_S) / freq_s))
    start = F.when(down, falling).otherwise(F.lit(0.0))
    other = F.when(~down & up, rising).otherwise(F.lit(0.0))
    noise = F.when(down | up, F.lit(0.0)).otherwise(F.lit(0.3))
    cooling = F.when(down, falling).when(up, F.lit(0.0)).otherwise(decay)
    return {
        "stop": Mix(start=start, other=other, noise=noise),
        "cool": Mix(start=cooling, other=other, noise=noise, level=1.0 - cooling - other),
    }


def overlay_shutdown(
    rows: DataFrame,
    windows: DataFrame,
    stopped: dict[str, float],
    cooled: dict[str, float],
    freq_s: int,
    draws: Draws,
    ambient: float = PUMP_T_AMBIENT,
    bucket: tuple[int, int] = BUCKET,
) -> DataFrame:
    """Maintenance windows over rows; the two maps give each signal's noise spread."""
    cols = [*stopped, *cooled]
    placed = with_anchors(
        windows.select(KEY, "start_row", "end_row"),
        rows,
        {"start_": ("start_row", cols), "other_": ("end_row", cols)},
    )
    groups = {"stop": list(stopped), "cool": list(cooled)}
    return _laid(
        rows, placed, bucket, shutdown_mixes(freq_s), groups, {**stopped, **cooled}, draws,
        ambient=ambient,
    )


# -- episodes ----------------------------------------------------------------


def scale_episode(episode: Column, base: Column, amplitude: Column) -> Column:
    """Scale an episode's deviation from the base level."""
    return base + amplitude * (episode - base)


def with_episode(
    windows_or_rows: DataFrame,
    episodes: DataFrame,
    cols: Sequence[str],
    idx: Column,
    prefix: str,
    kind: Column | None = None,
) -> DataFrame:
    """Add episode values at ``idx`` for ``kind``, by default the column of that name.

    An episode table has one row per (kind, idx): a few hundred rows per kind. Its values are joined as
    one struct, which is copied as a whole.
    """
    kind = F.col("kind") if kind is None else kind
    e = episodes.select(
        F.col("kind").alias("_kind"),
        F.col("idx").alias("_idx"),
        F.struct(*[F.col(c).alias(f"{prefix}{c}") for c in cols]).alias("_episode"),
    )
    joined = windows_or_rows.join(e, (kind == F.col("_kind")) & (idx == F.col("_idx")), "left")
    return joined.select(*windows_or_rows.columns, *[F.col("_episode")[f"{prefix}{c}"].alias(f"{prefix}{c}") for c in cols])


def fade_in(blend: int = BLEND_ROWS) -> Column:
    """Cosine rise over the first rows of a window, then 1."""
    r = since()
    b = F.least(F.lit(int(blend)), _length())
    return F.when(r < b, ease(r, b)).otherwise(F.lit(1.0))


def splice_mixes(groups: Sequence[str], amplitude: Column | None, blend: int = BLEND_ROWS) -> Mixes:
    """Fade over to the episode, shifted to meet the series at its first row.

    With an amplitude the episode is scaled and noise of twice the usual spread
    is added; the base level it is scaled around cancels out in the shift.
    """
    a = fade_in(blend)
    if amplitude is None:
        mix = Mix(own=1.0 - a, start=a, episode=a)
    else:
        mix = Mix(own=1.0 - a, start=a, episode=a * amplitude, noise=2.0 * a)
    return {g: mix for g in groups}


def splice_starts(
    cols: Sequence[str],
    draws: Draws,
    amplitude: Column | None = None,
    sd_by_col: dict[str, float] | None = None,
    stream: str = "event",
) -> dict[str, Column]:
    """Per window: what the episode has to be shifted by (from ``pre_*``, ``ep0_*``)."""
    out = {}
    for c in cols:
        first = F.col(f"ep0_{c}")
        if amplitude is not None:
            sd = (sd_by_col or {}).get(c, 0.0)
            first = amplitude * first
            if sd > 0:
                first = first + 2.0 * sd * event_noise(stream, c, draws, "start_row")
        out[f"start_{c}"] = F.col(f"pre_{c}") - first
    return out


def splice(
    rows: DataFrame,
    windows: DataFrame,
    episodes: DataFrame,
    cols: Sequence[str],
    draws: Draws = Draws(),
    speed_up: Column | None = None,
    amplitude: Column | None = None,
    sd_by_col: dict[str, float] | None = None,
    blend: int = BLEND_ROWS,
) -> DataFrame:
    """Lay episodes over the rows of their windows (which need a ``kind``).

    ``speed_up`` (a window column, 1 = as recorded) runs through the episode faster. The windows
    are opened into the rows they cover and get their episode values there, so rows outside
    of windows never meet the episodes, which are stored and read once.
    """
    idx = since() if speed_up is None else F.floor(since() * speed_up).cast("bigint")
    stored = materialize(episodes.select("kind", "idx", *cols), "episodes")
    placed = with_anchors(windows, rows, {"pre_": ("start_row", list(cols))})
    placed = with_episode(placed, stored, cols, F.lit(0), "ep0_")
    placed = placed.withColumns(splice_starts(cols, draws, amplitude, sd_by_col))
    shared = [c for c in placed.columns if c in rows.columns and c != KEY]
    opened = (
        placed.drop(*shared)
        .where("end_row > start_row")
        .withColumn("row_i", F.explode(F.expr("sequence(start_row, end_row - 1)")))
    )
    opened = with_episode(opened, stored, cols, idx, "ep_")
    right = opened.withColumnRenamed(KEY, "_key").withColumnRenamed("row_i", "_row")
    joined = rows.join(right, (F.col(KEY) == F.col("_key")) & (F.col("row_i") == F.col("_row")), "left")
    inside = F.col("start_row").isNotNull()
    mixes = splice_mixes(["all"], amplitude, blend)
    return apply_mixes(
        joined, [(inside, mixes)], {"all": list(cols)}, sd_by_col or {}, draws
    ).select(*rows.columns)


def target_mix() -> Mix:
    """Cosine move from the first value to the target.

    Kinds that end in ``ramp`` take 0.6 of the window, others five rows.
    """
    span = F.when(
        F.col("kind").endswith("ramp"), F.greatest(F.lit(1.0), _length() * RAMP_SHARE)
    ).otherwise(F.lit(float(STEP_ROWS)))
    a = ease(F.least(F.lit(1.0), since() / span), 1.0)
    return Mix(start=1.0 - a, other=a, noise=1.0)


def overlay_target(
    rows: DataFrame,
    windows: DataFrame,
    sd_by_col: dict[str, float],
    draws: Draws,
    bucket: tuple[int, int] = BUCKET,
) -> DataFrame:
    """Move the signals to ``other_*`` (on the windows) over each window."""
    cols = list(sd_by_col)
    placed = with_anchors(windows, rows, {"start_": ("start_row", cols)})
    return _laid(rows, placed, bucket, {"all": target_mix()}, {"all": cols}, sd_by_col, draws)


# -- failure -----------------------------------------------------------------


def with_wear(
    joined: DataFrame, responses: Sequence[str], freq_s: int, prefix: str = "ep_"
) -> DataFrame:
    """Wear of a row inside a failure window and the responses it leads to.

    Windows carry ``curve`` (see ``curve_array``), ``nominal``, ``failed`` and
    ``span_s``. Adds ``_wear`` and the responses.
    """
    wear = degrade(
        since() * F.lit(float(freq_s)), F.col("nominal"), F.col("failed"), F.col("span_s")
    )
    return with_curve(joined.withColumn("_wear", wear), F.col("_wear"), responses, prefix).drop(
        "curve"
    )


def wear_mix(blend: int = BLEND_ROWS) -> Mix:
    """Fade over to the response curve, with fresh noise."""
    r = since()
    a = F.when(r < blend, ease(r, float(blend))).otherwise(F.lit(1.0))
    return Mix(own=1.0 - a, episode=a, noise=1.0)


def failure_curve(
    rows: DataFrame,
    windows: DataFrame,
    sd_by_col: dict[str, float],
    wear_columns: Sequence[str],
    freq_s: int,
    draws: Draws,
    bucket: tuple[int, int] = BUCKET,
) -> DataFrame:
    """Wear that drives the signals along a response curve.

    ``wear_column`` on the windows names the parameter column that follows it.
    """
    cols = list(sd_by_col)
    joined = with_wear(lay_over(rows, windows, bucket=bucket), cols, freq_s)
    inside = F.col("start_row").isNotNull()
    out = apply_mixes(
        joined, [(inside, {"all": wear_mix()})], {"all": cols}, sd_by_col, draws, "failure"
    )
    worn = {
        c: F.when(F.col("wear_column") == c, F.col("_wear")).otherwise(F.col(c))
        for c in wear_columns
    }
    return out.withColumns(worn).select(*rows.columns)


def downtime_mixes(freq_s: int, noise_share: float = 0.5) -> Mixes:
    """Standstill after a failure; ``start_*`` holds the values of the failure row."""
    left = F.exp(-since() / F.lit(float(COOLING_TAU_S) / freq_s))
    return {
        "stop": Mix(noise=noise_share),
        "cool": Mix(start=left, level=1.0 - left, noise=0.3),
        "hold": Mix(start=1.0),
    }


def overlay_downtime(
    rows: DataFrame,
    failures: DataFrame,
    stopped: dict[str, float],
    cooled: dict[str, float],
    frozen: Sequence[str],
    rows_down: int,
    freq_s: int,
    draws: Draws,
    noise_share: float = 0.5,
    ambient: float = PUMP_T_AMBIENT,
    bucket: tuple[int, int] = BUCKET,
) -> DataFrame:
    """Lay the downtime over the ``rows_down`` rows after each ``fail_row``."""
    placed = with_anchors(
        failures.select(KEY, "fail_row"), rows, {"start_": ("fail_row", [*cooled, *frozen])}
    ).withColumns(
        {
            "start_row": F.col("fail_row") + 1,
            "end_row": F.col("fail_row") + 1 + F.lit(int(rows_down)),
        }
    )
    groups = {"stop": list(stopped), "cool": list(cooled), "hold": list(frozen)}
    return _laid(
        rows, placed, bucket, downtime_mixes(freq_s, noise_share), groups,
        {**stopped, **cooled}, draws, stream="failure", ambient=ambient,
    )


def restart_mixes(length: Column, from_zero: bool = False, from_start: bool = False) -> Mixes:
    """Cosine return to work over ``length`` rows; state takes ``start_*`` at once.

    Temperatures rise from ambient, or from zero with ``from_zero``. With
    ``from_start`` the ramp leads to the fixed start value plus noise instead
    of the row's own value.
    """
    r = since()
    a = F.when(r < length, ease(r, length)).otherwise(F.lit(1.0))
    stop = Mix(start=a, noise=a) if from_start else Mix(own=a)
    cool = Mix(own=a) if from_zero else Mix(own=a, level=1.0 - a)
    return {"stop": stop, "cool": cool, "hold": Mix(start=1.0)}


REPAIRED: Mixes = {"stop": UNCHANGED, "cool": UNCHANGED, "hold": Mix(start=1.0)}


def overlay_restart(
    rows: DataFrame,
    restarts: DataFrame,
    ramped: Sequence[str],
    warmed: Sequence[str],
    reset: Sequence[str],
    rows_up: int,
    ambient: float = PUMP_T_AMBIENT,
    from_zero: bool = False,
    bucket: tuple[int, int] = BUCKET,
) -> DataFrame:
    """Restart from ``start_row`` (up to ``end_row``, the end of the series).

    ``restarts`` carries ``start_*`` for the ``reset`` columns.
    """
    length = F.least(F.lit(int(rows_up)), _length())
    groups = {"stop": list(ramped), "cool": list(warmed), "hold": list(reset)}
    return _laid(
        rows, restarts, bucket, restart_mixes(length, from_zero), groups, {}, Draws(),
        ambient=ambient,
    )
