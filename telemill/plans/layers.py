"""Steps shared by the long-series builds.

A build keeps one layout from start to end: the (device, day) table is placed
once, while it is tiny, and opened into rows afterwards. Days are placed in blocks of
``BLOCK_DAYS``, so that a device's rows end up in few files. Running values and
interval joins all work on (device, block), so no step moves rows
between tasks. Values at single rows (anchors) and means need no running value per
row: hash draws can be repeated, and sums of them say what the walk is there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import NO_FAILURE_TTF
from ..functions.draws import Draws
from ..operators.intervals import lay_over_spans
from ..operators.joins import with_anchor
from ..operators.labels import label_values
from ..operators.manifest import default_severity, default_start_day
from ..operators.spine import day_rows, day_table, place, row_count
from ..session import materialize

KEY = "device_id"
#: Days of a device that one task builds and writes together.
BLOCK_DAYS = 14
#: Struct of a device's settings on its opened rows.
UNIT = "_unit"


def block_bucket(freq_s: int) -> dict:
    """How ``lay_over`` meets rows that are placed by (device, block)."""
    return {"bucket": (freq_s, 86400 * BLOCK_DAYS), "bucket_col": "block"}


def prepared(manifest: DataFrame, freq_s: int, draws: Draws) -> DataFrame:
    """Manifest with its defaults filled in and ``n_rows``; stored, as many steps read it."""
    failing = F.col("failure_type").isNotNull()
    filled = manifest.withColumns(
        {
            "n_rows": row_count(F.col("duration_days"), freq_s),
            "failure_start_day": F.when(
                failing,
                default_start_day(F.col("failure_start_day"), F.col("duration_days"), [KEY], draws),
            ),
            "failure_severity": default_severity(F.col("failure_severity"), [KEY], draws),
        }
    )
    return materialize(filled, "manifest")


def place_days(
    devices: DataFrame, freq_s: int, cols: Sequence[str], sd: float, draws: Draws
) -> DataFrame:
    """The (device, day) table with the random walk reached before each day, placed by block.

    A day's total step is drawn as one normal of the right spread, so the walk
    between days needs no pass over the rows; ``open_days`` fills in the rows of
    a day given its total. The result has the law of independent steps per row.
    """
    n = (F.col("_to") - F.col("_from") + 1).cast("double")
    total = {
        f"_t_{c}": draws.normal([KEY, "day"], f"drift_day_{c}", 0.0, F.lit(sd) * F.sqrt(n))
        for c in cols
    }
    earlier = Window.partitionBy(KEY).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    reached = {f"_c_{c}": F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0.0)) for c in cols}
    days = day_table(devices, freq_s).withColumns(total).withColumns(reached)
    return place(days.withColumn("block", F.expr(f"day div {BLOCK_DAYS}")), [KEY, "block"])


def _sized(days: DataFrame, cols: Sequence[str], unit: Iterable[str] | None) -> DataFrame:
    """Days with their first row and number of rows, which stay when they are cut, and the walk's values in a struct ``_day``.

    With ``unit`` those columns become the struct ``UNIT`` and no others stay: a row's plain
    columns are copied one by one at every step, a struct as a whole.
    """
    walk = [f"_{p}_{c}" for p in "ct" for c in cols]
    sized = days.withColumn(
        "_day", F.struct(F.col("_from").alias("_first"), F.expr("_to - _from + 1").alias("_n"), *walk)
    ).drop(*walk)
    if unit is None:
        return sized
    return sized.select(KEY, "seed", "block", "day", "_from", "_to", "_day", F.struct(*unit).alias(UNIT))


def _with_steps(
    sized: DataFrame, freq_s: int, cols: Sequence[str], sd: float, draws: Draws
) -> DataFrame:
    """Rows of the days with a step ``_z_*`` each."""
    steps = {f"_z_{c}": draws.normal([KEY, "row_i"], f"drift_{c}", 0.0, sd) for c in cols}
    return day_rows(sized, freq_s).withColumns(steps)


def _timed(rows: DataFrame, freq_s: int) -> DataFrame:
    """``time_s`` and ``time_h`` once more, so that they needn't be carried from where rows are opened."""
    time_s = F.col("row_i") * F.lit(int(freq_s))
    return rows.withColumns({"time_s": time_s, "time_h": time_s / F.lit(3600.0)})


def _cut(days: DataFrame, freq_s: int, laid: dict[str, DataFrame]) -> tuple[DataFrame, list[str]]:
    """The days cut at the edges of all windows and placed again; names of sets whose windows overlap.

    Windows of the other sets are structs, those of overlapping sets still arrays.
    """
    for name, windows in laid.items():
        days = lay_over_spans(days, windows, name, (freq_s, 86400), "day")
    spans = materialize(days, "spans")
    most = spans.agg(*[F.max(F.size(name)).alias(name) for name in laid]).first()
    crowded = [name for name in laid if (most[name] or 0) > 1]
    one = {name: F.get(name, F.lit(0)) for name in laid if name not in crowded}
    placed = place(spans, [KEY, "block"]).sortWithinPartitions(KEY, "block", "day", "_from")
    return placed.withColumns(one), crowded


def unpacked(rows: DataFrame, name: str) -> DataFrame:
    """Rows with the columns of their window ``name``; a column that the rows have keeps their value."""
    return beside(rows, name).drop(name)


def beside(rows: DataFrame, name: str) -> DataFrame:
    """Rows with the fields of their struct ``name``, if they have it, as columns too; a column that the rows have keeps its value."""
    if name not in rows.columns:
        return rows
    fields = [f for f in rows.schema[name].dataType.names if f not in rows.columns]
    return rows.select("*", *[F.col(name)[f].alias(f) for f in fields])


def open_days(
    days: DataFrame,
    freq_s: int,
    cols: Sequence[str],
    sd: float,
    draws: Draws,
    laid: dict[str, DataFrame] | None = None,
    unit: Iterable[str] | None = None,
) -> DataFrame:
    """Rows of the placed days with the walk so far as ``_w_*``, and the columns ``unit`` of the days as a struct ``UNIT``.

    ``laid`` names sets of windows; each row gets its window of a set as a struct of that name (see
    ``unpacked``), null where there is none. The days are cut at the windows' edges while
    they are few, so no row is compared with a window; a row in several windows of one set comes once
    for each.
    """
    sized = _sized(days, cols, unit)
    days, crowded = _cut(sized, freq_s, laid) if laid else (sized, [])
    # one order for both sums, so that rows are gone through once
    day = Window.partitionBy(KEY, "block", "day").orderBy("row_i")
    so_far = day.rowsBetween(Window.unboundedPreceding, 0)
    all_day = day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    of_day = F.col("_day")
    share = (F.col("row_i") - of_day["_first"] + 1) / of_day["_n"]
    rows = _with_steps(days, freq_s, cols, sd, draws)
    sums = {f"_s_{c}": F.sum(f"_z_{c}").over(so_far) for c in cols}
    whole = {f"_d_{c}": F.sum(f"_z_{c}").over(all_day) for c in cols}
    walk = {
        f"_w_{c}": of_day[f"_c_{c}"]
        + F.col(f"_s_{c}")
        - share * (F.col(f"_d_{c}") - of_day[f"_t_{c}"])
        for c in cols
    }
    walked = (
        _timed(rows.drop("time_s", "time_h").withColumns({**sums, **whole}), freq_s)
        .withColumns(walk)
        .drop("_day", *[f"_{p}_{c}" for p in "zsd" for c in cols])
    )
    for name in crowded:
        walked = walked.withColumn(name, F.explode_outer(name))
    return walked


def open_for_sums(
    days: DataFrame, freq_s: int, cols: Sequence[str], sd: float, draws: Draws, unit: Iterable[str] | None = None
) -> DataFrame:
    """Rows of the days whose ``_w_*`` add up to those of ``open_days`` over each day.

    The walk at a row sums the steps up to it, so over a day of n rows a step counts as often
    as there are rows from it on, and the bridge to the day's total takes (n + 1) / 2
    times the gap. Each row's share of that needs no order, so sums and means of a
    build need neither a sort nor a window.
    """
    of_day = F.col("_day")
    after = of_day["_n"] - (F.col("row_i") - of_day["_first"])
    middle = (of_day["_n"] + 1) / F.lit(2.0)
    walk = {
        f"_w_{c}": of_day[f"_c_{c}"]
        + F.col(f"_z_{c}") * (after - middle)
        + of_day[f"_t_{c}"] * middle / of_day["_n"]
        for c in cols
    }
    rows = _with_steps(_sized(days, cols, unit), freq_s, cols, sd, draws).withColumns(walk)
    return rows.drop("_day", *[f"_z_{c}" for c in cols])


def at_rows(
    days: DataFrame,
    points: DataFrame,
    freq_s: int,
    cols: Sequence[str],
    sd: float,
    draws: Draws,
    build: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Built rows at the given (device, row) points only; stored."""
    return materialize(build(walked_at(days, points, freq_s, cols, sd, draws)), "anchors")


def only_at(rows: DataFrame, points: DataFrame) -> DataFrame:
    """Those rows that are among the points."""
    return rows.join(points.distinct(), [KEY, "row_i"], "left_semi")


def walked_at(
    days: DataFrame, points: DataFrame, freq_s: int, cols: Sequence[str], sd: float, draws: Draws
) -> DataFrame:
    """Rows with the walk as ``_w_*`` at the given (device, row) points only; stored.

    One call for all points of a build draws the steps of a day once, however many sets have points in it. The days that hold a point are cut behind each point. Steps are summed per piece, which
    needs no order and few columns, and the sums of a day's pieces give its walk
    at the points.
    """
    named = materialize(
        points.distinct().select(KEY, "row_i", F.expr(f"(row_i * {int(freq_s)}) div 86400").alias("day")),
        "points",
    )
    held = days.select(KEY, "day", "seed", "_from", "_to")
    of_day = Window.partitionBy(KEY, "day").orderBy("_end")
    ends = held.join(named, [KEY, "day"]).select(*held.columns, F.col("row_i").alias("_end"))
    pieces = (
        ends.unionByName(ends.withColumn("_end", F.col("_to")).distinct())
        .distinct()
        .withColumn("_start", F.coalesce(F.lag("_end").over(of_day) + 1, F.col("_from")))
        .select(KEY, "seed", "day", F.col("_from").alias("_first"), F.col("_start").alias("_from"), F.col("_end").alias("_to"), "_end")
    )
    steps = {f"_z_{c}": draws.normal([KEY, "row_i"], f"drift_{c}", 0.0, sd) for c in cols}
    sums = (
        day_rows(place(pieces, [KEY, "day", "_end"]), freq_s)
        .groupBy(KEY, "day", "_end", "_first")
        .agg(*[F.sum(z).alias(f"_p_{c}") for c, z in zip(cols, steps.values(), strict=True)])
    )
    so_far = of_day.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(KEY, "day")
    reached = sums.select(
        KEY, "day", F.col("_end").alias("row_i"), "_first",
        *[F.sum(f"_p_{c}").over(so_far).alias(f"_s_{c}") for c in cols],
        *[F.sum(f"_p_{c}").over(whole).alias(f"_d_{c}") for c in cols],
    )
    share = (F.col("row_i") - F.col("_first") + 1) / (F.col("_to") - F.col("_from") + 1)
    walk = {
        f"_w_{c}": F.col(f"_c_{c}") + F.col(f"_s_{c}") - share * (F.col(f"_d_{c}") - F.col(f"_t_{c}"))
        for c in cols
    }
    rows = (
        days.join(reached.join(named, [KEY, "day", "row_i"], "left_semi"), [KEY, "day"])
        .withColumns(walk)
        .withColumns({"time_s": F.col("row_i") * F.lit(int(freq_s)), "time_h": F.col("row_i") * F.lit(int(freq_s)) / F.lit(3600.0)})
        .drop("_first", "_from", "_to", "_last", *[f"_{p}_{c}" for p in "csdt" for c in cols])
    )
    return materialize(rows, "walk-at-points")


def points_of(windows: DataFrame, *columns: str) -> DataFrame:
    """The rows named by the given columns, as (device, ``row_i``)."""
    return windows.select(
        KEY, F.explode(F.array(*[F.col(c).cast("bigint") for c in columns])).alias("row_i")
    ).where("row_i is not null")


def anchored(
    windows: DataFrame, anchors: DataFrame, cols: Sequence[str], **at: str
) -> DataFrame:
    """Add anchor values: ``prefix=row column``."""
    for prefix, column in at.items():
        windows = with_anchor(windows, anchors, cols, column, f"{prefix}_")
    return windows


def failure_phases(failures: DataFrame, freq_s: int, down_s: int, up_s: int) -> DataFrame:
    """Windows of a failure and its aftermath, cut at the end of the series.

    ``failures`` has one row per failing device with ``fail_start``,
    ``fail_row`` and ``n_rows``. The phases follow each other: failure,
    post_failure, startup, repaired.
    """
    end = F.col("fail_row") + 1
    down = end + down_s // freq_s
    up = down + up_s // freq_s
    spans = [
        ("failure", F.col("fail_start"), end),
        ("post_failure", end, down),
        ("startup", down, up),
        ("repaired", up, F.col("n_rows")),
    ]
    phases = F.array(
        *[
            F.struct(
                F.lit(name).alias("phase"),
                s.cast("bigint").alias("s"),
                F.least(e, F.col("n_rows")).cast("bigint").alias("e"),
            )
            for name, s, e in spans
        ]
    )
    return (
        failures.withColumn("_p", F.explode(phases))
        .where("_p.e > _p.s")
        .withColumns(
            {"phase": F.col("_p.phase"), "start_row": F.col("_p.s"), "end_row": F.col("_p.e")}
        )
        .drop("_p")
    )


def final_columns(
    signals: Sequence[str], keep: Sequence[str], freq_s: int, inclusive_extra: int = 0
) -> list:
    """Result columns of a build, labels and event types from the failure phase."""
    phase, failing = F.col("phase"), F.col("phase") == "failure"
    labels = label_values(
        F.col("row_i"),
        F.col("fail_row"),
        freq_s,
        F.col("fail_start"),
        inclusive_extra=inclusive_extra,
        open_end=False,
    )
    label = (
        F.when(failing, labels["label"])
        .when(phase == "post_failure", F.lit("FAILURE"))
        .otherwise(F.lit("NORMAL"))
    )
    left = F.when(failing, labels["time_to_failure_s"]).otherwise(F.lit(NO_FAILURE_TTF))
    event = (
        F.when(failing, F.col("failure_kind"))
        .when(phase.isin("post_failure", "startup"), phase)
        .otherwise(F.col("event_type"))
    )
    return [
        F.col(KEY),
        F.col("row_i"),
        *[F.col(c) for c in keep],
        *[F.col(c) for c in signals],
        F.col("time_s").cast("bigint").alias("time_s"),
        F.col("time_h"),
        label.alias("label"),
        left.alias("time_to_failure_s"),
        event.alias("event_type"),
    ]
