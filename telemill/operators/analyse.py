"""Summaries and extracts over labelled series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import LABELS
from ..functions.derive import fixed_text
from ..session import materialize
from .chunks import CHUNK, CHUNK_ROWS, neighbours, trailing_sum
from .joins import attach
from .spine import with_one_row

KEY, ROW = "device_id", "row_i"


def _label_counts(label: str) -> list[Column]:
    return [F.count_if(F.col(label) == name).alias(name) for name in LABELS]


def label_summary(df: DataFrame, key: str = KEY, label: str = "label") -> DataFrame:
    """Rows and rows per label of each series, 0 for an absent label."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), *_label_counts(label))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, largest first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(col))


def series_summary(
    df: DataFrame, freq_s: int, key: str = KEY, label: str = "label", event: str = "event_type"
) -> DataFrame:
    """Label summary plus length in days and rows under a decoy."""
    n = F.count(F.lit(1))
    return df.groupBy(key).agg(
        n.alias("rows"),
        fixed_text(n * freq_s / 86400.0, 0).alias("days"),
        *_label_counts(label),
        F.count_if(F.col(event).startswith("decoy_")).alias("decoy_rows"),
    )


def event_spans(
    df: DataFrame,
    col: str = "event_type",
    time: str = "time_h",
    key: str = KEY,
    row: str = ROW,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Runs of equal values: ``start``, ``end`` (time of the row after), value, rows.

    The last run of a series ends at its last time. Rows are first summed up to
    the runs inside each chunk, which moves them once; only those fragments are
    then joined across chunk borders.
    """
    near = neighbours(
        df.select(key, row, time, col),
        [key],
        {"_prev": (col, -1), "_next_time": (time, 1)},
        row,
        chunk_rows,
        keep_chunk=True,
    )
    opens = (F.col(row) == 0) | ~F.col(col).eqNullSafe(F.col("_prev"))
    so_far = (
        Window.partitionBy(key, CHUNK).orderBy(row).rowsBetween(Window.unboundedPreceding, 0)
    )
    fragments = materialize(
        near.withColumn("_open", F.when(opens, F.col(row)))
        .withColumn("_start", F.last("_open", ignorenulls=True).over(so_far))
        .groupBy(key, CHUNK, "_start")
        .agg(
            F.min(time).alias("start"),
            F.max(F.coalesce("_next_time", time)).alias("end"),
            F.any_value(col).alias(col),
            F.count(F.lit(1)).alias("rows"),
        ),
        "span-fragments",
    )
    # A fragment without a start of its own goes on from an earlier chunk.
    earlier = Window.partitionBy(key).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    open_run = F.last("_last", ignorenulls=True).over(earlier)
    carried = (
        fragments.groupBy(key, CHUNK)
        .agg(F.max("_start").alias("_last"))
        .select(key, CHUNK, open_run.alias("_carried"))
    )
    return (
        fragments.join(carried, [key, CHUNK])
        .groupBy(key, F.coalesce("_start", "_carried").alias("start_row"))
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.any_value(col).alias(col),
            F.sum("rows").alias("rows"),
        )
    )


def label_spans(
    df: DataFrame, label: str = "label", normal: str = "NORMAL", **options
) -> DataFrame:
    """Runs of labels other than the normal one."""
    return event_spans(df, label, **options).where(F.col(label) != normal)


def row_spans(
    df: DataFrame,
    label: str = "label",
    time: str = "time_h",
    key: str = KEY,
    row: str = ROW,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """One span per pair of neighbour rows, with the label of the first."""
    near = neighbours(
        df.select(key, row, time, label), [key], {"end": (time, 1)}, row, chunk_rows
    )
    return near.where(F.col("end").isNotNull()).select(
        key, row, F.col(time).alias("start"), "end", label
    )


def downsample(df: DataFrame, n: int, row: str = ROW) -> DataFrame:
    """Every n-th row of each series."""
    return df.where(F.col(row) % int(n) == 0)


def zoom(
    df: DataFrame,
    half_rows: int,
    label: str = "label",
    failed: str = "FAILURE",
    key: str = KEY,
    row: str = ROW,
) -> DataFrame:
    """Rows around each series' first failure; series without one are left out."""
    first = (
        df.where(F.col(label) == failed).groupBy(key).agg(F.min(row).alias("_fail"))
    )
    return (
        attach(df, first, [key])
        .where(
            (F.col(row) >= F.col("_fail") - int(half_rows))
            & (F.col(row) < F.col("_fail") + int(half_rows))
        )
        .drop("_fail")
    )


def busiest_window(
    df: DataFrame,
    window_rows: int,
    event: str = "event_type",
    normal: str = "normal",
    label: str | None = "label",
    failed: str = "FAILURE",
    key: str = KEY,
    row: str = ROW,
    centre_on_block: bool = False,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The window worth looking at: around the first failure, else the densest events.

    Density is the number of non-normal rows in the trailing block; the window is
    centred on the first row with the highest count (its middle with
    ``centre_on_block``), or on the middle row if nothing happened, and shifted
    to fit into the series.
    """
    w = int(window_rows)
    busy = (F.col(event) != normal).cast("int")
    fail = F.when(F.col(label) == failed, F.col(row)) if label else F.lit(None).cast("bigint")
    counted = trailing_sum(
        df.select(key, row, event, fail.alias("_fail")), [key], "_busy", busy, w, row, chunk_rows
    )
    # Summed up per count first: the largest struct of all rows would take a sort of them.
    by_count = counted.groupBy(key, "_busy").agg(
        F.min("_fail").alias("_fail"), F.min(row).alias("_first"), F.max(row).alias("_last")
    )
    best = by_count.groupBy(key).agg(
        F.min("_fail").alias("_fail"),
        F.max(F.struct(F.col("_busy"), -F.col("_first"))).alias("_best"),
        (F.max("_last") + 1).alias("_n"),
    )
    densest = -F.col("_best.col2")
    if centre_on_block:
        densest = F.greatest(densest - w // 2, F.lit(0))
    centre = F.coalesce(
        F.col("_fail"), F.when(F.col("_best._busy") > 0, densest), F.expr("_n div 2")
    )
    end = F.least(F.col("_n"), F.greatest(F.col("centre") - w // 2, F.lit(0)) + w)
    return best.withColumn("centre", centre).select(
        key,
        "centre",
        F.greatest(end - w, F.lit(0)).alias("start_row"),
        end.alias("end_row"),
    )


def compare(
    df: DataFrame,
    scenarios: DataFrame,
    names: Sequence[str],
    x: str,
    y: str,
    time: str = "time_h",
    id_col: str = "scenario_id",
    name_col: str = "scenario",
) -> DataFrame:
    """Chosen scenarios side by side in long form: series, t, x, y."""
    chosen = scenarios.where(F.col(name_col).isin(list(names))).select(id_col, name_col)
    return attach(df, chosen, [id_col]).select(
        F.col(name_col).alias("series"), F.col(time).alias("t"), F.col(x).alias("x"), F.col(y).alias("y")
    )


def residual(df: DataFrame, x: str, y: str, healthy: Column) -> DataFrame:
    """How far y lies above or below what x explains on healthy rows."""
    line = df.where(healthy).agg(
        F.regr_slope(F.col(y), F.col(x)).alias("_slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("_icept"),
    )
    return (
        with_one_row(df, line)
        .withColumn("residual", F.col(y) - (F.col("_icept") + F.col("_slope") * F.col(x)))
        .drop("_slope", "_icept")
    )


def residual_summary(df: DataFrame, x: str, y: str, healthy: Column, group: str) -> DataFrame:
    """Mean and spread of the residual per group."""
    return (
        residual(df, x, y, healthy)
        .groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.avg("residual").alias("mean_residual"),
            F.stddev("residual").alias("sd_residual"),
        )
    )


def distinct_events(df: DataFrame, col: str = "event_type") -> DataFrame:
    return df.select(col).distinct()


def label_variety(df: DataFrame, label: str = "label", key: str = KEY) -> DataFrame:
    """Labels per series and whether there is more than one."""
    return (
        df.groupBy(key)
        .agg(F.count_distinct(label).alias("n_labels"))
        .withColumn("mixed", F.col("n_labels") > 1)
    )


def split_by_label(
    df: DataFrame,
    cols: Sequence[str],
    label: str = "label",
    time: str = "time_h",
    key: str = KEY,
) -> DataFrame:
    """Long form for drawing: (key, label, time, signal, value)."""
    return df.select(key, label, time, *cols).unpivot(
        [key, label, time], list(cols), "signal", "value"
    )
