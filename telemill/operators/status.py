"""Manifest bookkeeping: merge, resume, completeness, run summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spine import row_count, with_one_row

RESULT_COLUMNS = ["status", "num_rows", "file_size_bytes", "generation_time_s"]


def merge_results(
    manifest: DataFrame,
    results: DataFrame,
    key: str = "device_id",
    columns: Sequence[str] = RESULT_COLUMNS,
) -> DataFrame:
    """Manifest with the values of a run put in where the run has the device."""
    r = results.select(key, *[F.col(c).alias(f"_r_{c}") for c in columns])
    return (
        manifest.join(r, key, "left")
        .withColumns({c: F.coalesce(f"_r_{c}", c) for c in columns})
        .drop(*[f"_r_{c}" for c in columns])
    )


def pending(manifest: DataFrame, done: DataFrame, key: str = "device_id") -> DataFrame:
    """Devices that no finished record covers."""
    return manifest.join(done.where(F.col("status") == "completed").select(key), key, "left_anti")


def validate(manifest: DataFrame, stats: DataFrame, key: str = "device_id") -> DataFrame:
    """Expected devices, those present with data, and those missing or empty."""
    present = stats.select(key, (F.col("file_size_bytes") > 0).alias("_full"))
    return manifest.select(key).join(present, key, "left").agg(
        F.count(F.lit(1)).alias("expected"),
        F.count_if(F.coalesce("_full", F.lit(False))).alias("valid"),
        F.count_if(~F.coalesce("_full", F.lit(False))).alias("missing"),
    )


def run_summary(results: DataFrame, elapsed_s: float | None = None) -> DataFrame:
    """One row: devices done and failed, their rows, bytes, mean time, devices per second."""
    done = F.col("status") == "completed"
    n = F.count_if(done)
    seconds = F.lit(elapsed_s) if elapsed_s is not None else F.sum("generation_time_s")
    return results.agg(
        n.alias("completed"),
        F.count_if(~done).alias("failed"),
        F.coalesce(F.sum(F.when(done, F.col("num_rows"))), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(done, F.col("file_size_bytes"))), F.lit(0)).alias("total_bytes"),
        F.coalesce(F.avg(F.when(done, F.col("generation_time_s"))), F.lit(0.0)).alias("avg_time_s"),
        F.try_divide(n.cast("double"), seconds.cast("double")).alias("devices_per_s"),
    )


def failed(results: DataFrame, n: int = 20, key: str = "device_id") -> DataFrame:
    """The first ``n`` devices that did not finish, and how many more there are."""
    bad = results.where(F.col("status") != "completed").select(key, "status")
    total = bad.agg(F.count(F.lit(1)).alias("_total"))
    return (
        with_one_row(bad.orderBy(key).limit(n), total)
        .withColumn("more", F.greatest(F.col("_total") - n, F.lit(0)))
        .drop("_total")
    )


def failure_mix(manifest: DataFrame, col: str = "failure_type") -> DataFrame:
    """Devices per failure type."""
    return manifest.groupBy(F.coalesce(col, F.lit("healthy")).alias(col)).agg(
        F.count(F.lit(1)).alias("devices")
    )


def param_ranges(manifest: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lowest, highest and mean value of each parameter, one row per parameter."""
    long = manifest.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "parameter", "value"
    )
    return long.groupBy("parameter").agg(
        F.min("value").alias("lowest"),
        F.max("value").alias("highest"),
        F.avg("value").alias("mean"),
    )


def sizing(
    manifest: DataFrame, freq_s: int, bytes_per_row: float, days: str = "duration_days"
) -> DataFrame:
    """One row: devices, rows and bytes a fleet will take."""
    rows = row_count(F.col(days), freq_s)
    return manifest.agg(
        F.count(F.lit(1)).alias("devices"),
        F.max(rows).alias("rows_per_device"),
        (F.max(rows) * bytes_per_row).alias("bytes_per_device"),
        F.sum(rows).alias("total_rows"),
        (F.sum(rows) * bytes_per_row).alias("total_bytes"),
    )


def missing_values(signals: Sequence[str]) -> Column:
    """Whether a row lacks a value of any signal."""
    bad = F.lit(False)
    for s in signals:
        bad = bad | F.col(s).isNull() | F.isnan(s)
    return bad


def status_of(
    manifest: DataFrame, seen: DataFrame, freq_s: int, key: str = "device_id", days: str = "duration_days"
) -> DataFrame:
    """Status of each device from counted rows: ``seen`` has the key, ``_rows`` and ``_bad``."""
    expected = row_count(F.col(days), freq_s)
    return (
        manifest.select(key, expected.alias("_expected"))
        .join(seen, key, "left")
        .select(
            key,
            F.coalesce("_rows", F.lit(0)).alias("num_rows"),
            F.when(F.col("_rows").isNull(), F.lit("error: no rows"))
            .when(
                F.col("_rows") != F.col("_expected"),
                F.format_string("error: %d rows, expected %d", "_rows", "_expected"),
            )
            .when(F.col("_bad") > 0, F.format_string("error: %d rows with missing values", "_bad"))
            .otherwise(F.lit("completed"))
            .alias("status"),
        )
    )


def device_status(
    manifest: DataFrame,
    series: DataFrame,
    signals: Sequence[str],
    freq_s: int,
    key: str = "device_id",
    days: str = "duration_days",
) -> DataFrame:
    """Check each device's rows as data: a bad device gets a message, the run goes on."""
    seen = series.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(missing_values(signals)).alias("_bad")
    )
    return status_of(manifest, seen, freq_s, key, days)
