"""Fleet and sample data sets: manifest, build, write, bookkeeping."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import status as ST
from ..operators.manifest import sample_manifest
from ..operators.spine import with_one_row
from ..session import keep as keep_table
from ..session import materialize, scratch
from ..sources.commits import claim, create_once, numbers, text_of
from ..sources.records import apply_overrides, is_current, manifest_rows, write_config, write_csv, write_results
from ..sources.scenarios import series_dim
from ..sources.series import write_series
from .motor import MotorInputs, build_motor
from .pump import PumpInputs, build_pump

BUILDS = {"pump": build_pump, "motor": build_motor}
SIGNALS = {"pump": K.PUMP_SIGNALS, "motor": K.MOTOR_SIGNALS}


@dataclass
class FleetRun:
    """What a fleet build leaves behind."""

    manifest: DataFrame
    results: DataFrame
    summary: DataFrame
    completeness: DataFrame


def write_devices(series: DataFrame, path: str) -> None:
    """Write a build's rows as they lie, by device and row inside each task.

    No row moves between tasks, and none is sorted again: a build lays rows out in that order to
    sum its walk. It places a device by blocks of days, so it is in one
    file for each block. ``sources.series.write_fleet`` gives the fully clustered layout
    at the price of one shuffle. Drawn values hardly repeat, so the files get the codec that
    also packs single bytes.
    """
    series.write.mode("overwrite").option("compression", "zstd").parquet(path)


def check_devices(spark: SparkSession, path: str, signals: Sequence[str]) -> DataFrame:
    """Rows of each device in each file of a folder, in one pass; stored.

    Columns: device_id, file, num_rows, bad_rows (a signal is missing), file_size_bytes (the
    device's share of the file by rows).
    """
    rows = spark.read.parquet(path)
    seen = materialize(
        rows.select(
            "device_id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("_size"),
            ST.missing_values(signals).alias("_bad"),
        )
        .groupBy("device_id", "file")
        .agg(F.count(F.lit(1)).alias("num_rows"), F.count_if("_bad").alias("bad_rows"), F.max("_size").alias("_size")),
        "device-files",
    )
    whole = seen.groupBy("file").agg(F.sum("num_rows").alias("_all"))
    share = F.col("_size") * F.col("num_rows") / F.col("_all")
    return materialize(
        seen.join(whole, "file").select("device_id", "file", "num_rows", "bad_rows", share.alias("file_size_bytes")),
        "device-files",
    )


def stored_manifest(spark: SparkSession, out: str) -> DataFrame | None:
    """The newest manifest of a fleet's folder, with ``version`` and ``data_version``; none before the first run.

    Only manifests that a finished run has committed are read.
    """
    out = out.rstrip("/")
    done = numbers(spark, f"{out}/commits")
    if not done:
        return None
    name = text_of(spark, f"{out}/commits", done[-1])
    return spark.read.parquet(f"{out}/manifest/{name}").withColumn("version", F.lit(done[-1]))


def read_devices(spark: SparkSession, out: str, ids: Sequence[str] | None = None) -> DataFrame:
    """Rows of all devices, each from the run that finished it last.

    Rows of runs that broke off, and of devices that came out wrong, stay unread. With
    ``ids`` only the files that hold these devices are opened, one for each block of days.
    """
    out = out.rstrip("/")
    manifest = stored_manifest(spark, out)
    if manifest is None:
        raise ValueError(f"no finished run in {out}")
    chosen = manifest.where("data_version is not null").select(
        "device_id", F.col("data_version").cast("int").alias("version")
    )
    if ids is not None:
        chosen = chosen.where(F.col("device_id").isin(list(ids)))
    runs = sorted(r["version"] for r in chosen.select("version").distinct().collect())
    if not runs:
        return spark.read.parquet(f"{out}/devices").limit(0).drop("version")
    base = spark.read.option("basePath", f"{out}/devices")
    if ids is None:
        rows = base.parquet(*[f"{out}/devices/version={v}" for v in runs])
    else:
        index = spark.read.option("basePath", f"{out}/files").parquet(*[f"{out}/files/version={v}" for v in runs])
        files = index.join(chosen, ["device_id", "version"], "left_semi").select("file").distinct()
        rows = base.parquet(*sorted(r["file"] for r in files.collect())).where(F.col("device_id").isin(list(ids)))
    return rows.join(chosen, ["device_id", "version"]).drop("version")


def _merged(manifest: DataFrame, before: DataFrame | None, done: DataFrame | None) -> DataFrame:
    """This fleet's manifest with what earlier runs know, and the devices that only they have."""
    fresh = manifest_rows(manifest).withColumn("data_version", F.lit(None).cast("bigint"))
    if before is not None:
        fresh = ST.merge_results(fresh, before, columns=[*ST.RESULT_COLUMNS, "data_version"])
        others = before.join(manifest.select("device_id"), "device_id", "left_anti").drop("version")
        fresh = fresh.unionByName(others, allowMissingColumns=True)
    if done is not None:
        known = [c for c in ST.RESULT_COLUMNS if c in done.columns]
        fresh = ST.merge_results(fresh, done.where("status = 'completed'"), columns=known)
    return fresh


def build_fleet(
    devices: DataFrame,
    index: str,
    machine: str,
    inputs: PumpInputs | MotorInputs,
    out: str,
    duration_days: float = K.FLEET_DAYS,
    freq_s: int = K.SAVE_FREQ_S,
    base_seed: int = K.FLEET_SEED,
    done: DataFrame | None = None,
    fractions: Sequence[tuple[str, float]] | None = None,
    settings: DataFrame | None = None,
    **options,
) -> FleetRun:
    """Build every device that the fleet's folder, or ``done``, doesn't list as completed.

    ``devices`` numbers the fleet in column ``index``; ``fractions`` are the shares of
    the failure types; ``settings`` overrides drawn settings by ``device_id``. A
    device whose rows do not come out right gets an error status; the others are not
    affected, and the next run builds it again. ``generation_time_s`` is a device's share,
    by rows, of the time its run took to build and write all of them.

    Every run claims a version of its own, writes its rows, files and results under it,
    and at last commits a manifest: it merges its results into the newest one and takes the
    next number of ``commits``, and does so again if another run took that number.
    Runs at the same time thus keep each other's results; of a device that both built, the
    rows of the later commit are read. A run that breaks off leaves only unread files.
    Tables stored in between go when the run ends.
    """
    spark, out = devices.sparkSession, out.rstrip("/")
    with scratch(spark):
        drawn = sample_manifest(devices, index, machine, duration_days, base_seed, fractions)
        if settings is not None:
            drawn = apply_overrides(drawn, settings, ["device_id"])
        manifest = materialize(drawn, "fleet-manifest")
        version = claim(spark, f"{out}/claims")
        known = materialize(_merged(manifest, stored_manifest(spark, out), done), "fleet-before")
        todo = ST.pending(manifest, known)
        started = time.time()
        data = f"{out}/devices/version={version}"
        write_devices(BUILDS[machine](todo, inputs, freq_s, **options), data)
        elapsed = time.time() - started

        files = check_devices(spark, data, SIGNALS[machine])
        files.write.mode("overwrite").parquet(f"{out}/files/version={version}")
        seen = files.groupBy("device_id").agg(
            F.sum("num_rows").alias("_rows"), F.sum("bad_rows").alias("_bad"), F.ceil(F.sum("file_size_bytes")).alias("_bytes")
        )
        all_rows = files.agg(F.sum("num_rows")).first()[0] or 1
        results = materialize(
            ST.status_of(todo, seen, freq_s).join(seen.select("device_id", "_bytes"), "device_id", "left").select(
                "device_id",
                "num_rows",
                F.coalesce("_bytes", F.lit(0)).alias("file_size_bytes"),
                (F.lit(elapsed) * F.col("num_rows") / F.lit(float(all_rows))).alias("generation_time_s"),
                "status",
                F.when(F.col("status") == "completed", F.lit(version).cast("bigint")).alias("data_version"),
            ),
            "fleet-results",
        )
        write_results(results, f"{out}/results/version={version}")
        used = spark.range(1).select(
            F.lit(machine).alias("machine"), F.lit(float(duration_days)).alias("duration_days"),
            F.lit(int(freq_s)).alias("save_freq_s"), F.lit(int(base_seed)).alias("base_seed"),
            *[F.lit(float(share)).alias(f"{name}_fraction") for name, share in fractions or []],
        )
        write_config(used, f"{out}/settings/version={version}")
        kept = _commit(spark, out, version, manifest, done, results)
        present = kept.where("data_version is not null").select("device_id", "file_size_bytes")
        return FleetRun(
            kept.drop("version", "data_version"),
            keep_table(materialize(results.drop("data_version"), "fleet-results")),
            keep_table(materialize(ST.run_summary(results, elapsed), "fleet-summary")),
            keep_table(materialize(ST.validate(manifest, present), "fleet-completeness")),
        )


def _commit(spark, out, version, manifest, done, results) -> DataFrame:
    """Merge a run's results into the newest manifest and publish that, until no other run came between."""
    turn = 0
    while True:
        at = max(numbers(spark, f"{out}/commits"), default=0)
        name, turn = f"run={version}-{turn}", turn + 1
        merged = ST.merge_results(
            _merged(manifest, stored_manifest(spark, out), done), results, columns=[*ST.RESULT_COLUMNS, "data_version"]
        )
        merged.write.mode("overwrite").parquet(f"{out}/manifest/{name}")
        if create_once(spark, f"{out}/commits/{at + 1:08d}", name):
            return stored_manifest(spark, out)


# --- fixed values: the series of a sample data set --------------------------
SAMPLE_SERIES = {
    "pump": [
        ("normal_long", None),
        ("bearing_failure_long", "bearing"),
        ("impeller_failure_long", "impeller"),
        ("radial_failure_long", "radial"),
    ],
    "motor": [
        ("normal_long", None),
        ("winding_failure_long", "winding"),
        ("bearing_failure_long", "bearing"),
        ("demag_failure_long", "demag"),
    ],
}
DECOYS = {"pump": K.PUMP_DECOYS, "motor": K.MOTOR_DECOYS}


def sample_manifest_rows(
    units: DataFrame,
    unit: str,
    machine: str,
    duration_days: float = K.FLEET_DAYS,
    decoys_per_day: float = 2.0,
    severity: float = 1.0,
    ambient_var_K: float = 0.0,
    duty_cycle_var: float = 0.0,
    seed: int = 42,
    decoy_types: Sequence[str] | None = None,
) -> DataFrame:
    """Four series per unit: a healthy one and one per failure, seeds counting up.

    ``decoy_types`` limits the decoys; by default all of the machine's may occur.
    """
    kinds = DECOYS[machine] if decoy_types is None else decoy_types
    series = F.array(
        *[
            F.struct(
                F.lit(i).alias("scenario_id"),
                F.lit(name).alias("scenario"),
                F.lit(failure).cast("string").alias("failure_type"),
            )
            for i, (name, failure) in enumerate(SAMPLE_SERIES[machine])
        ]
    )
    rows = units.select(unit, F.explode(series).alias("_s")).select(unit, "_s.*")
    return rows.withColumns(
        {
            "device_id": F.concat_ws("_", F.col(unit).cast("string"), "scenario"),
            "seed": F.lit(seed).cast("bigint") + F.col("scenario_id"),
            "duration_days": F.lit(float(duration_days)),
            "failure_start_day": F.lit(None).cast("double"),
            "failure_severity": F.lit(float(severity)),
            "ambient_var_K": F.lit(float(ambient_var_K)),
            "duty_cycle_var": F.lit(float(duty_cycle_var)),
            "decoy_freq_per_day": F.lit(float(decoys_per_day)),
            "decoy_types": F.array(*[F.lit(d) for d in kinds]).cast("array<string>"),
            "noise_scale": F.lit(1.0),
            "v_offset": F.lit(0.0),
            "p_offset": F.lit(0.0),
        }
    )


def sample_dataset(
    units: DataFrame,
    unit: str,
    machine: str,
    inputs: PumpInputs | MotorInputs,
    freq_s: int = K.SAVE_FREQ_S,
    maintenance_per_month: float = 1.0,
    method: str = "xxhash64",
    **settings,
) -> tuple[DataFrame, DataFrame]:
    """Long series of a sample data set and their lookup table."""
    manifest = sample_manifest_rows(units, unit, machine, **settings)
    series = BUILDS[machine](
        manifest,
        inputs,
        freq_s,
        maintenance_per_month=maintenance_per_month,
        method=method,
        keep=(unit, "scenario_id"),
    )
    lookup = series_dim(
        manifest,
        F.col("scenario_id"),
        F.col("scenario"),
        F.col("failure_type"),
        F.col("duration_days"),
        F.col("decoy_freq_per_day"),
        decoy_text=machine == "pump",
    )
    return series, lookup


def write_sample_dataset(
    out: str, units: DataFrame, unit: str, machine: str, inputs: PumpInputs | MotorInputs, **settings
) -> bool:
    """Write a sample data set, unless the folder holds one with these settings; was it written?

    The settings are stored last, so a run that broke off is not taken for finished.
    """
    out, spark = out.rstrip("/"), units.sparkSession
    params = spark.range(1).select(
        F.lit(machine).alias("machine"),
        *[F.lit(None if v is None else str(v)).cast("string").alias(k) for k, v in sorted(settings.items())],
    )
    params = with_one_row(params, units.agg(F.count(F.lit(1)).alias("units")))
    if is_current(spark, f"{out}/series", f"{out}/params", params):
        return False
    series, lookup = sample_dataset(units, unit, machine, inputs, **settings)
    write_series(series, f"{out}/series", "scenario_id")
    write_csv(lookup, f"{out}/lookup")
    write_config(params, f"{out}/params")
    return True
