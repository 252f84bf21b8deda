"""Manifest, result and settings files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CONFIG, RESULTS


def manifest_rows(configs: DataFrame) -> DataFrame:
    """Flat rows for a CSV manifest: list joined with pipes, counters at zero."""
    return configs.withColumns(
        {
            "decoy_types": F.concat_ws("|", "decoy_types"),
            "status": F.lit("pending"),
            "num_rows": F.lit(0).cast("bigint"),
            "file_size_bytes": F.lit(0).cast("bigint"),
            "generation_time_s": F.lit(0.0),
        }
    )


def manifest_configs(rows: DataFrame) -> DataFrame:
    """Device settings from manifest rows: the list is split again, counters go."""
    return rows.withColumn("decoy_types", F.split("decoy_types", r"\|")).drop(
        "status", "num_rows", "file_size_bytes", "generation_time_s"
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_results(df: DataFrame, path: str) -> None:
    """Per-device results in their fixed column order."""
    write_csv(df.select(*RESULTS.names), path)


def write_config(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_config(spark: SparkSession, path: str, schema: T.StructType = CONFIG) -> DataFrame:
    """Settings as one row; fields the schema does not name are ignored."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def apply_overrides(defaults: DataFrame, overrides: DataFrame, keys: list[str]) -> DataFrame:
    """Defaults with every known, given override put in; unknown fields are ignored."""
    known = [c for c in defaults.columns if c in overrides.columns and c not in keys]
    given = overrides.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in known])
    return (
        defaults.join(given, keys, "left")
        .withColumns({c: F.coalesce(f"_o_{c}", c) for c in known})
        .select(*defaults.columns)
    )


def same_params(saved: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Per key: do the saved settings equal the current ones? Missing means no."""
    cols = [c for c in current.columns if c != key]
    old = saved.select(key, F.lit(True).alias("_saved"), *[F.col(c).alias(f"_s_{c}") for c in cols])
    same = F.coalesce("_saved", F.lit(False))
    for c in cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    return current.join(old, key, "left").select(key, same.alias("is_current"))


def is_current(spark: SparkSession, data_path: str, params_path: str, current: DataFrame) -> bool:
    """A stored data set may be reused: its data exist and its settings are these."""
    try:
        spark.read.parquet(data_path).schema  # noqa: B018  a missing folder is an analysis error
        spark.read.text(params_path).schema  # noqa: B018
    except AnalysisException:
        return False
    saved = spark.read.schema(current.schema).json(params_path)
    return saved.exceptAll(current).isEmpty() and current.exceptAll(saved).isEmpty()
