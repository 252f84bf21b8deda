"""Scenario lookups and the CSV files of short scenarios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.derive import fixed_text
from ..operators.joins import attach
from ..schemas import SCENARIOS


def scenario_dim(
    df: DataFrame, scenario_id: Column, name: Column, group: Column, kind: Column, description: Column
) -> DataFrame:
    """Lookup of scenarios in its fixed column order; ``faulty`` follows the kind."""
    return df.select(
        scenario_id.cast("int").alias("scenario_id"),
        name.alias("scenario"),
        group.alias("group"),
        kind.alias("kind"),
        (kind == "failure").alias("faulty"),
        description.alias("description"),
    )


def series_dim(
    df: DataFrame, scenario_id: Column, name: Column, failure: Column, days: Column, decoys: Column,
    decoy_text: bool = True,
) -> DataFrame:
    """Lookup of long series with a description built from their settings."""
    faulty = failure.isNotNull()
    what = F.when(~faulty, F.lit("Healthy")).otherwise(
        F.concat(F.initcap(failure), F.lit(" failure"))
    )
    text = F.concat(what, F.lit(" — "), fixed_text(days, 0), F.lit(" days"))
    if decoy_text:
        text = F.concat(text, F.lit(", ~"), fixed_text(decoys, 1), F.lit(" decoys/day"))
    return df.select(
        scenario_id.cast("int").alias("scenario_id"),
        name.alias("scenario"),
        F.coalesce(failure, F.lit("all")).alias("group"),
        F.when(faulty, F.lit("failure")).otherwise(F.lit("normal")).alias("kind"),
        faulty.alias("faulty"),
        days.cast("double").alias("duration_days"),
        decoys.cast("double").alias("decoy_freq_per_day"),
        text.alias("description"),
    )


def read_scenario_dim(spark: SparkSession, path: str, schema: T.StructType = SCENARIOS) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_scenarios(
    spark: SparkSession, lookup_path: str, data_path: str, schema: T.StructType,
    lookup_schema: T.StructType = SCENARIOS, by_folder: str | None = None,
) -> DataFrame:
    """All listed scenarios in one table; scenarios without a file are skipped.

    Files are either ``<scenario>.csv`` side by side, or, with ``by_folder``,
    folders ``<by_folder>=<scenario>``.
    """
    lookup = read_scenario_dim(spark, lookup_path, lookup_schema).select(
        F.col("scenario_id").alias("_id"), F.col("scenario")
    )
    if by_folder:
        full = T.StructType([*schema.fields, T.StructField(by_folder, T.StringType())])
        data = spark.read.schema(full).option("header", True).csv(data_path)
        data = data.withColumnRenamed(by_folder, "scenario")
    else:
        data = (
            spark.read.schema(schema)
            .option("header", True)
            .option("pathGlobFilter", "*.csv")
            .csv(data_path)
            .select("*", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.csv$", 1).alias("scenario"))
        )
    found = attach(data, lookup, ["scenario"])
    if "scenario_id" in data.columns:
        return found.drop("_id")
    return found.withColumnRenamed("_id", "scenario_id")


def write_scenario_dim(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
