"""Inputs shared by the registered queries, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.chunks import with_row_index


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(column: str):
    """Microseconds since 1970 of a timestamp without zone, whatever the session's zone."""
    gap = f"(cast(`{column}` as timestamp_ntz) - timestamp_ntz'1970-01-01 00:00:00')"
    return F.expr(
        f"extract(day from {gap}) * 86400000000L + extract(hour from {gap}) * 3600000000L"
        f" + extract(minute from {gap}) * 60000000L + cast(extract(second from {gap}) * 1000000 as bigint)"
    )


def tele(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as an indexed series per user, indexed anew at each call."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("device_id"),
        "event_id",
        micros("ts").alias("ts_us"),
        F.col("value").alias("x"),
        "event_type",
    )
    label = (
        F.when(F.col("event_type") == "error", "FAILURE")
        .when(F.col("event_type") == "signup", "PRE_FAILURE")
        .otherwise("NORMAL")
    )
    return (
        with_row_index(events, ["device_id"], ["ts_us", "event_id"])
        .withColumn("label", label)
        .withColumn("time_h", F.col("ts_us") / F.lit(3.6e9))
    )


TELE = """tele as (
  select user_id as device_id, event_id,
    row_number() over (partition by user_id order by ts, event_id) - 1 as row_i,
    epoch_us(ts) as ts_us, value as x, event_type,
    case event_type when 'error' then 'FAILURE' when 'signup' then 'PRE_FAILURE'
      else 'NORMAL' end as label,
    epoch_us(ts) / 3.6e9 as time_h
  from events)"""


def with_ctes(*parts: str, recursive: bool = False) -> str:
    """Join common table expressions and the select that ends them."""
    *ctes, last = parts
    gap = " " if last.lstrip().startswith("select") else ", "
    return f"with {'recursive ' if recursive else ''}{', '.join(ctes)}{gap}{last}"


class Registry:
    """Queries and SQL twins of one module."""

    def __init__(self):
        self.queries, self.oracle = {}, {}

    def __call__(self, name: str, sql: str | None = None):
        def add(fn):
            self.queries[name] = fn
            if sql is not None:
                self.oracle[name] = sql
            return fn

        return add


def r6(col: str, digits: int = 6):
    """Rounded value without a negative zero.

    ``round`` goes through the decimal text of a double. It is asked only where that matters: near a
    half, or for values too large to scale. Elsewhere the nearest whole number of units is the same.
    """
    x, scale = F.col(col), F.lit(10.0**digits)
    y = x.cast("double") * scale
    clear = (F.abs(y) < 2.0**40) & (F.abs(y - F.floor(y) - 0.5) > 1e-3)
    return F.when(clear, F.floor(y + 0.5) / scale).otherwise(F.round(x, digits)) + F.lit(0.0)


def sql_u(key: str, stream: str, at: int = 1) -> str:
    """SQL of the md5 uniform; ``key`` is SQL text giving 'seed|key...'."""
    h = f"md5({key} || '|{stream}')"
    return f"(('0x' || substr({h}, {at}, 13))::bigint / 4503599627370496.0::double)"


def sql_n(key: str, stream: str) -> str:
    """SQL of the md5 standard normal."""
    return (
        f"(sqrt(-2.0 * ln(1.0 - {sql_u(key, stream)}))"
        f" * cos(6.283185307179586 * {sql_u(key, stream, 14)}))"
    )
