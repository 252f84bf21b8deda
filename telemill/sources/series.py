"""Reading and writing series tables. Paths may be local or any Hadoop URI."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_series(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet series; naming columns reads only those."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


#: Rows of one key that go to one file.
FILE_ROWS = 5_000_000


def write_by_key(df: DataFrame, path: str, key: str, fmt: str = "csv", file_rows: int = FILE_ROWS) -> None:
    """One folder per key value; a large key is spread over several files in it.

    Rows are placed by key and, within a key, by a hash of the whole row into as many
    parts as its row count asks for, so a key makes few files and no task holds a hot key.
    """
    counts = df.groupBy(F.col(key).alias("_k")).agg(F.ceil(F.count(F.lit(1)) / F.lit(file_rows)).alias("_parts"))
    part = F.pmod(F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")]), F.col("_parts"))
    placed = df.join(counts, df[key].eqNullSafe(counts["_k"])).withColumn("_part", part)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    writer = placed.repartition(tasks, key, "_part").select(df.columns).write.mode("overwrite").partitionBy(key)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_series(df: DataFrame, path: str, key: str) -> None:
    """Parquet, one folder per series."""
    write_by_key(df, path, key, "parquet")


def write_fleet(
    df: DataFrame,
    path: str,
    key: str = "device_id",
    row: str = "row_i",
    files: int | None = None,
    max_records_per_file: int = 0,
) -> None:
    """One Parquet table clustered by device and row, with the id as a column.

    Range partitioning keeps a device's rows together, so file statistics prune
    by device, and splits a device that is larger than a file.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = files or max(least, -(-df.count() // FILE_ROWS))
    (
        df.repartitionByRange(int(n), key, row)
        .sortWithinPartitions(key, row)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .parquet(path)
    )


def read_fleet(
    spark: SparkSession, path: str, schema: T.StructType | None = None, id_from_file: bool = False
) -> DataFrame:
    """Fleet table; ``id_from_file`` reads the one-file-per-device layout instead."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    if not id_from_file:
        return df
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.parquet$", 1)
    return df.select("*", name.alias("device_id"))


def file_stats(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """Rows and bytes on disk, per file or per value of a key column.

    Bytes of a file that several keys share are divided by its rows.
    """
    df = spark.read.parquet(path)
    meta = [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_size").alias("_size")]
    if key is None:
        return (
            df.select(*meta)
            .groupBy(F.col("_file").alias("file_name"))
            .agg(F.count(F.lit(1)).alias("num_rows"), F.max("_size").alias("file_size_bytes"))
        )
    per_file = (
        df.select(key, *meta)
        .groupBy(key, "_file")
        .agg(F.count(F.lit(1)).alias("_n"), F.max("_size").alias("_size"))
    )
    whole = per_file.groupBy("_file").agg(F.sum("_n").alias("_all"))
    return (
        per_file.join(whole, "_file")
        .groupBy(key)
        .agg(
            F.sum("_n").alias("num_rows"),
            F.ceil(F.sum(F.col("_size") * F.col("_n") / F.col("_all"))).cast("bigint").alias(
                "file_size_bytes"
            ),
        )
    )
