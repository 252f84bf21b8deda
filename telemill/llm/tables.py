"""Small helpers that the operators share."""

from __future__ import annotations

import functools
import math
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def pieces(docs: DataFrame, piece_bytes: int) -> int:
    """Number of pieces of about ``piece_bytes`` that the texts make, one per shuffle task at least."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(total / piece_bytes))


def in_pieces(docs: DataFrame, n: int, *columns: str) -> DataFrame:
    """``columns`` of the texts with ``piece``, dealt out so that a piece is in one task.

    The piece follows from ``doc_id``; rows without one are dealt by their text.
    """
    piece = F.pmod(F.coalesce(F.xxhash64(F.lit(7), "doc_id"), F.xxhash64("text")), F.lit(n))
    key = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text"), F.lit(n))).otherwise(piece)
    tasks = max(1, min(n, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return docs.select(*columns, key.alias("piece")).repartition(tasks, "piece")


def crc32_mod(column: str, n: int):
    """crc32 of a column as text, modulo ``n``."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package where they wouldn't find it by their own path."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    found = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    app = spark.sparkContext.applicationId
    if os.path.realpath(root) in found | {os.path.realpath(os.getcwd())} or app in _SHIPPED:
        return
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "telemill"), "zip", root, "telemill")
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def ships_package(fn):
    """An operator, called with a DataFrame first, whose tasks need this package."""

    @functools.wraps(fn)
    def run(df: DataFrame, *args, **settings):
        ship_package(df.sparkSession)
        return fn(df, *args, **settings)

    return run


#: Keys with more than this share of all rows are joined by broadcast; there are at most as many.
HOT_KEYS = 4_096


def join_spread(rows: DataFrame, keyed: DataFrame, key: str, many: str) -> DataFrame:
    """Inner join of ``rows`` with ``keyed``, a stored row for each ``key`` with its number of rows, ``many``.

    Keys that hold more than 1 / ``HOT_KEYS`` of all rows, at most that many, are joined by
    broadcast, so that none of them is one key of a shuffle; the others are joined as usual.
    Null keys match each other.
    """
    total = keyed.agg(F.sum(many)).first()[0] or 0
    hot = F.col(many) * HOT_KEYS > total
    own = keyed.withColumnRenamed(key, "_key")
    same = F.col(key).eqNullSafe(F.col("_key"))
    frequent, others = own.filter(hot), own.filter(~hot)
    cold = rows.join(F.broadcast(frequent.select("_key")), same, "left_anti").join(others, same)
    return rows.join(F.broadcast(frequent), same).unionByName(cold).drop("_key", many)
