"""Ordered work over keyed series, split so that no key has to fit one task.

A series is keyed by (key, row_i) with ``row_i`` dense from 0, so
``row_i div chunk_rows`` cuts any key, however long, into pieces of at most
``chunk_rows`` rows. Running values are taken inside a piece and carried over
from the earlier pieces; neighbour rows come from a halo of copied rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

CHUNK_ROWS = 65536
#: Rows that one task of ``with_row_index`` sorts.
INDEX_ROWS = 4_000_000
CHUNK = "_chunk"


def with_chunk(df: DataFrame, order: str = "row_i", rows: int = CHUNK_ROWS) -> DataFrame:
    return df.withColumn(CHUNK, F.expr(f"`{order}` div {int(rows)}"))


def with_halo(
    df: DataFrame, order: str = "row_i", rows: int = CHUNK_ROWS, before: int = 0, after: int = 0
) -> DataFrame:
    """Add ``_chunk`` and copy edge rows into the neighbour chunk.

    Every chunk then also holds the ``before`` rows ahead of it and the
    ``after`` rows behind it; ``_own`` marks the rows that belong to it.
    """
    if max(before, after) > rows:
        raise ValueError("halo must not be longer than a chunk")
    at = F.col(order)
    home = F.expr(f"`{order}` div {int(rows)}")
    copies = [home]
    if before:
        copies.append(F.when(at % rows >= rows - before, home + 1))
    if after:
        copies.append(F.when((at % rows < after) & (home > 0), home - 1))
    return df.withColumn(CHUNK, F.explode(F.array_compact(F.array(*copies)))).withColumn(
        "_own", F.col(CHUNK) == home
    )


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    columns: dict[str, tuple[str, int]],
    order: str = "row_i",
    rows: int = CHUNK_ROWS,
    keep_chunk: bool = False,
) -> DataFrame:
    """Add values of other rows: ``name -> (column, offset)``, offset -1 = row before."""
    back = max([-o for _, o in columns.values() if o < 0], default=0)
    ahead = max([o for _, o in columns.values() if o > 0], default=0)
    w = Window.partitionBy(*keys, CHUNK).orderBy(order)
    added = {
        name: F.lag(c, -o).over(w) if o < 0 else F.lead(c, o).over(w)
        for name, (c, o) in columns.items()
    }
    return (
        with_halo(df, order, rows, back, ahead)
        .withColumns(added)
        .where("_own")
        .drop("_own", *([] if keep_chunk else [CHUNK]))
    )


def trailing_sum(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    value: Column,
    length: int,
    order: str = "row_i",
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Sum of ``value`` over the last ``length`` rows, this one included.

    It is the running total less the running total ``length`` rows before. Inside a chunk
    that row is in the halo. For a window longer than a chunk each row comes twice: as itself,
    and ``length`` rows later to be taken off again. One more row per chunk brings what the earlier
    chunks leave, so no row is joined with another, and tasks get ``INDEX_ROWS`` rows at most.
    Whole numbers are exact; a sum of doubles has the rounding of the total it is taken from.
    """
    if length <= rows:
        here = Window.partitionBy(*keys, CHUNK).orderBy(order)
        total = F.sum("_value").over(here.rowsBetween(Window.unboundedPreceding, 0))
        return (
            with_halo(df.withColumn("_value", F.coalesce(value, F.lit(0))), order, rows, before=length)
            .withColumn("_total", total)
            .withColumn(name, F.col("_total") - F.coalesce(F.lag("_total", length).over(here), F.lit(0)))
            .where("_own")
            .drop("_own", "_value", "_total", CHUNK)
        )
    own, others = F.col("_own"), [c for c in df.columns if c not in (*keys, order)]
    taken = F.lit(0).cast("bigint") - F.col("_value")
    steps = (
        df.withColumn("_value", F.coalesce(value, F.lit(0)))
        .withColumn("_own", F.explode(F.array(F.lit(True), F.lit(False))))
        .withColumns(
            {
                "_value": F.when(own, F.col("_value")).otherwise(taken),
                order: F.when(own, F.col(order)).otherwise(F.col(order) + length),
                **{c: F.when(own, F.col(c)) for c in others},
            }
        )
    )
    chunked = with_chunk(steps, order, rows)
    totals = materialize(
        chunked.groupBy(*keys, CHUNK).agg(F.sum("_value").alias("_value"), F.count(F.lit(1)).alias("_n")), "chunk-totals"
    )
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys, CHUNK, (F.col(CHUNK) * rows - 1).alias(order), F.lit(False).alias("_own"), F.sum("_value").over(earlier).alias("_value")
    )
    n = -(-(totals.agg(F.sum("_n")).first()[0] or 0) // INDEX_ROWS)
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), n)
    here = Window.partitionBy(*keys, CHUNK).orderBy(order, "_own").rowsBetween(Window.unboundedPreceding, 0)
    return (
        chunked.unionByName(carried, allowMissingColumns=True)
        .repartition(n, *keys, CHUNK)
        .withColumn(name, F.sum("_value").over(here))
        .where("_own")
        .select(*df.columns, name)
    )


_FOLDS = {
    "sum": (F.sum, lambda carry, local: F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0))),
    "max": (F.max, lambda carry, local: F.greatest(carry, local)),
}


def running(
    df: DataFrame,
    keys: Sequence[str],
    columns: dict[str, tuple[str, str]],
    order: Sequence[str],
    chunk: str = CHUNK,
    inclusive: bool = True,
) -> DataFrame:
    """Running values along each key: ``name -> (column, how)``.

    ``how`` is ``sum``, ``max`` or ``last`` (last non-null). ``df`` must carry a
    ``chunk`` column that rises with ``order``. Only one row per (key, chunk)
    is brought together per key, to carry values from chunk to chunk.
    """
    pieces = Window.partitionBy(*keys, chunk).orderBy(*order)
    local = pieces.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    earlier = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)

    totals, carries, locals_, results = [], [], {}, {}
    for name, (col, how) in columns.items():
        if how == "last":
            at = F.when(F.col(col).isNotNull(), F.struct(*order))
            totals.append(F.max_by(col, at).alias(f"_t_{name}"))
            carry = F.last(f"_t_{name}", ignorenulls=True).over(earlier)
            locals_[f"_l_{name}"] = F.last(col, ignorenulls=True).over(local)
            result = F.coalesce(F.col(f"_l_{name}"), F.col(f"_c_{name}"))
        else:
            fold, combine = _FOLDS[how]
            totals.append(fold(col).alias(f"_t_{name}"))
            carry = fold(f"_t_{name}").over(earlier)
            locals_[f"_l_{name}"] = fold(col).over(local)
            result = combine(F.col(f"_c_{name}"), F.col(f"_l_{name}"))
        carries.append(carry.alias(f"_c_{name}"))
        results[name] = result
    names = {k: f"_by{i}" for i, k in enumerate([*keys, chunk])}
    by_chunk = df.groupBy(*keys, chunk).agg(*totals).select(*[F.col(k).alias(n) for k, n in names.items()], *carries)
    same = None
    for k, n in names.items():
        one = F.col(k).eqNullSafe(F.col(n))
        same = one if same is None else same & one
    return (
        df.withColumns(locals_)
        .join(by_chunk, same)
        .withColumns(results)
        .drop(*names.values(), *[f"_{p}_{n}" for n in columns for p in "lc"])
    )


def with_row_index(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "row_i"
) -> DataFrame:
    """Number the rows of each key from 0 in ``order`` (which must be unique per key).

    Range partitioning on (key, order) spreads one hot key over many tasks;
    positions inside the sorted partitions plus a small table of counts per
    (key, partition) give the index without a per-key window over the rows. The
    placed rows are stored first so the positions cannot change on a retry.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(least, -(-df.count() // INDEX_ROWS))
    placed = materialize(
        df.repartitionByRange(n, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id()),
        "row-index",
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        placed.groupBy(*keys, "_part")
        .agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .select(
            *keys,
            "_part",
            (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        )
    )
    return (
        placed.join(materialize(offsets, "row-offsets"), [*keys, "_part"])
        .withColumn(name, F.col("_pos") + F.col("_shift"))
        .drop("_part", "_pos", "_shift")
    )


def global_rank(df: DataFrame, order: Column, name: str, tie: Sequence[str]) -> DataFrame:
    """Rank all rows from 0 by a hex hash, plus the total as ``_total``.

    Rows fall evenly into 4,096 buckets by the first three hex digits; only the
    4,096 bucket counts are ever brought together.
    """
    placed = df.withColumn("_h", order).withColumn("_bucket", F.substring("_h", 1, 3))
    below = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    counts = (
        placed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_bucket",
            F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_below"),
            F.sum("_n").over(whole).alias("_total"),
        )
    )
    inside = Window.partitionBy("_bucket").orderBy("_h", *tie)
    return (
        placed.withColumn("_in", F.row_number().over(inside) - 1)
        .join(F.broadcast(counts), "_bucket")  # at most 4,096 rows
        .withColumn(name, F.col("_below") + F.col("_in"))
        .drop("_h", "_bucket", "_in", "_below")
    )
