"""Lookup curves: building them from measured rows and reading values off them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import LUT_POINTS
from ..session import materialize
from .joins import attach


#: Segments of a curve that a value is compared with one by one.
BLOCK_SEGMENTS = 16


def segments(lut: DataFrame, signals: Sequence[str], axis: str = "axis", param: str = "param") -> DataFrame:
    """Neighbouring curve points as ``(p0, p1, y0_*, y1_*)``, each axis's ends and ``_no``, the place from 0.

    A falling grid gives the same segments as a rising one.
    """
    w = Window.partitionBy(axis).orderBy(param)
    whole = Window.partitionBy(axis)
    points = lut.select(
        axis,
        (F.row_number().over(w) - 1).alias("_no"),
        F.col(param).alias("p0"),
        F.lead(param).over(w).alias("p1"),
        F.min(param).over(whole).alias("p_min"),
        F.max(param).over(whole).alias("p_max"),
        *[F.col(s).alias(f"y0_{s}") for s in signals],
        *[F.lead(s).over(w).alias(f"y1_{s}") for s in signals],
    )
    return points.where("p1 is not null")


def halvings(size: Column) -> Column:
    """Steps of a binary search among ``size`` elements: powers of two, falling to 1."""
    top = F.greatest(F.floor(F.log2(size.cast("double"))), F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), top), lambda j: F.pow(F.lit(2.0), top - j).cast("int"))


def last_not_above(knots: Column, steps: Column, x: Column) -> Column:
    """Index from 0 of the last of the rising ``knots`` that isn't above ``x``; 0 if all are.

    ``steps`` are the ``halvings`` of their number, so a value looks at as many knots as
    that number has binary digits, however they are spaced.
    """
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(knots, at + step) <= x, at + step).otherwise(at)
    )


def interp(
    df: DataFrame,
    lut: DataFrame,
    x: str,
    signals: Sequence[str],
    axis: str = "axis",
    param: str = "param",
    prefix: str = "at_",
    extend: bool = False,
) -> DataFrame:
    """Linear interpolation of each signal at ``x``, held at the ends of the curve.

    A value on a curve point belongs to the segment that starts there; a null value, or an
    axis of fewer than two points, gives nulls. With ``extend`` the first and last segments run on as straight lines. The segments of an
    axis form blocks of equal count; a value finds its block among their first points by
    binary search and is joined with the few segments of that block. So it meets equally
    few wherever the points are close together, and values at different places of a curve are
    different keys.
    """
    seg = materialize(
        segments(lut, signals, axis, param).withColumn("_block", F.expr(f"_no div {BLOCK_SEGMENTS}").cast("int")), "segments"
    )
    starts = seg.groupBy(F.col(axis).alias("_of"), "_block").agg(F.min("p0").alias("_p"), F.min("p_min").alias("_lo"), F.max("p_max").alias("_hi"))
    bounds = materialize(
        starts.groupBy("_of").agg(
            F.array_sort(F.collect_list("_p")).alias("_starts"), F.min("_lo").alias("_low"), F.max("_hi").alias("_high")
        ).withColumn("_halvings", halvings(F.size("_starts"))),
        "curve-bounds",
    )
    right = seg.withColumnRenamed(axis, "_axis").withColumnRenamed("_block", "_at").drop("_no")
    inside = F.when(F.col(x).isNotNull(), F.least(F.greatest(F.col(x), F.col("_low")), F.col("_high")))
    placed = (
        df.join(bounds, F.col(axis) == F.col("_of"), "left")
        .withColumn("_inside", inside)
        .withColumn("_block", last_not_above(F.col("_starts"), F.col("_halvings"), F.col("_inside")))
        .drop("_starts", "_halvings")
    )
    hit = (F.col("_inside") >= F.col("p0")) & (
        (F.col("_inside") < F.col("p1"))
        | ((F.col("p1") == F.col("p_max")) & (F.col("_inside") == F.col("p_max")))
    )
    joined = placed.join(right, (F.col("_of") == F.col("_axis")) & (F.col("_block") == F.col("_at")) & hit, "left")
    value = F.col(x) if extend else F.col("_inside")
    share = (value - F.col("p0")) / (F.col("p1") - F.col("p0"))
    out = {
        f"{prefix}{s}": F.col(f"y0_{s}") + (F.col(f"y1_{s}") - F.col(f"y0_{s}")) * share
        for s in signals
    }
    return joined.withColumns(out).drop(*right.columns, "_of", "_low", "_high", "_inside", "_block")


def curve_array(lut: DataFrame, signals: Sequence[str], axis: str = "axis", param: str = "param") -> DataFrame:
    """Each axis's points as one ``curve``: rising ``knots``, their ``halvings``, and values per signal.

    For curves of bounded length; ``interp`` takes those of any.
    """
    point = F.struct(F.col(param).cast("double").alias("p"), *[F.col(s).alias(f"y_{s}") for s in signals])
    points = lut.groupBy(axis).agg(F.array_sort(F.collect_list(point)).alias("_points")).where("size(_points) > 1")
    knots = F.col("_points.p")
    parts = [knots.alias("knots"), halvings(F.size("_points") - 1).alias("halvings")]
    return points.select(
        axis, F.struct(*parts, *[F.col(f"_points.y_{s}").alias(f"y_{s}") for s in signals]).alias("curve")
    )


def with_curve(
    df: DataFrame, x: Column, signals: Sequence[str], prefix: str = "ep_", curve: str = "curve"
) -> DataFrame:
    """Add the values at ``x`` read from a ``curve_array`` column, held at its ends.

    The segment is found once for all signals, by binary search; a null curve gives nulls.
    """
    c, at, i = F.col(curve), F.col("_at"), F.col("_seg")
    held = F.when(x.isNotNull(), F.least(F.greatest(x, F.get(c["knots"], F.lit(0))), F.element_at(c["knots"], -1)))
    # the last knot begins no segment
    found = F.least(last_not_above(c["knots"], c["halvings"], at), F.size(c["knots"]) - 2)
    p0, p1 = F.get(c["knots"], i), F.get(c["knots"], i + 1)

    def value(s):
        y0, y1 = F.get(c[f"y_{s}"], i), F.get(c[f"y_{s}"], i + 1)
        return y0 + (y1 - y0) * F.col("_share")

    return (
        df.withColumn("_at", held)
        .withColumn("_seg", F.when(c.isNotNull() & at.isNotNull(), found))
        .withColumn("_share", (at - p0) / (p1 - p0))
        .withColumns({f"{prefix}{s}": value(s) for s in signals})
        .drop("_at", "_seg", "_share")
    )


def steady_state(
    df: DataFrame,
    key: str,
    time: str,
    speed: str,
    phases: Sequence[str],
    settle: float,
    row: str = "row_i",
) -> DataFrame:
    """Mean speed and RMS current of each run once it has settled.

    Rows before ``settle`` are dropped; a run with fewer than two rows left uses
    the last half of its rows instead. Both candidates are summed up in one
    pass, so a run is never held in one place.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    squares = sum((F.col(p) * F.col(p) for p in phases), F.lit(0.0))
    late, half = F.col(time) >= settle, F.col(row) >= F.expr("_n div 2")
    agg = (
        attach(df, counts, [key])
        .groupBy(key)
        .agg(
            F.count_if(late).alias("_late"),
            F.avg(F.when(late, F.col(speed))).alias("_v_late"),
            F.avg(F.when(late, squares)).alias("_q_late"),
            F.avg(F.when(half, F.col(speed))).alias("_v_half"),
            F.avg(F.when(half, squares)).alias("_q_half"),
        )
    )
    enough = F.col("_late") >= 2
    return agg.select(
        key,
        F.when(enough, F.col("_v_late")).otherwise(F.col("_v_half")).alias("v_rot"),
        F.sqrt(F.when(enough, F.col("_q_late")).otherwise(F.col("_q_half"))).alias("i_rms"),
    )


def build_lut(
    df: DataFrame,
    param: str,
    signals: Sequence[str],
    lo: float,
    hi: float,
    axis: str,
    points: int = LUT_POINTS,
) -> DataFrame:
    """Calibration curve from measured rows: evenly spaced points from lo to hi.

    Each row counts for its nearest point; a point's value is the mean of its rows.
    Rows more than half a step below ``lo`` or above ``hi`` belong to no point.
    """
    width = (hi - lo) / (points - 1)
    idx = F.floor((F.col(param) - lo) / width + 0.5)
    return (
        df.withColumn("_i", idx)
        .where((F.col("_i") >= 0) & (F.col("_i") < points))
        .groupBy("_i")
        .agg(*[F.avg(s).alias(s) for s in signals])
        .select(F.lit(axis).alias("axis"), (F.lit(lo) + F.col("_i") * width).alias("param"), *signals)
    )
