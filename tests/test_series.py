"""Labels, curves, overlays and small fixtures with known answers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemill.functions import curves as C
from telemill.functions.draws import Draws
from telemill.operators import labels as L
from telemill.operators import lut as LU
from telemill.operators import overlay as O
from telemill.operators import spine as S
from telemill.operators.manifest import assign_quota


def rows(spark, n, dev=1):
    return spark.range(n).select(F.lit(dev).alias("device_id"), F.col("id").alias("row_i"))


def test_label_tail_counts_down(spark):
    df = rows(spark, 361).withColumn("faulty", F.lit(True))
    out = L.label_tail(df, "faulty", 60).orderBy("row_i").collect()
    assert [r.label for r in out].count("NORMAL") == 300
    assert [r.label for r in out].count("PRE_FAILURE") == 60
    assert out[360].label == "FAILURE" and out[360].time_to_failure_s == 0
    assert [r.time_to_failure_s for r in out[300:]] == [3600.0 - 60 * i for i in range(61)]
    assert out[299].time_to_failure_s == -1.0
    calm = L.label_tail(df.withColumn("faulty", F.lit(False)), "faulty", 60)
    assert calm.where("label <> 'NORMAL' or time_to_failure_s <> -1").isEmpty()


def test_label_episode_extra_row_and_short_start(spark):
    df = rows(spark, 500)
    ep = spark.createDataFrame([(1, 100, 300)], "device_id int, start_row long, fail_row long")
    for extra, first in ((0, 240), (1, 239)):
        out = L.label_episode(df, ep, 60, inclusive_extra=extra)
        pre = [r.row_i for r in out.where("label = 'PRE_FAILURE'").collect()]
        assert (min(pre), max(pre)) == (first, 299)
        assert [r.row_i for r in out.where("label = 'FAILURE'").collect()] == [300]
    ep = spark.createDataFrame([(1, 280, 300)], "device_id int, start_row long, fail_row long")
    pre = L.label_episode(df, ep, 60).where("label = 'PRE_FAILURE'").agg(F.min("row_i")).first()[0]
    assert pre == 280


def test_first_crossing_and_fallback(spark):
    df = rows(spark, 100).withColumn("v", 100 - F.col("row_i"))
    df = df.unionByName(rows(spark, 50, 2).withColumn("v", F.lit(99).cast("long")))
    got = {r.device_id: r.fail_row for r in L.first_crossing(df, "v", F.lit(40)).collect()}
    assert got == {1: 61, 2: 49}


@pytest.mark.parametrize("falling", [False, True])
def test_interpolation_holds_and_extends(spark, falling):
    pts = [(0.0, 10.0), (1.0, 20.0), (3.0, 0.0)]
    lut = spark.createDataFrame(
        [("a", p, y) for p, y in (reversed(pts) if falling else pts)], "axis string, param double, y double"
    )
    xs = [-1.0, 0.0, 0.25, 1.0, 2.0, 3.0, 9.0]
    df = spark.createDataFrame([("a", x) for x in xs], "axis string, x double")
    got = [r.at_y for r in LU.interp(df, lut, "x", ["y"]).orderBy("x").collect()]
    assert np.allclose(got, np.interp(xs, [0, 1, 3], [10, 20, 0]))
    far = [r.at_y for r in LU.interp(df, lut, "x", ["y"], extend=True).orderBy("x").collect()]
    assert far[0] == 0.0 and far[-1] == -60.0
    arr = df.join(LU.curve_array(lut, ["y"]), "axis")
    read = [r.ep_y for r in LU.with_curve(arr, F.col("x"), ["y"]).orderBy("x").collect()]
    assert np.allclose(read, got)


def test_degrade_and_schedules(spark):
    t = F.col("id")
    df = spark.range(0, 8000, 100)
    out = df.select(
        C.degrade(t, 1.0, 5.0, 4000).alias("w"),
        C.degrade(t, 1.0, 5.0, 0).alias("z"),
        C.cyclic(t).alias("c"),
        C.step(t, 1.0, 2.0).alias("s"),
        C.ramp(t, 0.0, 10.0, 1000, 2000).alias("r"),
    ).collect()
    want = [1 + 4 * (math.exp(3 * min(i * 100 / 4000, 1)) - 1) / (math.exp(3) - 1) for i in range(80)]
    assert np.allclose([r.w for r in out], want)
    assert all(r.z == 5.0 for r in out)
    assert out[0].c == 471.2389 and out[20].c == 571.2389 and abs(out[18].c - 471.2389) < 1e-9
    assert (out[71].s, out[72].s) == (1.0, 2.0)
    assert (out[10].r, out[20].r, out[40].r) == (0.0, 5.0, 10.0)


def test_duty_factor_shape(spark):
    h = F.col("id") / 2.0
    f = [r.f for r in spark.range(24 * 14).select(C.duty_factor(h, 0.5, 0.6, True).alias("f")).collect()]
    assert f[24] == 1.0 and abs(f[4] - 0.7) < 1e-12  # noon, 2 h
    assert abs(f[11] - (1 - 0.3 * (1 - 0.25))) < 1e-12  # 5:30, blended
    assert abs(f[2 * (24 * 5 + 12)] - 0.85) < 1e-12  # Saturday noon


def test_splice_meets_the_series(spark):
    df = rows(spark, 200).withColumn("x", F.col("row_i") * 1.0)
    w = spark.createDataFrame([(1, 50, 120, "e")], "device_id int, start_row long, end_row long, kind string")
    ep = spark.range(70).select(F.lit("e").alias("kind"), F.col("id").alias("idx"), (F.col("id") * 3.0 + 500).alias("x"))
    got = [r.x for r in O.splice(df, w, ep, ["x"]).orderBy("row_i").collect()]
    assert got[:51] == [float(i) for i in range(51)]  # first row unchanged
    assert got[80:120] == [50 + 3.0 * (i - 50) for i in range(80, 120)]
    assert got[120] == 120.0


def test_shutdown_ramps_to_zero_and_back(spark):
    df = rows(spark, 300).withColumns({"v": F.lit(10.0), "t_K": F.lit(350.0)})
    w = spark.createDataFrame([(1, 100, 220)], "device_id int, start_row long, end_row long")
    out = O.overlay_shutdown(df, w, {"v": 0.0}, {"t_K": 0.0}, 60, Draws(1)).orderBy("row_i").collect()
    v, t = [r.v for r in out], [r.t_K for r in out]
    assert v[99] == v[100] == 10.0 and v[115] == pytest.approx(5.0) and v[150] == 0.0
    assert v[190] == pytest.approx(0.0) and v[205] == pytest.approx(5.0) and v[220] == 10.0
    hot = 290 + 60 * (1 - 0.5 * (1 - math.cos(math.pi * 29 / 30)))
    assert t[130] == pytest.approx(hot) and t[140] == pytest.approx(290 + (hot - 290) * math.exp(-10 / 120))


def test_quota_is_exact(spark):
    df = spark.range(103)
    out = assign_quota(df, "id", [("a", 0.2), ("b", 0.2), ("c", 0.5)], 9)
    got = {r.failure_type: r["count"] for r in out.groupBy("failure_type").count().collect()}
    assert got == {"a": 20, "b": 20, "c": 51, None: 12}
    with pytest.raises(ValueError):
        assign_quota(df, "id", [("a", 0.9), ("b", 0.2)], 9)


def test_spine_row_counts(spark):
    dev = spark.createDataFrame([(1, 1.0), (2, 0.3), (3, 2.5)], "device_id int, duration_days double")
    for freq in (60, 7, 3600):
        out = S.spine(dev, freq).groupBy("device_id").agg(F.count("*").alias("n"), F.max("row_i").alias("m"))
        for r in out.collect():
            d = {1: 1.0, 2: 0.3, 3: 2.5}[r.device_id]
            assert r.n == int(d * 86400 / freq) + 1 and r.m == r.n - 1
    days = S.spine(dev, 7)
    assert days.where("day <> time_s div 86400").isEmpty()


def test_tile_cuts_the_last_cycle(spark):
    tmpl = spark.createDataFrame(
        [("startup", i, 100.0 + i) for i in range(4)] + [("cycle", i, float(i)) for i in range(3)],
        "phase string, idx long, x double",
    )
    got = [r.x for r in S.tile(rows(spark, 12), tmpl, ["x"], 4, 3).orderBy("row_i").collect()]
    assert got == [100, 101, 102, 103, 0, 1, 2, 0, 1, 2, 0, 1]
    short = [r.x for r in S.tile(rows(spark, 2), tmpl, ["x"], 4, 3).orderBy("row_i").collect()]
    assert short == [100, 101]


def test_steady_state_fallback(spark):
    data = [(1, i, i * 0.5, float(i), 3.0, 4.0, 0.0) for i in range(8)]
    data += [(2, i, i * 0.1, float(i), 3.0, 4.0, 0.0) for i in range(5)]
    df = spark.createDataFrame(data, "run int, row_i long, t double, v double, a double, b double, c double")
    got = {r.run: (r.v_rot, r.i_rms) for r in LU.steady_state(df, "run", "t", "v", ["a", "b", "c"], 1.0).collect()}
    assert got == {1: (4.5, 5.0), 2: (3.0, 5.0)}
