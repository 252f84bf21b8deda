"""Ordered operators with tiny chunks and one key that holds most of the rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from telemill.operators import analyse as A
from telemill.operators.chunks import (
    CHUNK,
    global_rank,
    neighbours,
    running,
    trailing_sum,
    with_chunk,
    with_row_index,
)


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(5)
    parts = []
    for dev, n in ((1, 400), (2, 37), (3, 1), (4, 64)):
        kinds = np.repeat(rng.choice(["a", "b", "normal"], n), rng.integers(1, 6, n))[:n]
        parts.append(
            pd.DataFrame(
                {
                    "device_id": dev,
                    "row_i": np.arange(n),
                    "t": np.arange(n) * 2.0,
                    "x": rng.normal(size=n).round(3),
                    "k": kinds,
                }
            )
        )
    pdf = pd.concat(parts, ignore_index=True)
    return pdf, spark.createDataFrame(pdf.sample(frac=1, random_state=1)).repartition(3)


def test_running(series):
    pdf, df = series
    marked = df.withColumn("m", F.when(F.col("k") == "a", F.col("x")))
    out = running(
        with_chunk(marked, rows=16),
        ["device_id"],
        {"s": ("x", "sum"), "top": ("x", "max"), "seen": ("m", "last")},
        ["row_i"],
    ).drop(CHUNK)
    got = out.toPandas().sort_values(["device_id", "row_i"]).reset_index(drop=True)
    g = pdf.groupby("device_id").x
    assert np.allclose(got.s, g.cumsum())
    assert np.allclose(got.top, g.cummax())
    want = pdf.x.where(pdf.k == "a").groupby(pdf.device_id).ffill()
    assert np.allclose(got.seen.astype(float), want, equal_nan=True)


def test_neighbours_and_trailing_sum(series):
    pdf, df = series
    near = neighbours(df, ["device_id"], {"prev": ("x", -1), "next": ("x", 2)}, rows=16)
    got = near.toPandas().sort_values(["device_id", "row_i"]).reset_index(drop=True)
    assert len(got) == len(pdf)
    g = pdf.groupby("device_id").x
    assert np.allclose(got.prev.astype(float), g.shift(1), equal_nan=True)
    assert np.allclose(got.next.astype(float), g.shift(-2), equal_nan=True)
    out = trailing_sum(df, ["device_id"], "s", F.col("x"), 20, rows=16)
    got = out.toPandas().sort_values(["device_id", "row_i"]).reset_index(drop=True)
    want = g.rolling(20, min_periods=1).sum().reset_index(drop=True)
    assert np.allclose(got.s, want)


def test_row_index_of_a_hot_key(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"k": rng.choice([1, 1, 1, 2, 3], 3000), "t": rng.integers(0, 50, 3000)})
    pdf["id"] = rng.permutation(3000)
    got = with_row_index(spark.createDataFrame(pdf).repartition(5), ["k"], ["t", "id"]).toPandas()
    want = pdf.sort_values(["k", "t", "id"])
    want["row_i"] = want.groupby("k").cumcount()
    m = got.merge(want, on=["k", "t", "id"])
    assert len(m) == 3000 and (m.row_i_x == m.row_i_y).all()


def test_global_rank_is_a_permutation(spark):
    df = spark.range(1000).withColumn("h", F.md5(F.col("id").cast("string")))
    out = global_rank(df, F.col("h"), "r", ["id"]).orderBy("h").select("r", "_total").collect()
    assert [r.r for r in out] == list(range(1000)) and out[0]["_total"] == 1000


def brute_spans(pdf):
    out = []
    for dev, g in pdf.groupby("device_id"):
        g = g.reset_index(drop=True)
        first = 0
        for i in range(1, len(g) + 1):
            if i == len(g) or g.k[i] != g.k[first]:
                end = g.t[i] if i < len(g) else g.t[len(g) - 1]
                out.append((dev, first, g.t[first], end, g.k[first], i - first))
                first = i
    return out


def test_event_spans(series):
    pdf, df = series
    got = A.event_spans(df, "k", "t", chunk_rows=16).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute_spans(pdf))


def test_busiest_window(series):
    pdf, df = series
    got = {
        r.device_id: (r.centre, r.start_row, r.end_row)
        for r in A.busiest_window(df, 30, "k", label=None, chunk_rows=16).collect()
    }
    for dev, g in pdf.groupby("device_id"):
        busy = (g.k != "normal").to_numpy()
        n = len(g)
        if busy.any():
            sums = [busy[max(0, i - 29) : i + 1].sum() for i in range(n)]
            centre = int(np.argmax(sums))
        else:
            centre = n // 2
        start = max(0, centre - 15)
        end = min(n, start + 30)
        assert got[dev] == (centre, max(0, end - 30), end)


def test_zoom_clips_at_the_ends(spark):
    rows = [(1, i, "FAILURE" if i == 3 else "NORMAL") for i in range(20)]
    rows += [(2, i, "NORMAL") for i in range(5)]
    df = spark.createDataFrame(rows, "device_id int, row_i long, label string")
    got = A.zoom(df, 6).collect()
    assert sorted(r.row_i for r in got) == list(range(9)) and {r.device_id for r in got} == {1}


def test_interp_of_a_long_curve_with_a_constant_axis(spark):
    import numpy as np

    from telemill.operators.lut import interp

    rnd = np.random.default_rng(3)
    p = np.sort(rnd.uniform(-3, 9, 20_000) ** 3)
    y = rnd.normal(size=len(p))
    lut = spark.createDataFrame([("a", float(u), float(v)) for u, v in zip(p, y)], "axis string, param double, s double")
    x = np.concatenate([rnd.uniform(-40, 800, 2_000), p[:50], p[-50:]])
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i long, x double")
    out = interp(df.selectExpr("*", "'a' as axis"), lut, "x", ["s"])
    got = [r.at_s for r in out.orderBy("i").collect()]
    assert np.allclose(got, np.interp(x, p, y), atol=1e-6)
    plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
    assert any("Join [" in x and "_block" in x for x in plan)  # segments meet by key
    assert sum("NestedLoopJoin" in x for x in plan) <= 2  # the ends of an axis are one row (initial and final plan)


def test_tiling_keeps_rows_that_the_profile_lacks(spark):
    from telemill.operators.spine import tile

    rows = spark.range(12).selectExpr("id as row_i")
    template = spark.createDataFrame([("startup", 0, 1.0), ("cycle", 0, 2.0)], "phase string, idx long, v double")
    out = tile(rows, template, ["v"], 2, 2)
    assert [r.v for r in out.orderBy("row_i").collect()] == [1.0, None] + [2.0, None] * 5
    assert "BuildLeft" not in out._jdf.queryExecution().executedPlan().toString()


def test_curves_with_points_at_one_end(spark):
    """A log-spaced curve of 100,000 points: by blocks, and as an array."""
    import numpy as np

    from telemill.operators.lut import curve_array, interp, with_curve

    rnd = np.random.default_rng(4)
    p = np.logspace(-9, 3, 100_000)
    y = np.sin(np.log(p)) * 50
    lut = spark.createDataFrame([("a", float(u), float(v)) for u, v in zip(p, y)] + [("b", 0.0, 1.0), ("b", 2.0, 5.0), ("c", 1.0, 1.0)], "axis string, param double, s double")
    x = np.concatenate([10 ** rnd.uniform(-10, 4, 500), p[:20], p[-20:], [0.0, -1.0, 1e9]])
    df = spark.createDataFrame([(i, "a", float(v)) for i, v in enumerate(x)] + [(9_001, "b", 0.5), (9_002, "c", 1.0), (9_003, "none", 1.0), (9_004, "a", None)], "i long, axis string, x double")
    want = np.interp(x, p, y)
    out = {r.i: r.at_s for r in interp(df, lut, "x", ["s"]).collect()}
    assert np.allclose([out[i] for i in range(len(x))], want, atol=1e-9)
    assert out[9_001] == 2.0 and out[9_002] is None and out[9_003] is None and out[9_004] is None and len(out) == len(x) + 4
    arr = curve_array(lut, ["s"])
    read = {r.i: r.ep_s for r in with_curve(df.join(arr, "axis", "left"), F.col("x"), ["s"]).select("i", "ep_s").collect()}
    assert np.allclose([read[i] for i in range(len(x))], want, atol=1e-9)
    assert read[9_001] == 2.0 and read[9_002] is None and read[9_003] is None and read[9_004] is None


def test_no_value_meets_a_whole_curve(spark):
    """However close its points are, a value is compared with the segments of one block."""
    import numpy as np

    from telemill.operators import lut as LU

    p = np.concatenate([np.linspace(0, 1e-6, 5_000), [1.0, 2.0]])
    lut = spark.createDataFrame([("a", float(u), float(i)) for i, u in enumerate(p)], "axis string, param double, s double")
    seg = LU.segments(lut, ["s"]).withColumn("_block", F.expr(f"_no div {LU.BLOCK_SEGMENTS}"))
    assert seg.groupBy("_block").count().agg(F.max("count")).first()[0] <= LU.BLOCK_SEGMENTS


@pytest.mark.parametrize("length", (1, 7, 20, 21, 64, 500, 5_000))
def test_trailing_sums_of_any_length(spark, length):
    """Windows within a chunk, of a whole chunk, over several, and longer than the series."""
    import numpy as np

    from telemill.operators.chunks import trailing_sum

    rnd = np.random.default_rng(length)
    series = {"a": rnd.integers(0, 5, 333).tolist(), "b": rnd.integers(0, 5, 20).tolist(), None: [1, None, 2]}
    rows = [(k, i, v, "x") for k, own in series.items() for i, v in enumerate(own)]
    df = spark.createDataFrame(rows, "device_id string, row_i long, v long, _row string")
    out = trailing_sum(df.drop("_row") if length > 20 else df, ["device_id"], "s", F.col("v"), length, rows=20)
    got = {(r.device_id, r.row_i): r.s for r in out.collect()}
    want = {(k, i): sum(x or 0 for x in own[max(0, i - length + 1) : i + 1]) for k, own in series.items() for i in range(len(own))}
    assert got == want


def test_long_trailing_sums_join_no_rows_and_bound_each_task(spark, monkeypatch):
    from telemill.operators import chunks

    monkeypatch.setattr(chunks, "INDEX_ROWS", 200)
    df = spark.range(4_000).selectExpr("concat('d', id % 2) device_id", "id div 2 row_i", "id % 5 v", "id tag")
    out = chunks.trailing_sum(df, ["device_id"], "s", F.col("v"), 300, rows=20)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert "REPARTITION_BY_NUM" in plan and out.rdd.getNumPartitions() >= 2 * 4_000 // 200
    rows = {(r.device_id, r.row_i): r for r in out.collect()}
    assert len(rows) == 4_000 and all(r.tag == 2 * r.row_i + int(r.device_id[1]) for r in rows.values())
    v = [2 * i % 5 for i in range(2_000)]
    assert all(rows["d0", i].s == sum(v[max(0, i - 299) : i + 1]) for i in range(2_000))
