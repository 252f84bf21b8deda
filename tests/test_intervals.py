import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from telemill.functions.draws import Draws
from telemill.operators import intervals as I


def greedy(pdf):
    kept = []
    for _, g in pdf.sort_values(["device_id", "start_row", "n"]).groupby("device_id"):
        reached = float("-inf")
        for r in g.itertuples():
            if r.start_row >= reached:
                kept.append((r.device_id, r.n))
                reached = r.end_row
    return sorted(kept)


def random_windows(seed, length):
    rng = np.random.default_rng(seed)
    n = 600
    pdf = pd.DataFrame(
        {"device_id": rng.choice([1, 1, 1, 2, 3], n), "n": np.arange(n), "start_row": rng.integers(0, 2000, n)}
    )
    pdf["end_row"] = pdf.start_row + rng.integers(1, length, n)
    return pdf


@pytest.mark.parametrize("length,shift,bucket", [(8, 0, 50), (60, -1000, 50), (60, -5000, 7), (400, -700, 3000)])
def test_walk_matches_brute_force(spark, length, shift, bucket):
    pdf = random_windows(length, length)
    pdf[["start_row", "end_row"]] += shift
    out = I.non_overlapping(spark.createDataFrame(pdf), ids=["n"], bucket=(1, bucket))
    assert sorted((r.device_id, r.n) for r in out.collect()) == greedy(pdf)


def test_walk_of_touching_nested_and_equal_windows(spark):
    rows = [(1, 0, 0, 10), (1, 1, 10, 20), (1, 2, 12, 15), (1, 3, 20, 25), (1, 4, 20, 22), (1, 5, 24, 30)]
    df = spark.createDataFrame(rows, "device_id int, n int, start_row long, end_row long")
    kept = I.non_overlapping(df, ids=["n"]).collect()
    assert sorted(r.n for r in kept) == [0, 1, 3]


def test_walk_below_zero_and_of_empty_windows(spark):
    rows = [(1, 0, -500, -400), (1, 1, -300, -200), (1, 2, 5, 9), (1, 3, 5, 5), (1, 4, 9, 9), (1, 5, 9, 12), (1, 6, 9, 10)]
    df = spark.createDataFrame(rows, "device_id int, n int, start_row long, end_row long")
    for bucket in (3, 1440):
        kept = I.non_overlapping(df, ids=["n"], bucket=(1, bucket)).collect()
        assert sorted(r.n for r in kept) == [0, 1, 2, 4, 5]
    assert I.non_overlapping(df.limit(0), ids=["n"]).count() == 0


@pytest.mark.parametrize("piece, spans", [(2, (3, 12)), (7, (5,))])
def test_walk_through_many_levels(spark, monkeypatch, piece, spans):
    """Chains that never meet (a window of 2 rows at every row), and one window over many others."""
    monkeypatch.setattr(I, "PIECE", piece)
    monkeypatch.setattr(I, "SPANS", spans)
    grid = pd.DataFrame({"device_id": 1, "start_row": np.arange(-40, 90)})
    grid["end_row"] = grid.start_row + 2
    burst = pd.DataFrame({"device_id": 2, "start_row": np.repeat(np.arange(30), 3)})
    burst["end_row"] = burst.start_row + 1 + burst.index % 5
    long = pd.DataFrame({"device_id": [3] * 61, "start_row": [0, *range(1, 61)], "end_row": [43, *range(2, 62)]})
    pdf = pd.concat([grid, burst, long, random_windows(30, 8).assign(device_id=4)], ignore_index=True)
    pdf["n"] = np.arange(len(pdf))
    out = I.non_overlapping(spark.createDataFrame(pdf), ids=["n"], bucket=(1, 4))
    assert sorted((r.device_id, r.n) for r in out.collect()) == greedy(pdf)


def test_poisson_at_high_rates(spark):
    for method in ("md5", "xxhash64"):
        x = spark.range(400).select(Draws(1, method).poisson(F.lit(2000.0), ["id"], "p").alias("n")).toPandas().n
        assert abs(x.mean() - 2000) < 5 * np.sqrt(2000 / 400)
        assert 0.8 < x.var() / 2000 < 1.25


def test_equal_ranks_go_to_the_later_start(spark):
    rows = spark.range(10).select(F.lit(1).alias("device_id"), F.col("id").alias("row_i"))
    w = spark.createDataFrame(
        [(1, 2, 8, "decoy_z"), (1, 4, 6, "decoy_a"), (1, 4, 6, "decoy_b")], "device_id int, start_row long, end_row long, kind string"
    )
    got = [r.event_type for r in I.resolve_events(rows, w, ["decoy"]).orderBy("row_i").collect()]
    assert got == ["normal"] * 2 + ["decoy_z"] * 2 + ["decoy_b"] * 2 + ["decoy_z"] * 2 + ["normal"] * 2


def test_clear_of(spark):
    a, b = random_windows(1, 40), random_windows(2, 40).head(60)
    out = I.clear_of(
        spark.createDataFrame(a), spark.createDataFrame(b[["device_id", "start_row", "end_row"]]),
        ids=["n"], bucket=(1, 50),
    )
    want = [
        r.n
        for r in a.itertuples()
        if not any(
            s.device_id == r.device_id and r.start_row < s.end_row and s.start_row < r.end_row
            for s in b.itertuples()
        )
    ]
    assert sorted(r.n for r in out.collect()) == sorted(want)


def test_lay_over_matches_range_join(spark):
    w = random_windows(3, 90).head(80)
    rows = pd.DataFrame({"device_id": np.repeat([1, 2, 3], 700), "row_i": np.tile(np.arange(700) * 3, 3)})
    got = I.lay_over(
        spark.createDataFrame(rows), spark.createDataFrame(w), bucket=(1, 64), how="inner"
    ).count()
    m = rows.merge(w, on="device_id")
    assert got == ((m.row_i >= m.start_row) & (m.row_i < m.end_row)).sum()


def test_poisson_events(spark):
    df = spark.range(400).select(F.col("id").alias("device_id"), F.lit(10.5).alias("days"))
    ev = I.poisson_events(df, F.lit(2.0), F.col("days"), Draws(1), "x").toPandas()
    assert abs(len(ev) / 400 - 21) < 4 * np.sqrt(21 / 400)
    assert ev.time_s.between(0, 10.5 * 86400).all()
    assert abs(ev.time_s.mean() / 86400 - 5.25) < 0.2


def test_event_precedence(spark):
    rows = spark.range(20).select(F.lit(1).alias("device_id"), F.col("id").alias("row_i"))
    w = spark.createDataFrame(
        [(1, 2, 8, "decoy_x"), (1, 5, 12, "failure_y"), (1, 10, 15, "post_failure"), (1, 14, 16, "startup")],
        "device_id int, start_row long, end_row long, kind string",
    )
    out = I.resolve_events(rows, w, ["maintenance", "decoy", "failure", "post_failure", "startup"])
    got = [r.event_type for r in out.orderBy("row_i").collect()]
    want = ["normal"] * 2 + ["decoy_x"] * 3 + ["failure_y"] * 5 + ["post_failure"] * 4 + ["startup"] * 2
    assert got == want + ["normal"] * 4
