"""Work that grows with the devices is spread over tasks, and no row meets all windows of its device."""

import pytest
from pyspark.sql import functions as F

from telemill.operators import intervals as I
from telemill.operators import modulate as MO
from telemill.plans import scenarios as SN
from telemill.queries import plan_queries as P
from telemill.queries.base import r6

SF = "/root/testdata/sf0.001"


def test_motor_scenarios_are_spread(spark):
    """Units in one partition: their rows are still built by many tasks."""
    units = P.suppliers(spark, SF).coalesce(1)
    rows = SN.motor_scenarios(units, "s_suppkey", P.motor_inputs(spark, SF), 300)
    assert rows.select(F.spark_partition_id()).distinct().count() > 1
    assert rows.count() == units.count() * 10 * 73


def test_drift_of_short_series_needs_no_carry(spark):
    df = spark.range(60).selectExpr("concat('d', id % 3) device_id", "id div 3 row_i", "1.0D x")
    df = df.union(df.limit(7)).union(spark.sql("select null, 5L, 1.0D"))
    one, two = (
        MO.add_drift(df, ["x"], 0.1, P.Draws(3), longest=n).orderBy("device_id", "row_i", "x").collect()
        for n in (None, 20)
    )
    assert [(r.device_id, r.row_i) for r in one] == [(r.device_id, r.row_i) for r in two]
    assert all(abs(a.x - b.x) < 1e-12 for a, b in zip(one, two, strict=True))


def test_rounding_is_that_of_round(spark):
    """Ties, near ties, negative, huge and missing values."""
    x = (F.col("id") - 50_000) * F.lit(5e-7)
    df = spark.range(100_000).select(x.alias("a"), (F.sin("id") * 400).alias("b"), (F.col("id") * 1e7 + 0.1234565).alias("c"))
    df = df.union(spark.sql("select double('nan'), double('inf'), cast(null as double)"))
    for c in "abc":
        assert df.where(~r6(c).eqNullSafe(F.round(c, 6) + F.lit(0.0))).isEmpty()


def test_pump_scenarios_are_spread(spark):
    units = P.suppliers(spark, SF).coalesce(1)
    rows = SN.pump_scenarios(units, "s_suppkey", P.pump_inputs(spark, SF, 300), 300)
    assert rows.select(F.spark_partition_id()).distinct().count() > 1


def test_pump_scenarios_stay_where_they_are_opened(spark):
    """Their rows meet one small table, and stay in place where small tables are written by many tasks."""
    many = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "256k",
    }
    before = {k: spark.conf.get(k) for k in many}
    for k, v in many.items():
        spark.conf.set(k, v)
    try:
        rows = SN.pump_scenarios(P.suppliers(spark, SF), "s_suppkey", P.pump_inputs(spark, SF, 300), 300)
        plan = rows._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    opened = next(i for i, x in enumerate(plan) if "[row_i#" in x and "explode(" in x)
    assert sum("Join" in x for x in plan) == 1
    assert not any("Exchange" in x and "Broadcast" not in x for x in plan[:opened])


def test_pump_scenarios_of_repeated_and_missing_units(spark):
    """Every row of ``units`` gets all its scenarios, whatever its key; a repeated position repeats its rows."""
    inputs = P.pump_inputs(spark, SF, 300)
    twice = P.PumpInputs(inputs.profile.union(inputs.profile.where("phase = 'startup' and idx = 3")), inputs.episodes)
    units = spark.createDataFrame([(1,), (1,), (2,), (None,)], "u long")
    got = SN.pump_scenarios(units, "u", twice, 300).groupBy("u", "scenario_id")
    got = {(r.u, r.scenario_id): r for r in got.agg(
        F.count("*").alias("n"), F.expr("count_if(row_i = 3)").alias("third"), F.max("row_i").alias("last"),
        F.expr("count_if(label = 'FAILURE')").alias("failed"),
    ).collect()}
    assert len(got) == 30
    for (u, _), r in got.items():
        times = 2 if u == 1 else 1
        assert r.third == 2 * times and r.n == (r.last + 2) * times
        assert r.failed == (times if r.scenario_id in (1, 4, 7) else 0)


def test_spans_meet_the_windows_their_rows_do(spark):
    """Windows that touch, end at midnight, run over days, are empty, or come twice."""
    days = spark.range(6).selectExpr(
        "concat('d', id % 2) device_id", "id div 2 day", "(id div 2) * 24 _from", "least((id div 2) * 24 + 23, 65) _to"
    )
    windows = spark.createDataFrame(
        [("d0", 0, 5, "a"), ("d0", 5, 24, "b"), ("d0", 30, 70, "c"), ("d0", 8, 8, "e"), ("d1", 23, 25, "f"), ("d1", 60, 61, "g"), ("d1", 60, 61, "g")],
        "device_id string, start_row long, end_row long, kind string",
    )
    hourly = (3600, 86400)
    spans = I.lay_over_spans(days, windows, "_event", hourly, "day")
    opened = spans.select("device_id", F.explode(F.sequence("_from", "_to")).alias("row_i"), "_event")
    got = opened.select("device_id", "row_i", F.explode_outer("_event").alias("w")).select("device_id", "row_i", "w.kind")
    rows = days.select("device_id", F.explode(F.sequence("_from", "_to")).alias("row_i"))
    want = I.lay_over(rows, windows, bucket=hourly).select("device_id", "row_i", "kind")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("machine", ("pump", "motor"))
def test_built_rows_are_not_joined_with_windows(spark, machine):
    from telemill.operators.manifest import sample_manifest
    from telemill.plans.motor import build_motor
    from telemill.plans.pump import build_pump

    manifest = sample_manifest(P.suppliers(spark, SF), "s_suppkey", machine, 2.0)
    inputs = P.pump_inputs(spark, SF, 300) if machine == "pump" else P.motor_inputs(spark, SF)
    build = build_pump if machine == "pump" else build_motor
    plan = build(manifest, inputs, 300)._jdf.queryExecution().executedPlan().toString().splitlines()
    opened = next(i for i, x in enumerate(plan) if "explode(sequence(_from" in x)
    assert not any("Join [device_id" in x for x in plan[:opened])


@pytest.mark.parametrize("machine", ("pump", "motor"))
def test_opened_rows_carry_structs_and_are_ordered_once(spark, machine):
    """A device's settings, a day's walk and the windows go along as a struct each; one window sums the steps."""
    from telemill.operators.manifest import sample_manifest
    from telemill.plans.motor import build_motor
    from telemill.plans.pump import build_pump

    manifest = sample_manifest(P.suppliers(spark, SF), "s_suppkey", machine, 2.0)
    inputs = P.pump_inputs(spark, SF, 300) if machine == "pump" else P.motor_inputs(spark, SF)
    build = build_pump if machine == "pump" else build_motor
    rows = build(manifest, inputs, 300, maintenance_per_month=15.0, keep=("noise_scale", "s_suppkey"))
    assert rows.where("noise_scale is null or s_suppkey is null").isEmpty()
    plan = rows._jdf.queryExecution().executedPlan().toString().splitlines()
    opened = next(i for i, x in enumerate(plan) if "explode(sequence(_from" in x)
    carried = plan[opened].split(", [", 1)[1].split("]")[0].split(", ")
    assert len(carried) <= 8
    assert sum("- Window [" in x for x in plan[:opened]) == 1
    assert sum("- Sort [" in x for x in plan[:opened]) == 1


def test_event_noise_is_hashed_once_where_it_weighs(spark):
    """A row of a window without noise draws none; the others hash once for both uniforms."""
    from telemill.operators import overlay as O

    df = spark.range(6).selectExpr(
        "concat('d', id) device_id", "id row_i", "1.0D x", "5.0D start_x", "case id % 3 when 0 then 'a' when 1 then 'b' end kind"
    )
    quiet, loud = {"g": O.Mix(own=2.0)}, {"g": O.Mix(start=1.0, noise=0.5)}
    out = O.apply_mixes(df, [(F.col("kind") == "a", quiet), (F.col("kind") == "b", loud)], {"g": ["x"]}, {"x": 3.0}, P.Draws(7))
    got = {r.row_i: r.x for r in out.collect()}
    z = {r.row_i: r.z for r in df.select("row_i", O.event_noise("event", "x", P.Draws(7)).alias("z")).collect()}
    for i in range(6):
        want = {0: 2.0, 1: 5.0 + 1.5 * z[i], 2: 1.0}[i % 3]
        assert abs(got[i] - want) < 1e-12
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1 and "CASE WHEN NOT" in plan


@pytest.mark.parametrize("machine", ("pump", "motor"))
def test_steps_at_points_are_drawn_once(spark, machine, monkeypatch):
    """Events and failures of a sample set share one table of walked points, and keep their values."""
    from telemill.plans import fleet as FL
    from telemill.plans import layers as Y

    calls, walked_at = [], Y.walked_at
    monkeypatch.setattr(Y, "walked_at", lambda *a: calls.append(1) or walked_at(*a))
    units = P.suppliers(spark, SF).limit(2)
    inputs = P.pump_inputs(spark, SF, 300) if machine == "pump" else P.motor_inputs(spark, SF)
    series, _ = FL.sample_dataset(units, "s_suppkey", machine, inputs, 300, duration_days=1.0)
    assert len(calls) == 1
    failing = series.where("startswith(event_type, 'failure_')")
    assert failing.select("device_id").distinct().count() == 6
    assert series.where("r_radial is null" if machine == "pump" else "current_rms_A is null").isEmpty()
