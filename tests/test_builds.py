"""Whole builds: row counts, labels, partition independence, plan shape."""

import pytest
from pyspark.sql import functions as F

from telemill import constants as K
from telemill import schemas
from telemill.functions.draws import Draws
from telemill.operators.manifest import sample_manifest
from telemill.plans.fleet import build_fleet, read_devices
from telemill.plans.motor import build_motor
from telemill.plans.pump import build_pump
from telemill.queries import plan_queries as P
from telemill.session import materialize, new_path

SF = "/root/testdata/sf0.001"


def make(spark, machine, freq=300, **options):
    manifest = sample_manifest(P.suppliers(spark, SF), "s_suppkey", machine, 3.0)
    if machine == "pump":
        return build_pump(manifest, P.pump_inputs(spark, SF, freq), freq, **options)
    return build_motor(manifest, P.motor_inputs(spark, SF), freq, **options)


@pytest.fixture(scope="module", params=["pump", "motor"])
def built(spark, request):
    df = make(spark, request.param, maintenance_per_month=10.0)
    return request.param, df, materialize(df, "built")


def test_schema_and_row_counts(spark, built):
    machine, _, df = built
    schema = schemas.PUMP_SERIES if machine == "pump" else schemas.MOTOR_SERIES
    types = dict(df.dtypes)
    assert all(types[f.name] == f.dataType.simpleString() for f in schema.fields)
    per = df.groupBy("device_id").agg(F.count("*").alias("n"), F.count_distinct("row_i").alias("d"))
    assert per.where("n <> 865 or d <> 865").isEmpty()
    signals = K.PUMP_SIGNALS if machine == "pump" else K.MOTOR_SIGNALS
    bad = " or ".join(f"`{c}` is null or isnan(`{c}`)" for c in signals)
    assert df.where(bad).isEmpty()


def test_labels_follow_the_failure(spark, built):
    machine, _, df = built
    seen = {r.event_type for r in df.select("event_type").distinct().collect()}
    assert {"normal", "maintenance", "post_failure", "startup"} <= seen
    assert any(e.startswith("decoy_") for e in seen) and any(e.startswith("failure_") for e in seen)
    warn = df.where("label = 'PRE_FAILURE'")
    assert warn.where("not startswith(event_type, 'failure_')").isEmpty()
    step = warn.select(
        "time_to_failure_s",
        F.lead("time_to_failure_s").over(P_window()).alias("next"),
    ).where("next is not null")
    assert step.where("time_to_failure_s - next <> 300").isEmpty()
    most = warn.groupBy("device_id").count().agg(F.max("count")).first()[0]
    assert most == (12 if machine == "pump" else 13)
    assert df.where("label = 'FAILURE' and not (startswith(event_type, 'failure_') or event_type = 'post_failure')").isEmpty()
    down = df.where("event_type = 'post_failure'").groupBy("device_id").count().agg(F.max("count"))
    assert down.first()[0] == 72


def P_window():
    from pyspark.sql import Window

    return Window.partitionBy("device_id").orderBy("row_i")


def test_build_does_not_depend_on_partitions(spark, built):
    machine, _, df = built
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        again = make(spark, machine, maintenance_per_month=10.0)
        cols = [c for c, t in df.dtypes if t == "double"]
        both = df.alias("a").join(again.alias("b"), ["device_id", "row_i"])
        off = " or ".join(f"abs(a.`{c}` - b.`{c}`) > 1e-9" for c in cols)
        assert both.count() == df.count()
        assert both.where(f"a.event_type <> b.event_type or a.label <> b.label or {off}").isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_no_row_moves_after_the_days_are_opened(spark, built):
    _, lazy, _ = built
    plan = lazy._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    opened = next(i for i, x in enumerate(lines) if "explode(sequence(_from" in x)
    above = lines[:opened]
    assert not any("Exchange hashpartitioning" in x or "Exchange rangepartitioning" in x for x in above)
    assert not any("Python" in x or "CartesianProduct" in x for x in lines)


def test_fleet_build_resumes(spark):
    """A device finished elsewhere, one that comes out wrong, a run that broke off, and a run with nothing to do."""
    out = new_path(spark, "fleet")
    devices, inputs = P.suppliers(spark, SF), P.pump_inputs(spark, SF, 300)
    n = devices.count()
    done = spark.createDataFrame([("device_000001", "completed")], "device_id string, status string")
    bad = spark.createDataFrame([("device_000002", float("nan"))], "device_id string, noise_scale double")
    args = (devices, "s_suppkey", "pump", inputs, out, 2.0, 300)
    run = build_fleet(*args, done=done, settings=bad)
    summary = run.summary.first()
    assert (summary.completed, summary.failed, summary.total_rows) == (n - 2, 1, (n - 2) * 577)
    check = run.completeness.first()
    assert (check.expected, check.valid, check.missing) == (n, n - 2, 2)
    spark.range(5).selectExpr("'device_000002' as device_id").write.parquet(f"{out}/devices/version=2")  # broke off
    second = build_fleet(*args)
    assert [(r.device_id, r.status) for r in second.results.collect()] == [("device_000002", "completed")]
    third = build_fleet(*args)
    assert third.results.count() == 0
    states = third.manifest.groupBy("status").count().collect()
    assert [(r.status, r["count"]) for r in states] == [("completed", n)]
    rows = read_devices(spark, out).groupBy("device_id").agg(F.count("*").alias("k"), F.count_distinct("row_i").alias("d"))
    assert {(r.k, r.d) for r in rows.collect()} == {(577, 577)} and rows.count() == n - 1
    assert third.completeness.first().missing == 1  # the rows of the first device are elsewhere
    again = build_fleet(devices.limit(1), *args[1:])
    assert again.manifest.count() == n


def test_scenario_set_as_files(spark):
    from telemill.plans import scenarios as SN
    from telemill.sources.scenarios import read_scenario_dim

    units = P.suppliers(spark, SF).limit(1)
    out = new_path(spark, "scenarios")
    series = SN.pump_scenarios(units, "s_suppkey", P.pump_inputs(spark, SF, 300), 300)
    SN.write_scenario_set(series, SN.scenario_lookup(units, "pump", "s_suppkey").drop("s_suppkey"), out)
    lookup = read_scenario_dim(spark, f"{out}/lookup").orderBy("scenario_id").collect()
    assert [r.scenario_id for r in lookup] == list(range(10)) and all(r.description for r in lookup)
    back = spark.read.option("header", True).csv(f"{out}/series")
    assert back.count() == series.count() and back.select("scenario").distinct().count() == 10
    files = back.select(F.col("_metadata.file_path")).distinct().count()
    assert files == 10  # a small series is one file


def test_sample_dataset_is_reused(spark):
    from telemill.plans.fleet import write_sample_dataset

    units, inputs, out = P.suppliers(spark, SF).limit(1), P.pump_inputs(spark, SF, 300), new_path(spark, "sample")
    args = dict(freq_s=300, duration_days=8.0, decoy_types=("highload_step",))
    assert write_sample_dataset(out, units, "s_suppkey", "pump", inputs, **args)
    assert not write_sample_dataset(out, units, "s_suppkey", "pump", inputs, **args)
    rows = spark.read.parquet(f"{out}/series")
    assert rows.count() == 4 * (8 * 288 + 1)
    seen = {r.event_type for r in rows.select("event_type").distinct().collect()}
    assert {e for e in seen if e.startswith("decoy_")} == {"decoy_highload_step"}
    assert write_sample_dataset(out, units, "s_suppkey", "pump", inputs, **{**args, "duration_days": 1.0})
    assert spark.read.option("header", True).csv(f"{out}/lookup").count() == 4


@pytest.mark.parametrize("machine", ("pump", "motor"))
def test_bulk_draws_of_a_fleet(spark, machine):
    """Over ten days of many devices, weekend included, signals stay near their profile and no draw repeats."""
    devices = P.suppliers(spark, SF)
    manifest = sample_manifest(devices, "s_suppkey", machine, 10.0, method="xxhash64")
    inputs = P.pump_inputs(spark, SF, 300) if machine == "pump" else P.motor_inputs(spark, SF)
    build = build_pump if machine == "pump" else build_motor
    rows = build(manifest, inputs, 300).where("event_type = 'normal' and label = 'NORMAL'")
    signals = K.PUMP_SIGNALS if machine == "pump" else K.MOTOR_SIGNALS
    stats = rows.agg(F.count("*").alias("n"), *[F.stddev(c).alias(f"sd_{c}") for c in signals], *[F.count_if(F.isnan(c) | F.col(c).isNull()).alias(f"bad_{c}") for c in signals]).first()
    assert stats.n > 2000 * devices.count() / 2 and all(stats[f"bad_{c}"] == 0 for c in signals)
    assert sum(stats[f"sd_{c}"] > 0 for c in signals) >= len(signals) / 2
    days = {r.d for r in rows.select(F.floor(F.col("time_h") / 24).alias("d")).distinct().collect()}
    assert set(range(10)) <= days
    z = spark.range(200_000).select(Draws(5, "xxhash64").standard_normal(["id"], "s").alias("z"), Draws(5, "xxhash64").uniform(["id"], "s").alias("u"))
    m = z.agg(F.avg("z"), F.stddev("z"), F.avg("u"), F.count_distinct("u"), F.corr("z", "u")).first()
    assert abs(m[0]) < 0.012 and abs(m[1] - 1) < 0.01 and abs(m[2] - 0.5) < 0.004 and m[3] == 200_000
