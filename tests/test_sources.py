import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemill import schemas
from telemill.operators import status as ST
from telemill.session import new_path, shared_dir
from telemill.sources import records as R
from telemill.sources import scenarios as SC
from telemill.sources import series as SE

ROWS = T.StructType([T.StructField("time_s", T.LongType()), T.StructField("x", T.DoubleType())])


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_scenarios_side_by_side_skip_missing(spark, tmp_path):
    for name in ("normal", "wear", "not_listed"):
        (tmp_path / f"{name}.csv").write_text("time_s,x\n0,1.5\n60,2.5\n")
    lookup = new_path(spark, "lookup")
    rows = [(0, "normal", "all", "normal", False, "d"), (1, "wear", "a", "failure", True, "d"),
            (2, "gone", "a", "failure", True, "d")]
    SC.write_scenario_dim(spark.createDataFrame(rows, schemas.SCENARIOS), lookup)
    out = SC.read_scenarios(spark, lookup, str(tmp_path), ROWS).groupBy("scenario", "scenario_id").count()
    assert sorted(map(tuple, out.collect())) == [("normal", 0, 2), ("wear", 1, 2)]


def test_fleet_round_trip_and_file_per_device(spark):
    df = spark.range(1000).select(
        F.format_string("device_%06d", F.col("id") % 3).alias("device_id"),
        F.floor(F.col("id") / 3).alias("row_i"),
        F.rand(1).alias("x"),
    ).cache()
    path = new_path(spark, "fleet")
    SE.write_fleet(df, path, files=4, max_records_per_file=100)
    back = SE.read_fleet(spark, path)
    assert back.exceptAll(df).isEmpty() and back.count() == 1000
    stats = {r.device_id: (r.num_rows, r.file_size_bytes) for r in SE.file_stats(spark, path, "device_id").collect()}
    assert {k: v[0] for k, v in stats.items()} == {"device_000000": 334, "device_000001": 333, "device_000002": 333}
    files = [os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.endswith(".parquet")]
    assert abs(sum(v[1] for v in stats.values()) - sum(files)) <= 3
    per_file = SE.file_stats(spark, path)
    assert per_file.agg(F.sum("num_rows"), F.max("num_rows")).first()[:] == (1000, 100)


def test_id_from_file_name(spark, tmp_path):
    import pandas as pd

    for i in range(2):
        pd.DataFrame({"x": [1.0, 2.0]}).to_parquet(tmp_path / f"device_{i:06d}.parquet")
    out = SE.read_fleet(spark, str(tmp_path), id_from_file=True).groupBy("device_id").count()
    assert sorted(map(tuple, out.collect())) == [("device_000000", 2), ("device_000001", 2)]


def test_config_overrides_ignore_unknown_fields(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"num_devices": 5, "nonsense": 1}, indent=2))
    read = R.read_config(spark, str(path)).withColumn("k", F.lit(1))
    base = spark.createDataFrame([(1, 6000, 365.0)], "k int, num_devices long, duration_days double")
    assert tuple(R.apply_overrides(base, read, ["k"]).first()) == (1, 5, 365.0)


def test_is_current(spark):
    params = spark.createDataFrame([(30.0, 42, None)], "days double, seed int, note string")
    data, saved = new_path(spark, "data"), new_path(spark, "params")
    assert not R.is_current(spark, data, saved, params)
    spark.range(3).write.parquet(data)
    assert not R.is_current(spark, data, saved, params)
    R.write_config(params, saved)
    assert R.is_current(spark, data, saved, params)
    assert not R.is_current(spark, data, saved, params.withColumn("seed", F.lit(43)))


def test_resume_merge_and_completeness(spark):
    man = R.manifest_rows(
        spark.range(10).select(F.format_string("d%d", "id").alias("device_id"), F.array(F.lit("a"), F.lit("b")).alias("decoy_types"))
    )
    res = spark.createDataFrame(
        [(f"d{i}", 10, 100, 1.0, "completed") for i in range(8)] + [("d8", 0, 0, 0.5, "error: x")],
        schemas.RESULTS,
    )
    merged = ST.merge_results(man, res)
    assert {r.status: r["count"] for r in merged.groupBy("status").count().collect()} == {
        "completed": 8, "error: x": 1, "pending": 1}
    assert sorted(r.device_id for r in ST.pending(man, merged).collect()) == ["d8", "d9"]
    assert tuple(ST.validate(man, res).first()) == (10, 8, 2)
    assert tuple(ST.run_summary(res, 16.0).first()) == (8, 1, 80, 800, 1.0, 0.5)
    assert [tuple(r) for r in ST.failed(res).collect()] == [("d8", "error: x", 0)]
    none = ST.run_summary(res.limit(0), 0.0).first()
    assert none.avg_time_s == 0.0 and none.devices_per_s is None
    assert [t for (t,) in R.manifest_configs(man).select(F.size("decoy_types")).distinct().collect()] == [2]
