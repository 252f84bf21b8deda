"""Fleet folders: blocks of days in files, concurrent runs, unfinished runs, tables that go."""

import os

import pytest
from pyspark.sql import functions as F

from telemill import constants as K
from telemill.functions.draws import Draws
from telemill.operators.manifest import sample_manifest
from telemill.plans import fleet as FL
from telemill.plans import layers as Y
from telemill.queries import plan_queries as P
from telemill.session import new_path, shared_dir
from telemill.sources.commits import claim, create_once, numbers, text_of

SF = "/root/testdata/sf0.001"


def stored(spark):
    return set(os.listdir(shared_dir(spark).removeprefix("file:")))


def test_only_one_creates_a_number(spark):
    folder = new_path(spark, "numbers")
    assert numbers(spark, folder) == []
    assert create_once(spark, f"{folder}/00000003", "a") and not create_once(spark, f"{folder}/00000003", "b")
    assert text_of(spark, folder, 3) == "a"
    assert [claim(spark, folder), claim(spark, folder, "x")] == [4, 5]
    assert numbers(spark, folder) == [3, 4, 5] and text_of(spark, folder, 5) == "x"
    assert not [x for x in os.listdir(folder) if x.startswith(".") and not x.endswith(".crc")]


def fleet(spark, out, **changes):
    """Five devices at a row an hour."""
    args = dict(duration_days=60.0, freq_s=3600) | changes
    devices = P.suppliers(spark, SF).where(f"s_suppkey < {args.pop('most', 5)}")
    return FL.build_fleet(devices, "s_suppkey", "motor", P.motor_inputs(spark, SF), out, **args)


def test_blocks_of_days(spark, monkeypatch):
    """A device lies in one file for each block, reading it opens only those, and one scan checks all rows."""
    plans, real = [], FL.materialize

    def watched(df, name):
        if name == "device-files":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(FL, "materialize", watched)
    out = new_path(spark, "blocks")
    before = stored(spark)
    run = fleet(spark, out)
    scans = [p.count("FileScan parquet") for p in plans if "rotational_velocity_rads" in p]
    assert scans == [1]
    assert run.summary.first().completed == 5
    blocks = -(-60 // Y.BLOCK_DAYS) + (1 if 60 % Y.BLOCK_DAYS == 0 else 0)  # the last row may begin a new block
    per = spark.read.parquet(f"{out}/files").groupBy("device_id").agg(F.count(F.lit(1)).alias("files"), F.sum("num_rows").alias("n"))
    assert {r.n for r in per.collect()} == {60 * 24 + 1} and max(r.files for r in per.collect()) <= blocks
    one = FL.read_devices(spark, out, ["motor_000003"])
    mine = {os.path.basename(r.file) for r in spark.read.parquet(f"{out}/files").where("device_id = 'motor_000003'").collect()}
    opened, all_ = ({os.path.basename(f) for f in df.inputFiles() if "/devices/" in f} for df in (one, FL.read_devices(spark, out)))
    assert opened == mine <= all_ and len(mine) <= blocks
    assert one.count() == 60 * 24 + 1 and one.select("device_id").distinct().count() == 1
    whole = FL.read_devices(spark, out).where("device_id = 'motor_000003'")
    assert one.exceptAll(whole.select(one.columns)).isEmpty()
    assert FL.read_devices(spark, out, ["nobody"]).count() == 0
    # of all that was stored on the way only the small tables of the report are left
    left = {x.split("-")[1] for x in stored(spark) - before if x.startswith("fleet-")}
    assert left == {"results", "summary", "completeness"} and len(stored(spark) - before) <= 4
    times = run.results.agg(F.sum("generation_time_s"), F.min("generation_time_s")).first()
    assert times[0] > 0 and times[1] > 0


def test_two_runs_at_once(spark, monkeypatch):
    """A run that begins and ends inside another keeps its devices, and no row comes twice."""
    out, real, inner = new_path(spark, "both"), FL.write_devices, []

    def between(series, path):
        real(series, path)
        if not inner:
            inner.append(True)
            # its tables would go with the scope it is called in
            inner.append(fleet(spark, out, duration_days=2.0, most=8).summary.first().completed)

    monkeypatch.setattr(FL, "write_devices", between)
    outer = fleet(spark, out, duration_days=2.0)
    assert numbers(spark, f"{out}/claims") == [1, 2] == numbers(spark, f"{out}/commits")
    states = {r.device_id: (r.status, r.data_version) for r in FL.stored_manifest(spark, out).collect()}
    assert len(states) == 8 and {s for s, _ in states.values()} == {"completed"}
    assert sorted(v for _, v in states.values()) == [1] * 5 + [2] * 3
    rows = FL.read_devices(spark, out).groupBy("device_id").agg(F.count("*").alias("n"), F.count_distinct("row_i").alias("d"))
    assert [(r.n, r.d) for r in rows.collect()] == [(49, 49)] * 8
    assert outer.manifest.count() == 8 and inner[1] == 8


def test_a_number_taken_while_merging(spark, monkeypatch):
    """Another run commits between a run's merge and its own commit: it merges again."""
    out, real, inner = new_path(spark, "race"), FL.create_once, []

    def between(spark_, path, text):
        if "/commits/" in path and not inner:
            inner.append(True)
            fleet(spark, out, duration_days=2.0, most=7)
        return real(spark_, path, text)

    monkeypatch.setattr(FL, "create_once", between)
    fleet(spark, out, duration_days=2.0)
    assert numbers(spark, f"{out}/commits") == [1, 2]
    manifest = FL.stored_manifest(spark, out)
    assert manifest.count() == 7 and manifest.where("status = 'completed'").count() == 7
    assert FL.read_devices(spark, out).count() == 7 * 49


def test_unfinished_versions_stay_unread(spark):
    out = new_path(spark, "unfinished")
    fleet(spark, out, duration_days=2.0)
    claim(spark, f"{out}/claims")  # a run that broke off while it wrote its manifest
    FL.stored_manifest(spark, out).drop("version").limit(2).write.parquet(f"{out}/manifest/run=2-0")
    assert FL.stored_manifest(spark, out).count() == 5
    again = fleet(spark, out, duration_days=2.0, most=6)
    assert [r.device_id for r in again.results.collect()] == ["motor_000005"]
    assert {r.data_version for r in FL.stored_manifest(spark, out).collect()} == {1, 3}


@pytest.fixture(scope="module")
def walked(spark):
    draws = Draws("seed", "md5")
    walk = (K.PUMP_TEMPS, 0.5, draws)
    devices = sample_manifest(P.suppliers(spark, SF).where("s_suppkey < 4"), "s_suppkey", "pump", 17.3)
    days = Y.place_days(devices.withColumn("n_rows", F.lit(0)), 1800, *walk)
    return walk, days, Y.open_days(days, 1800, *walk).cache()


def test_sums_without_order(walked):
    """Sums of the walk over each day, without a sort, are those of the walk itself."""
    walk, days, rows = walked
    free = Y.open_for_sums(days, 1800, *walk)
    assert "Window" not in free._jdf.queryExecution().executedPlan().toString().split("explode(sequence(_from")[0]
    sums = [F.sum(f"_w_{c}").alias(c) for c in walk[0]]
    a = {(r.device_id, r.day): r for r in rows.groupBy("device_id", "day").agg(*sums).collect()}
    b = {(r.device_id, r.day): r for r in free.groupBy("device_id", "day").agg(*sums).collect()}
    assert set(a) == set(b) and len(a) == 4 * 18
    assert all(abs(a[k][c] - b[k][c]) < 1e-8 for k in a for c in walk[0])


def test_rows_for_sums_carry_structs(walked):
    """The pass for the means takes a device's settings along as one struct, and its sums are the same."""
    walk, days, _ = walked
    plain = Y.open_for_sums(days, 1800, *walk)
    days = days.withColumn("mean_level", F.lit(1.0))
    packed = Y.open_for_sums(days, 1800, *walk, ["noise_scale", "mean_level"])
    plan = packed._jdf.queryExecution().executedPlan().toString().splitlines()
    opened = next(x for x in plan if "explode(sequence(_from" in x)
    assert len(opened.split(", [", 1)[1].split("]")[0].split(", ")) <= 6
    assert Y.beside(packed, Y.UNIT).where("noise_scale is null or mean_level <> 1").isEmpty()
    sums = [F.sum(f"_w_{c}").alias(c) for c in walk[0]]
    a, b = (x.groupBy("device_id").agg(*sums).orderBy("device_id").collect() for x in (plain, packed))
    assert len(a) == 4 and all(abs(x[c] - y[c]) < 1e-8 for x, y in zip(a, b, strict=True) for c in walk[0])


def test_walk_at_points(spark, walked):
    """First and last rows of days, several points of one day, and a repeated point."""
    walk, days, rows = walked
    ids = [r[0] for r in days.select("device_id").distinct().orderBy("device_id").collect()]
    points = [(ids[0], x) for x in (0, 47, 48, 95, 96, 100, 101, 829, 830)] + [(ids[1], 300), (ids[1], 300), (ids[2], 9_999)]
    got = Y.at_rows(days, spark.createDataFrame(points, "device_id string, row_i long"), 1800, *walk, lambda r: r)
    found = {(r.device_id, r.row_i): r for r in got.collect()}
    want = {(r.device_id, r.row_i): r for r in rows.collect() if (r.device_id, r.row_i) in points}
    assert set(found) == set(want) and len(found) == got.count() == 10
    for k, r in want.items():
        assert found[k].time_s == r.time_s and abs(found[k].time_h - r.time_h) < 1e-12 and found[k].block == r.block
        assert all(abs(found[k][f"_w_{c}"] - r[f"_w_{c}"]) < 1e-9 for c in walk[0])


def test_written_devices_are_packed_and_in_order(spark, tmp_path):
    """Rows come by device and row though the write doesn't sort them, in files with the tighter codec."""
    import pyarrow.parquet as pq

    manifest = sample_manifest(P.suppliers(spark, SF), "s_suppkey", "pump", 16.0)
    series = FL.build_pump(manifest, P.pump_inputs(spark, SF, 1800), 1800)
    FL.write_devices(series, f"file://{tmp_path}/devices")
    files = sorted((tmp_path / "devices").glob("*.parquet"))
    assert len(files) > 1
    n = 0
    for path in files:
        file = pq.ParquetFile(path)
        assert file.metadata.row_group(0).column(0).compression == "ZSTD"
        rows = file.read(["device_id", "row_i"]).to_pylist()
        keys = [(r["device_id"], r["row_i"]) for r in rows]
        assert keys == sorted(keys)
        n += len(rows)
    assert n == manifest.count() * (16 * 48 + 1)
