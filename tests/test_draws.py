import numpy as np
import math

from pyspark.sql import functions as F

from telemill.functions.draws import Draws

N = 20000


def stats(spark, col):
    row = (
        spark.range(N)
        .select(col.alias("v"))
        .agg(F.avg("v"), F.stddev("v"), F.min("v"), F.max("v"))
        .first()
    )
    return tuple(row)


def test_moments_and_bounds(spark):
    for method in ("md5", "xxhash64"):
        d = Draws(3, method)
        mean, sd, lo, hi = stats(spark, d.uniform(["id"], "a", 2.0, 6.0))
        assert 2 <= lo and hi < 6
        assert abs(mean - 4) < 4 * (4 / math.sqrt(12)) / math.sqrt(N)
        mean, sd, *_ = stats(spark, d.normal(["id"], "b", 1.0, 2.0))
        assert abs(mean - 1) < 4 * 2 / math.sqrt(N) and abs(sd - 2) < 0.06
        mean, sd, lo, hi = stats(spark, d.exponential(["id"], "c", 2.0, 0.0, 8.0))
        assert lo >= 0 and hi == 8.0
        assert abs(mean - 2 * (1 - math.exp(-4))) < 0.06
        mean, _, lo, hi = stats(spark, d.lognormal(["id"], "d", 0.0, 0.4, 0.3, 3.0))
        assert 0.3 <= lo and hi <= 3.0 and abs(mean - math.exp(0.08)) < 0.03
        mean, _, lo, hi = stats(spark, d.randint(["id"], "e", 1, 5))
        assert (lo, hi) == (1, 4) and abs(mean - 2.5) < 0.05
        mean, sd, *_ = stats(spark, d.poisson(F.lit(3.0), ["id"], "f"))
        assert abs(mean - 3) < 0.06 and abs(sd * sd - 3) < 0.15


def test_streams_are_independent(spark):
    for method in ("md5", "xxhash64"):
        d = Draws(3, method)
        pair = spark.range(N).select(
            d.normal(["id"], "a").alias("a"), d.normal(["id"], "b").alias("b")
        )
        assert abs(pair.agg(F.corr("a", "b")).first()[0]) < 4 / math.sqrt(N)


def test_draws_do_not_depend_on_partitioning(spark):
    d = Draws("seed", "xxhash64")
    cols = ["id", d.normal(["id"], "a").alias("v"), d.poisson(F.lit(2.0), ["id"], "b").alias("n")]
    base = spark.range(500).withColumn("seed", F.col("id") + 7)
    want = base.repartition(1).select(*cols).orderBy("id").collect()
    for n in (4, 32):
        assert base.repartition(n).select(*cols).orderBy("id").collect() == want


def test_subset_has_no_repeats(spark):
    opts = F.array(*[F.lit(x) for x in "abcdef"])
    d = Draws(1)
    picked = spark.range(300).select(d.subset(opts, F.lit(4), ["id"], "s").alias("s"))
    rows = [r.s for r in picked.collect()]
    assert all(len(set(s)) == 4 for s in rows)
    assert {x for s in rows for x in s} == set("abcdef")


def test_fixed_text_rounds_the_exact_value(spark):
    from telemill.functions.derive import fixed_text

    rnd = np.random.default_rng(1)
    x = [k / 20 for k in range(-200, 4000)] + [k / 4 for k in range(100)] + rnd.normal(0, 50, 500).tolist()
    x += [2.45, 0.15, 0.35, 2.5, 3.5, 0.5, 1.5, 0.25, 0.75, 9.95, 99.95, 1e-9, 123456789.05, 0.05, 1e11 + 0.25]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    for digits in (0, 1, 2, 3):
        got = [r.t for r in df.select(fixed_text(F.col("x"), digits).alias("t")).collect()]
        assert got == [f"{v:.{digits}f}" for v in x]


def test_md5_draws_are_cut_as_bytes(spark):
    """The hash is read as md5 spells it, whatever the session shows binary values as."""
    import hashlib

    style = "spark.sql.binaryOutputStyle"
    spark.conf.set(style, "HEX")
    try:
        df = spark.range(50).select("id", Draws(3).uniform(["id"], "a").alias("u"), Draws(3).standard_normal(["id"], "b").alias("n"))
        rows = df.collect()
    finally:
        spark.conf.unset(style)
    assert "substring(cast(md5(" in df._jdf.queryExecution().executedPlan().toString()

    def digits(i, stream, at):
        return int(hashlib.md5(f"3|{i}|{stream}".encode()).hexdigest()[at : at + 13], 16) / 2**52

    for r in rows:
        assert r.u == digits(r.id, "a", 0)
        want = math.sqrt(-2 * math.log(1 - digits(r.id, "b", 0))) * math.cos(2 * math.pi * digits(r.id, "b", 13))
        assert abs(r.n - want) < 1e-12
