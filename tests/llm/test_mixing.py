import hashlib
import math
import re
from collections import defaultdict

from telemill.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Water filling by rounds: share what is left by weight until nobody is above their limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    fixed, rest = {}, float(sum(sizes.values()))
    open_ = set(order)
    while open_:
        level = rest / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not over:
            return fixed | {s: level * weight[s] for s in open_}
        for s in over:
            fixed[s] = 3.0 * sizes[s]
            rest -= fixed[s]
        open_ -= over
    return fixed


def brute(rows, weights=None):
    """rows: (doc_id, size, source). {doc_id: taken} and {source: target}."""
    sizes = defaultdict(int)
    for _, n, s in rows:
        sizes[s] += n
    want, taken = targets(sizes), []
    for s, total in sizes.items():
        epochs = int(want[s] // total) if total else 0
        left = round(want[s] - epochs * total)
        own = []
        for i, n, _ in (r for r in rows if r[2] == s):
            u = (int(hashlib.md5(f"mix|{'' if i is None else i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            own.append((-math.log(u) / (weights or {}).get(i, 1.0), -1 if i is None else i, n, i))
        for _, _, n, i in sorted(own, key=lambda x: x[:3]):
            part = max(0, min(n, left))
            left -= part
            taken.append((i, n, s, epochs * n + part))
    return sorted(taken, key=str), want


def run(frame):
    got = mixing.mix(frame).collect()
    return sorted([(r.doc_id, r.size, r.source, r.taken) for r in got], key=str), {r.source: r.target for r in got}, got


def test_against_brute_force(spark, monkeypatch):
    import random

    monkeypatch.setattr(mixing, "BIN_ROWS", 7)
    rnd = random.Random(1)
    rows = [(i, rnd.choice((0, 1, 5, 200)), rnd.choice(["a", "a", "a", "b", "Z", "é", None, ""])) for i in range(400)]
    rows += [(900, 5000, "big"), (901, 1, "tiny")]
    weights = {i: rnd.choice((0.25, 0.5, 1.0)) for i, _, _ in rows}
    frame = spark.createDataFrame([(*r, weights[r[0]], "x") for r in rows], "doc_id long, size long, source string, weight double, target string")
    got, target, full = run(frame)
    want, aims = brute(rows, weights)
    assert got == want
    assert all(abs(target[s] - aims[s]) < 1e-6 for s in aims)
    for s in aims:
        assert abs(sum(r.taken for r in full if r.source == s) - aims[s]) <= 1
    assert all(r.taken <= 3 * r.size for r in full)
    assert run(frame.repartition(5))[0] == got


def test_odd_rows(spark, odd_documents):
    got = mixing.mix_documents(odd_documents).collect()
    rows = [(r.doc_id, len(WORD.findall(r.text or "")), r.source) for r in odd_documents.collect()]
    assert sorted([(r.doc_id, r.size, r.source) for r in got], key=str) == sorted(rows, key=str)
    assert abs(sum(r.taken for r in got) - sum(r[1] for r in rows)) <= 4
    assert mixing.mix_documents(odd_documents.limit(0)).count() == 0
    empty = spark.createDataFrame([(1, 0, None, float("nan")), (2, 0, "a", None)], "doc_id long, size long, source string, weight double")
    assert [r.taken for r in mixing.mix(empty).collect()] == [0, 0]


def test_good_documents_come_first(spark):
    rows = [(i, 10, "a", 1.0 if i % 2 else 0.05) for i in range(400)] + [(1000 + i, 10, "b", 1.0) for i in range(200)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, size long, source string, weight double")).collect()
    good = sum(r.taken for r in got if r.source == "a" and r.doc_id % 2)
    assert good > 0.8 * sum(r.taken for r in got if r.source == "a")


def test_no_bin_is_large(spark, monkeypatch):
    """Whatever the weights, and without ids: bins stay near their bound, and no weight piles up."""
    import pytest
    from pyspark.sql import functions as F

    monkeypatch.setattr(mixing, "BIN_ROWS", 500)
    bins = []

    def watched(df, name):
        if name == "mixed":
            bins.append(df._jdf.queryExecution().toString().count("_bin"))
        return real(df, name)

    real = mixing.materialize
    monkeypatch.setattr(mixing, "materialize", watched)
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 10 > 0, F.col("id")).alias("doc_id"), F.lit(3).alias("size"), F.lit("a").alias("source"),
        F.element_at(F.array(F.lit(1.0), F.lit(0.5), F.lit(0.25), F.lit(40.0)), (F.col("id") % 4 + 1).cast("int")).alias("weight"),
        F.concat(F.lit("text "), F.col("id").cast("string")).alias("name"),
    )
    keys = rows.select("weight", mixing.key(F.coalesce(F.col("doc_id").cast("string"), "name"), F.col("weight")).alias("k"))
    width = math.ceil(60_000 * mixing.DENSEST / 500)
    for some in (keys, keys.filter("weight = 1"), keys.filter("weight = 0.5"), keys.filter("weight = 0.25")):
        n = some.count()
        own = math.ceil(n * mixing.DENSEST / 500) if n < 60_000 else width
        largest = some.groupBy(F.floor(F.log2("k") * own)).count().agg(F.max("count")).first()[0]
        assert largest <= 1.3 * 500
    got = mixing.mix(rows)
    assert got.count() == 60_000 and got.agg(F.sum("taken")).first()[0] == pytest.approx(180_000, abs=1) and bins
