"""Codes against plain k-means over all entries."""

import hashlib
import math

import numpy as np
import pytest

from telemill.llm import codes

ROWS = "vec_id long, embedding array<double>, label string"


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * float(x)) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    seeds = sorted((i, v) for i, v, _ in kept if i is not None)[:entries]
    w = len(kept[0][1]) // parts
    books = [[v[p * w : (p + 1) * w] for _, v in seeds] for p in range(parts)]

    def assign():
        out = []
        for _, v, _ in kept:
            own = []
            for p in range(parts):
                x = v[p * w : (p + 1) * w]
                own.append(min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(books[p])))
            out.append(own)
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(seeds)):
                own = [v[p * w : (p + 1) * w] for (_, v, _), f in zip(kept, found, strict=True) if f[p][1] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = assign()
    errors = [sum(d for d, _ in f) for f in found]
    by = {}
    for (_, _, lab), e in zip(kept, errors, strict=True):
        by[lab] = by.get(lab, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [(i, "".join(f"{e:02x}" for _, e in f), n, by[lab], digest) for (i, _, lab), f, n in zip(kept, found, errors, strict=True)]


def run(spark, rows, schema=ROWS, **settings):
    return ordered(tuple(r) for r in codes.vector_codes(spark.createDataFrame(rows, schema), **settings).collect())


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_embeddings(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in frame.collect()]
    got = ordered(tuple(r) for r in codes.vector_codes(frame).collect())
    assert got == ordered(brute(rows)) and len(got) == len(rows)


@pytest.mark.parametrize("seed", range(4))
def test_clustered_and_equal_vectors(spark, seed):
    """Tight groups, ties, equal entries and entries without members."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, 16))
    x = centres[rng.integers(0, 5, 300)] + rng.normal(size=(300, 16)) * [0.01, 0.3, 0.0, 2.0][seed]
    x = np.round(x, 1) if seed % 2 else x
    rows = [(int(i) if i % 50 else None, v.tolist(), ["a", "b", None][i % 3] if i % 2 else "hot") for i, v in enumerate(x)]
    assert run(spark, rows, block=37) == ordered(brute(rows))


def test_nearest_is_exact():
    rng = np.random.default_rng(9)
    for _ in range(300):
        n, k, w = rng.integers(1, 60), rng.integers(1, 17), rng.integers(1, 5)
        top = int(rng.choice([2, 10, 10_000, codes.LARGEST - 1]))
        x, book = rng.integers(-top, top, (n, w)), rng.integers(-top, top, (k, w))
        d = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
        assert (codes.nearest(x, book, rng.integers(0, k, n).astype(np.uint8)) == d.argmin(axis=1)).all()


def test_stable_core_skips_distances(monkeypatch):
    """Members of tight balls are compared with their own entry only."""
    rng = np.random.default_rng(3)
    book = rng.integers(-1_000_000, 1_000_000, (16, 8))
    own = rng.integers(0, 16, 5_000).astype(np.uint8)
    x = book[own] + rng.integers(-50, 50, (5_000, 8))
    asked = []
    real = np.take_along_axis
    monkeypatch.setattr(codes.np, "flatnonzero", lambda m: asked.append(int(np.asarray(m).sum())) or np.nonzero(m)[0])
    assert (codes.nearest(x, book, own) == own).all() and asked == [0] and real is np.take_along_axis


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [i / 7, -i / 3, 0.1 * i, 0.0, 1.0, -0.00001, 2.5, i % 4.0], None if i % 2 else "b") for i in range(20)]
    bad = [(100, None, "b"), (101, [1.0] * 7 + [nan], "b"), (102, [inf] + [0.0] * 7, None), (103, [None] + [1.0] * 7, "b")]
    more = [(5, rows[5][1], "c"), (5, rows[5][1], "c"), (None, rows[3][1], None)]
    want = ordered(brute(rows + more))
    assert run(spark, rows + bad + more) == want
    # rows of other lengths, empty ones included, stay without a code
    odd = [(200, [1.0] * 16, "b"), (201, [], "b"), (202, [1.0], "z")]
    got = run(spark, rows + more + odd)
    assert [r for r in got if r[0] is None or r[0] < 200] == want
    assert {r[0]: r[1:3] for r in got if r[0] and r[0] >= 200} == {i: (None, None) for i in (200, 201, 202)}
    assert run(spark, bad) == [] and run(spark, []) == []
    # fewer vectors than entries, floats, no label, clashing columns
    few = spark.createDataFrame([(i, r[1], "x", "y") for i, r in enumerate(rows[:3])], "vec_id long, embedding array<float>, code string, x string")
    out = codes.vector_codes(few).collect()
    assert [r.code for r in sorted(out, key=lambda r: r.vec_id)] == ["00" * 8, *(r[1] for r in ordered(brute([(i, np.float32(r[1]).tolist(), None) for i, r in enumerate(rows[:3])]))[1:])]
    with pytest.raises(Exception, match="components must be below"):
        run(spark, [(1, [1e30] * 8, "a")])
