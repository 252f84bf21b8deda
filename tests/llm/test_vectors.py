import numpy as np

from telemill.llm import vectors


def brute(rows, least=0.9):
    """{row: (vec_id, n_links, component)} by all pairs, and the links."""
    unit = []
    for _, v in rows:
        x = np.array([np.nan if y is None else y for y in v], float) if v is not None else np.zeros(0)
        ok = len(x) and np.isfinite(x).all() and x.any()
        unit.append(x / np.linalg.norm(x) if ok else None)
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    links = set()
    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if a is None or b is None or unit[i] is None or unit[j] is None or len(unit[i]) != len(unit[j]):
                continue
            if unit[i] @ unit[j] >= least:
                links.add((j, i))
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    n = [sum(i in link for link in links) for i in range(len(rows))]
    return [(r[0], n[i], None if r[0] is None else root(r[0])) for i, r in enumerate(rows)]


def run(spark, rows, **more):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vectors.near_vectors(frame, **more).collect()
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)
    return sorted([(r.vec_id, r.n_links, r.component_id) for r in got], key=str)


def test_recall_and_no_false_links(spark):
    """Small leaves, so that trees have several levels; links found are nearly all and all right."""
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in e.orderBy("vec_id").collect()]
    r = np.random.default_rng(4)
    for i in range(200):  # the table has no links of its own
        v = np.array(rows[i % 60][1])
        rows.append((10_000 + i, (v + r.normal(size=len(v)) * 0.25 * np.linalg.norm(v) / 8).tolist()))
    want = {w[0]: w for w in brute(rows)}
    got = run(spark, rows, leaf=40)
    assert sum(g[1] for g in got) >= 0.9 * sum(w[1] for w in want.values()) > 0
    assert all(g[1] <= want[g[0]][1] and g[2] >= want[g[0]][2] for g in got)
    exact = sorted(want.values(), key=str)
    assert run(spark, rows) == exact  # one leaf holds all


def test_large_group_of_near_copies(spark):
    r = np.random.default_rng(2)
    centre = r.normal(size=16)
    rows = [(i, (centre + 0.12 * r.normal(size=16)).tolist()) for i in range(300)]
    rows += [(300 + i, r.normal(size=16).tolist()) for i in range(300)]
    want, got = brute(rows), run(spark, rows, leaf=80, trees=16)
    assert sum(g[1] for g in got) >= 0.9 * sum(w[1] for w in want)
    assert sum(g[2] != w[2] for g, w in zip(got, sorted(want, key=str))) <= 3


def exact(rows, least=0.9):
    """Like ``brute`` for rows with distinct ids and usable vectors, by matrices."""
    out = []
    for n in {len(v) for _, v in rows}:
        ids = np.array([i for i, v in rows if len(v) == n])
        x = np.array([v for _, v in rows if len(v) == n])
        x /= np.linalg.norm(x, axis=1)[:, None]
        near = x @ x.T >= least
        root, before = ids.copy(), None
        while before is None or (root != before).any():
            before, root = root, np.where(near, root[None, :], ids.max()).min(axis=1)
        out += list(zip(ids.tolist(), (near.sum(axis=1) - 1).tolist(), root.tolist(), strict=True))
    return sorted(out, key=str)


def test_groups_of_many_leaves(spark, monkeypatch):
    """Groups of 10 and 50 leaves, at the registered number of trees, lose no link."""
    monkeypatch.setattr(vectors, "BLOCK", 150, raising=False)
    r = np.random.default_rng(7)
    rows, leaf = [], 20
    for size, spread in ((10 * leaf, 0.25), (50 * leaf, 0.25), (5 * leaf, 0.02)):  # the last within half the angle
        centre = r.normal(size=64)
        rows += [c.tolist() for c in centre + spread * r.normal(size=(size, 64))]
        rows += [rows[-1]] * 3 + [(2 * np.array(rows[-2])).tolist()]
    rows += r.normal(size=(2 * len(rows), 64)).tolist()
    rows += [[1.0, 0.1 * i] for i in range(5)]  # a length that few vectors have
    rows = list(enumerate(rows))
    assert run(spark, rows, leaf=leaf, trees=vectors.TREES) == exact(rows)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
        (7, [1.0, 2.0]), (8, [1.0, 2.0]), (9, [2.0, 4.0]), (8, [1.0, 2.1]), (None, [1.0, 2.0]), (10, [1.0, 2.0, 0.0]),
        (11, [-1.0, -2.0]), (12, [1e308, 1e308]), (13, [1e-320, 1e-320]), (14, [-0.0, 5.0]), (15, [0.0, 1.0]),
    ]
    assert run(spark, rows) == sorted(brute([(i, v if i not in (12, 13) else [1.0, 1.0]) for i, v in rows]), key=str)
    assert run(spark, [(1, None)]) == [(1, 0, 1)]
    frame = spark.createDataFrame([], "vec_id long, embedding array<double>, rep string, node string")
    assert vectors.near_vectors(frame).count() == 0


def pairs_at(r, n, cosine, size=64):
    """Random unit vectors, each with a partner at about this cosine."""
    a = r.normal(size=(n, size))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = r.normal(size=(n, size))
    b -= (b * a).sum(axis=1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    return a, cosine * a + np.sqrt(1 - cosine**2) * b


def test_trees_grow_with_depth():
    assert vectors.trees_for(10) == vectors.trees_for(4_000_000) == 8 and vectors.trees_for(10**9) == 18
    r = np.random.default_rng(5)
    a, b = pairs_at(r, 20_000, 0.9)
    both = np.concatenate([a, b])
    kept = []
    for _ in range(5):
        tree = vectors._grow(both, len(both), len(both) // 2, r, 1)
        parts = [set(rows.tolist()) for _, rows in vectors._route(tree, both)]
        kept.append(np.mean([any(i in p and i + 20_000 in p for p in parts) for i in range(20_000)]))
    assert vectors.KEPT <= np.mean(kept) < vectors.KEPT + 0.03


def test_recall_of_pairs_in_deep_trees(spark):
    """Pairs in isotropic data at the limit itself, eight levels deep, with the trees that the query would take."""
    r = np.random.default_rng(6)
    a, b = pairs_at(r, 1_500, 0.905)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, b]))]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), leaf=20).collect()
    found = sum(x.component_id == x.vec_id - 1_500 for x in got if x.vec_id >= 1_500)
    assert found >= 0.95 * 1_500 and sum(x.n_links for x in got) <= 2 * 1_500
