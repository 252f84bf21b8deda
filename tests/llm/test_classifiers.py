"""Toxicity, language and quality: held-out accuracy, odd rows, gradients."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from telemill.llm import language, quality, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def bucket(i, n):
    return i is not None and zlib.crc32(str(i).encode()) % n


def auc(scores, y):
    r = np.argsort(np.argsort(scores))
    y = np.asarray(y)
    return (r[y == 1].mean() - (y.sum() - 1) / 2) / (len(y) - y.sum())


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    assert all(r.held_out == (bucket(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out]
    assert auc([r.score for r in held], [r.toxic for r in held]) > 0.9
    clean = [r for r in held if not r.toxic]
    assert sum(r.predicted for r in clean) <= 0.1 * len(clean)
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in toxicity.score(docs, model).filter("predicted = 0").collect()}


def test_labels_of_held_out_rows_are_not_read(docs, labels):
    other = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, other)
    assert all((a.p[k] == b.p[k]).all() for k in a.p) and (a.scale, a.shift) == (b.scale, b.shift)


def test_windows_cover_and_find_a_word_anywhere():
    texts = ["plain words " * (1 + i % 30) + f"and number{i}" for i in range(60)] + ["plain words " * (i % 20) + "vile thing " + "plain words " * 9 for i in range(60)]
    model = toxicity.train(texts, [0] * 60 + [1] * 60)
    for before in (0, 1, 15, 31, 40, 500):
        text = "plain words " * before + "vile thing " + "plain words " * 60
        t = toxicity.Tokens(pa.array([text, "", None, "plain words"]))
        assert set(range(2 * before + 122)) == {k for b, n in zip(t.begin, t.length) if b < 2 * before + 122 for k in range(b, b + n) if k < 2 * before + 122}
        score = model.probability(model.documents(t))
        assert score[0] > 0.5 > score[3] and score[1] == score[2]


def test_gradients():
    model = toxicity.Model(np.sort(np.array([5, 9], np.uint64)), np.array([1.0, -1.0], np.float32))
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    t = toxicity.Tokens(pa.array(["a bb ccc a! bb", "dd e"]))
    model.vocabulary = np.sort(np.unique(t.hashes)[:2])
    y, w, chosen = np.array([1.0, 0.0]), np.array([1.0, 2.0]), np.arange(2)

    def loss():
        ids, x = model.inputs(t)
        logit = model.forward(model._project(x), t.begin, t.length)[0]
        return float((w * (np.log1p(np.exp(-np.abs(logit))) + np.maximum(logit, 0) - y * logit)).mean())

    ids, x = model.inputs(t)
    g, _ = model.gradients(t, ids, x, chosen, y, w)
    r = np.random.default_rng(0)
    for name, value in model.p.items():
        flat = np.flatnonzero(g[name])
        for k in r.choice(flat, min(4, len(flat)), replace=False):
            at = np.unravel_index(k, value.shape)
            kept, h = value[at], 2e-3
            value[at] = kept + h
            up = loss()
            value[at] = kept - h
            down = loss()
            value[at] = kept
            assert abs((up - down) / (2 * h) - g[name][at]) < 2e-3 + 0.05 * abs(g[name][at]), name


def test_language(docs, spark):
    got = language.identify(docs, language.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (bucket(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_ranks_by_hand():
    found = language.ranked("Aba ab")
    text = {"".join(chr((int(g) >> s) & 0x1FFFFF) or "_" for s in (42, 21, 0) if (int(g) >> s) & 0x1FFFFF) for g in found if g < 1 << 61}
    assert {"a", "b"} <= text and len(found) == len(set(found.tolist()))
    counts = {}
    for g in language.grams("Aba ab").tolist():
        counts[g] = counts.get(g, 0) + 1
    assert found.tolist() == sorted(counts, key=lambda g: (-counts[g], g))


def test_languages_against_a_plain_loop(docs):
    """Out-of-place distances and the choice, n-gram by n-gram, for every document."""
    profiles = language.fit(docs)
    place = [{int(g): int(r) for g, r in zip(profiles.grams, profiles.ranks[:, i], strict=True) if r < language.PROFILE} for i in range(len(profiles.langs))]
    got = {r.doc_id: r for r in language.identify(docs, profiles).collect()}
    for row in docs.collect():
        mine = language.ranked(row.text or "").tolist()
        if not mine:
            assert got[row.doc_id].lang_pred == "und"
            continue
        away = [sum(abs(own[g] - i) if g in own else language.PROFILE for i, g in enumerate(mine)) for own in place]
        best = min(range(len(away)), key=lambda i: (away[i], profiles.langs[i]))
        assert got[row.doc_id].lang_pred == profiles.langs[best] and got[row.doc_id].distance == away[best]


def test_quality_held_out(docs, labels):
    got = quality.score(docs, quality.fit(docs, labels)).join(labels.select("doc_id", "quality"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert auc([r.score for r in held], [r.quality for r in held]) > 0.9
    good = [r for r in held if r.quality]
    assert sum(r.predicted for r in good) >= 0.95 * len(good)


def test_views_teach_each_other():
    """With few labels, a view that is told the truth by the other gets better."""
    r = np.random.default_rng(3)
    y = r.integers(0, 2, 3000)
    a = np.hstack([(y * 2 - 1)[:, None] * 2 + r.normal(size=(3000, 1)), r.normal(size=(3000, 6))])
    b = np.hstack([(y * 2 - 1)[:, None] * 1.5 + r.normal(size=(3000, 1)), r.normal(size=(3000, 30))])
    few, rest = slice(0, 40), slice(40, 2000)
    model = quality.co_train([a[few], b[few]], y[few], quality.ArrayPool([a[rest], b[rest]]))
    alone = quality.logistic(b[few], y[few].astype(float), np.ones(40))
    test = slice(2000, 3000)
    right = lambda z: ((z > 0) == (y[test] == 1)).mean()
    assert right(model.page.logit(b[test])) > right(alone.logit(b[test]))
    assert ((model.score(a[test], b[test])[0] > 0.5) == (y[test] == 1)).mean() > 0.95


def test_pool_of_all_rows(spark, documents, docs, labels):
    """The surest rows of a table are those of all its rows, found by brute force; equal rows are one."""
    model = quality.fit(docs, labels)
    models = [model.text, model.page]
    frame = quality._ready(documents.unionByName(documents)).selectExpr("*", "cast(null as int) as y").mapInArrow(quality._features, "doc_id long, y int, x binary")
    x = np.array([np.frombuffer(r.x) for r in frame.collect()])
    plain = quality.ArrayPool([x[:, : quality.TEXT], x[:, quality.TEXT :]])
    for taken in (set(), {x[3].tobytes(), x[7].tobytes()}):
        got = quality.TablePool(frame.repartition(7)).surest(models, taken, 9)
        want = {k: v for k, v in plain.surest(models, taken, 9).items() if v}
        assert got == want and all(len({r for _, r in v}) == len(v) for v in got.values()) and got


def test_quality_scores_against_a_plain_loop(docs, labels):
    """Both views, calibration and combination, document by document."""
    model = quality.fit(docs, labels)
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}

    def logit(m, row):
        z = [min(8, max(-8, (v - mu) / sd)) for v, mu, sd in zip(row, m.mean, m.spread, strict=True)]
        return m.scale * (sum(a * b for a, b in zip(z, m.weight[:-1], strict=True)) + m.weight[-1]) + m.shift

    import math

    import pyarrow as pa

    for r in docs.limit(60).collect():
        a = quality.text_features(pa.array([r.text], pa.string()))[0].tolist()
        b = quality.page_features(pa.array([r.source], pa.string()), pa.array([r.lang], pa.string()), pa.array([float(r.n_chars)], pa.float64()))[0].tolist()
        own = [logit(model.text, a), logit(model.page, b)]
        assert abs(got[r.doc_id].text_score - 1 / (1 + math.exp(-own[0]))) < 1e-9
        assert abs(got[r.doc_id].page_score - 1 / (1 + math.exp(-own[1]))) < 1e-9
        assert abs(got[r.doc_id].score - 1 / (1 + math.exp(-logit(model.both, own)))) < 1e-9


def test_odd_rows(odd_documents, spark, docs, labels):
    marks = spark.createDataFrame([(3, 1, 0), (4, 0, 1), (None, 1, 1), (5, None, None), (4, 1, 0)], "doc_id long, quality int, toxic int")
    nothing = marks.limit(0)
    for lab in (marks, nothing):
        for op in (toxicity, quality):
            got = op.score(odd_documents, op.fit(odd_documents, lab)).collect()
            assert len(got) == 11 and all(0 <= r.score <= 1 for r in got)
            same = [r.score for r in got if r.doc_id == 4]
            assert max(same) - min(same) < 1e-6
            assert op.score(odd_documents.limit(0), op.fit(odd_documents.limit(0), lab)).count() == 0
    assert toxicity.keep_clean(odd_documents, toxicity.fit(odd_documents, nothing)).columns == odd_documents.columns
    for profiles in (language.fit(docs), language.fit(odd_documents), language.fit(docs.limit(0))):
        got = {r.doc_id: r for r in language.identify(odd_documents, profiles).collect()}
        assert len(got) == 10 and all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 6, 7, 9))
    assert language.identify(odd_documents.limit(0), language.fit(docs)).count() == 0
