"""Every stage against a brute-force version of its decision, and the whole run."""

import math
from collections import Counter

import corpus_pipeline
from telemill.llm import decontam, toxicity
from tests.llm.conftest import SF
from tests.llm.test_jaccard import brute as similar
from tests.llm.test_mixing import WORD, brute as mixed


def rows_of(frame):
    return sorted((r.doc_id, r.text) for r in frame.select("doc_id", "text").collect())


def test_toxic_documents_go(spark, documents):
    kept = corpus_pipeline.drop_toxic(spark, documents, SF)
    model = toxicity.fit(documents, spark.read.parquet(f"{SF}/labels.parquet"))
    clean = {r.doc_id for r in toxicity.score(documents, model).filter("predicted = 0").collect()}
    assert {i for i, _ in rows_of(kept)} == clean and kept.columns == documents.columns


def test_one_document_of_each_group(spark, documents, odd_documents):
    for docs in (documents, odd_documents):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        stay = {i for i, _, c in similar(rows) if i is not None and i == c}
        kept = corpus_pipeline.one_of_each_group(spark, docs, SF)
        got = [r.doc_id for r in kept.collect()]
        assert sorted(i for i in got if i is not None) == sorted(stay)
        assert got.count(None) == sum(i is None for i, _ in rows) and kept.columns == docs.columns


def test_rows_of_one_id_are_texts_of_their_own(spark):
    """Different texts under one id stay, unless another row has a similar one; equal rows leave one."""
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    rows = [(7, a, "x"), (7, b, "y"), (3, a, "z"), (9, b, "z"), (8, "alone", "z"), (7, "also alone", "z"), (7, None, "z"), (7, "", "z"), (7, "", "z"), (5, "twice the same text in one id", "p"), (5, "twice the same text in one id", "q"), (None, a, "n"), (None, a, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _hash0 string")
    kept = corpus_pipeline.one_of_each_group(spark, docs, SF)
    got = [(r.doc_id, r.text) for r in kept.collect()]
    want = [(3, a), (7, b), (8, "alone"), (7, "also alone"), (7, None), (7, ""), (7, ""), (5, rows[9][1]), (None, a), (None, a)]
    assert sorted(got, key=str) == sorted(want, key=str) and kept.columns == docs.columns


def test_benchmark_items_go(spark, documents):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    held = {r.doc_id for r in decontam.find_items(documents, bench).collect()}
    kept = corpus_pipeline.drop_benchmark_items(spark, documents, SF)
    assert {i for i, _ in rows_of(kept)} == {i for i, _ in rows_of(documents)} - held and held


def test_documents_come_as_often_as_the_mix_takes_them(spark, documents):
    good = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    weights = {r.doc_id: {None: 0.5, 0: 0.25}.get(good.get(r.doc_id), 1.0) for r in documents.collect()}
    rows = [(r.doc_id, len(WORD.findall(r.text)), r.source) for r in documents.collect()]
    taken, aims = mixed(rows, weights)
    size = Counter()
    for _, n, s in rows:
        size[s] += n
    want = Counter()
    for i, n, s, t in taken:
        epochs = int(aims[s] // size[s])
        want[i] = epochs + math.floor((t - epochs * n) / n + 0.5)
    kept = corpus_pipeline.mix_sources(spark, documents, SF)
    assert Counter(i for i, _ in rows_of(kept)) == +want and kept.columns == documents.columns


def test_odd_rows_in_every_stage(spark, odd_documents):
    for docs in (odd_documents, odd_documents.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, SF)
            assert kept.columns == docs.columns and kept.count() <= 3 * docs.count()
        assert corpus_pipeline.to_shards(spark, docs, SF).count() == docs.count()


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    load = Counter()
    for r in out.collect():
        load[r.shard] += r.size
    assert len(load) == corpus_pipeline.SHARDS
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity"
