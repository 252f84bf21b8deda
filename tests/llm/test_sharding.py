import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from telemill.llm import sharding


def brute(rows, slot_of, shard_of):
    return sorted(
        [(i, len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode()), slot_of[i, t], shard_of[slot_of[i, t]]) for i, t in rows], key=str
    )


def check(docs, shards, slots, path=None):
    got = sharding.shard_documents(docs, shards, slots, path).collect()
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    slot_of = {(r.doc_id, r.text): r.v for r in docs.select("doc_id", "text", sharding.record_slot(slots).alias("v")).collect()}
    shard_of = {r.virtual_slot: r.shard for r in got}
    assert sorted([tuple(r)[:4] + (r.shard,) for r in got], key=str) == brute(rows, slot_of, shard_of)
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    return got


def test_even_bytes_and_gapless_slots(documents, spark, tmp_path):
    got = check(documents, 4, 512, str(tmp_path / "map"))
    load = Counter()
    for r in got:
        load[r.shard] += r.size
    assert max(load.values()) - min(load.values()) <= 0.001 * sum(load.values())
    path = str(tmp_path / "map")
    old = sharding.read_map(spark, path, 0)
    new = sharding.read_map(spark, path)
    assert old.count() == new.count() == 512 and new.first()["version"] == 1


def test_many_rows_of_a_slot(documents, monkeypatch):
    monkeypatch.setattr(sharding, "NUMBERED", 10)
    check(documents, 3, 5)


def test_versions_move_few_slots(documents, spark, tmp_path):
    path = str(tmp_path / "map")
    sharding.balanced_map(documents, 4, 256, path)
    more = documents.unionByName(documents.withColumn("doc_id", F.col("doc_id") + 100_000).filter("doc_id % 3 = 0"))
    sharding.balanced_map(more, 4, 256, path)
    a, b = (sharding.read_map(spark, path, v) for v in (1, 2))
    moves = sharding.moved(a, b).count()
    assert 0 < moves < 128
    sharding.balanced_map(more, 5, 256, path)  # one more shard takes its share
    grown = sharding.read_map(spark, path)
    assert grown.select("version").distinct().first()[0] == 3
    load = [r["s"] for r in grown.groupBy("shard").agg(F.sum("slot_bytes").alias("s")).collect()]
    assert len(load) == 5 and max(load) <= 1.05 * min(load)
    sharding.balanced_map(more, 3, 256, path)  # slots of shards that go find a new one
    assert {r.shard for r in sharding.read_map(spark, path).collect()} == {0, 1, 2}


def test_assign_agrees(documents):
    slot_map, _ = sharding.balanced_map(documents, 4, 64)
    a = {r.doc_id: r.shard for r in sharding.assign(documents, slot_map, 64).collect()}
    assert a == {r.doc_id: r.shard for r in sharding.shard_documents(documents, 4, 64).collect()}


def test_odd_rows(odd_documents):
    check(odd_documents, 3, 16)
    assert sharding.shard_documents(odd_documents.limit(0), 3, 16).count() == 0


@pytest.mark.parametrize("shards", (1, 7))
def test_few_rows(spark, shards):
    docs = spark.createDataFrame([(1, "a")] * 3, "doc_id long, text string")
    assert len(check(docs, shards, 8)) == 3
