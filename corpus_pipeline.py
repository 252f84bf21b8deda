"""From raw documents to shards of a training mix.

Each stage takes what the one before it kept, decides on whole texts, and hands on
the rows that stay, with the columns of ``documents``. The last one hands on doc_id and
text and names a shard for every row.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from telemill.llm import decontam, jaccard, mixing, sharding, toxicity  # noqa: E402
from telemill.llm.tables import ship_package  # noqa: E402
from telemill.session import keep, materialize, new_path, release, scratch  # noqa: E402

SHARDS = 16
#: No SQL states a trained network.
ORACLE_SQL = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the network, trained on labels of this input, doesn't reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def free_name(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't use."""
    return next(n for n in (f"{name}{i}" for i in range(len(docs.columns) + 1)) if n not in docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of rows that similarity of their texts connects, one row.

    It is the one with the smallest doc_id, and of several with that id and different texts the
    one of the smallest text hash. Rows that are equal in id and text are one group,
    of which one row stays. Rows without id are in no group and stay, as do texts
    without words. Different texts of one id that nothing connects all stay.
    """
    stays = jaccard.similar_rows(docs)
    mark = free_name(docs, "_hash")
    named = docs.withColumn(mark, jaccard.text_hash())

    def chosen(some: str) -> DataFrame:
        own = stays.filter(some).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_text"))
        return named.join(own, (named["doc_id"] == F.col("_id")) & (named[mark] == F.col("_text")), "left_semi")

    whole = F.struct(*docs.columns)
    again = (
        chosen("copies > 1").groupBy("doc_id", mark)
        .agg(F.min_by(whole, F.xxhash64(whole)).alias("_row")).select("_row.*")
    )
    return chosen("copies = 1").select(docs.columns).unionByName(again).unionByName(docs.filter("doc_id is null"))


def drop_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark, with its own or with other values."""
    return decontam.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it: once per complete epoch, once more if selected.

    Documents stay whole here; the one in which a source's budget ends is selected if
    at least half of it is in. Rows that share doc_id, source and size come equally
    often, the mean rounded up.
    """
    taken = mixing.mix_documents(docs, table(spark, sf_dir, "labels"), named=True)
    part = F.when(F.col("size") > 0, (F.col("taken") - F.col("epochs") * F.col("size")) / F.col("size")).otherwise(0.0)
    copies = (
        taken.select(
            F.coalesce(F.col("doc_id").cast("string"), "name").alias("_id"), F.col("source").alias("_source"),
            F.col("size").alias("_size"), (F.col("epochs") + F.round(part)).alias("_n"),
        )
        .groupBy("_id", "_source", "_size")
        .agg(F.ceil(F.avg("_n")).cast("int").alias("_copies"))
        .filter("_copies > 0")
    )
    own = docs.select(
        F.struct(*docs.columns).alias("_row"), F.coalesce(F.col("doc_id").cast("string"), mixing.text_name()).alias("_who"),
        "source", mixing.word_count(F.col("text")).alias("_words"),
    )
    same = (F.col("_who") == F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("_words") == F.col("_size"))
    rows = own.join(copies, same).select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_turn"))
    return rows.select("_row.*")


def to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, text, size, virtual_slot, map_version and shard of every row; the map is stored."""
    ship_package(spark)
    slot_map, _ = sharding.balanced_map(docs, SHARDS, path=new_path(spark, "slot-map"))
    return sharding.assign(docs, slot_map)


STAGES = [
    ("toxicity", drop_toxic),
    ("shingle_jaccard", one_of_each_group),
    ("decontamination", drop_benchmark_items),
    ("mixing", mix_sources),
    ("sharding", to_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; a stage's tables go when its result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            kept = keep(materialize(stage(spark, docs, sf_dir), f"stage-{name}"))
        release(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
