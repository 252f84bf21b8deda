"""Mix sources to target weights by weighted sampling without replacement.

Every row gets an exponential key ``-ln(u) / weight`` (Efraimidis and Spirakis), so
that ascending keys list a source in the order in which a weighted draw without
replacement would take its rows. A source's budget is spent on complete epochs
first; what is left of it goes down the list until it is used up.

Only DataFrame functions are used. A source is never sorted in one task: the logarithms of
the keys are cut into equal bins, bins are summed, and rows are sorted inside their
bin. The logarithm of an exponential variable has the same law for every weight, only
shifted, and a density of at most ``ln(2) / e`` to base 2. So whatever weights a source mixes,
no bin is expected to hold more than its width times that.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import keep, materialize, scratch
from .tables import WORD

#: Expected number of rows in the largest bin of keys, and the density that bounds it.
BIN_ROWS, DENSEST = 20_000, math.log(2) / math.e


def word_count(text):
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def key(doc_id, weight, seed: str = "mix"):
    """Exponential key of a row by its id: small keys come first. From md5, so any engine can repeat it."""
    text = F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("")))
    u = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double")
    return -F.log((u + F.lit(0.5)) / F.lit(4503599627370496.0)) / weight


def source_targets(sizes: DataFrame, weights=(1, 2, 3), most: float = 3.0) -> DataFrame:
    """``target`` of every source from ``source, source_size``.

    Sources in code point order (null last) weigh ``weights`` in turn and share the
    sum of all sizes. A target stops at ``most`` times the source's size; what it
    leaves is shared again by weight. Ordered by size / weight, the sources that
    stop are the first ones, so running sums give the one level at which the rest
    end. One row per source is handled here, never one per document.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    at = (F.row_number().over(by_name) - 1) % len(weights) + 1
    rated = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), at)).withColumn(
        "cap", F.lit(most) * F.col("source_size")
    )
    up = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    so_far = up.rowsBetween(W.unboundedPreceding, -1)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    stepped = rated.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum("cap").over(so_far), F.lit(0.0)).alias("stopped"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(so_far), F.lit(0))).alias("left"),
    ).withColumn("level", (F.col("total") - F.col("stopped")) / F.col("left"))
    # the level of the first source that doesn't stop holds for it and all behind it
    open_ = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    level = F.first(open_, ignorenulls=True).over(up.rowsBetween(W.unboundedPreceding, 0))
    return stepped.select(
        "source", "source_size", F.coalesce(level * F.col("weight"), F.col("cap")).alias("target")
    )


def mix(rows: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """How many words of every row the mix takes.

    ``rows``: ``doc_id, size, source`` and optionally ``weight`` (quality; null, NaN
    or not positive counts as 1) and ``name`` (a text that stands for a null id, and is
    handed on). ``targets``: ``source, source_size, target``; by
    default those of ``source_targets``. Returns doc_id, size, source, source_size,
    target, epochs (complete passes), taken. The row in which a budget ends gives
    its first words only, so ``taken`` adds up to the target of its source, rounded
    to a word. Equal keys (repeated ids) are ordered by size; rows that are the same
    in both may change places. No rows give no rows; a null source is a source. The
    result is stored.
    """
    with scratch(rows.sparkSession):
        return keep(materialize(_mixed(rows, targets), "mixed"))


def _mixed(rows: DataFrame, targets: DataFrame | None) -> DataFrame:
    w = F.col("weight").cast("double") if "weight" in rows.columns else F.lit(1.0)
    w = F.when(w > 0, F.when(F.isnan(w), 1.0).otherwise(w)).otherwise(1.0)
    named = ["name"] if "name" in rows.columns else []
    who = F.coalesce(F.col("doc_id").cast("string"), *map(F.col, named))
    keyed = materialize(
        rows.select(
            "doc_id", F.col("size").cast("long").alias("size"), "source", *named, key(who, w).alias("_key"),
        ),
        "mix-keys",
    )
    if targets is None:
        sums = keyed.groupBy("source").agg(F.sum("size").alias("source_size"))
        targets = source_targets(sums)
    counts = keyed.groupBy(F.col("source").alias("_source")).agg(F.count(F.lit(1)).alias("_rows"))
    plan = targets.join(counts, targets["source"].eqNullSafe(counts["_source"]), "left").select(
        F.col("source").alias("_source"),
        "source_size",
        "target",
        F.ceil(F.coalesce("_rows", F.lit(1)) * F.lit(DENSEST) / F.lit(BIN_ROWS)).alias("_bins"),
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0).cast("long").alias("epochs"),
    ).withColumn("_rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    # a row per source; stored, so that its size decides whether it is broadcast
    plan = materialize(plan, "mix-plan")
    binned = keyed.join(plan, keyed["source"].eqNullSafe(plan["_source"])).drop("_source").withColumn(
        "_bin", F.floor(F.log2("_key") * F.col("_bins")).cast("long")
    )
    below = W.partitionBy("source").orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    starts = binned.groupBy("source", "_bin").agg(F.sum("size").alias("_n")).select(
        F.col("source").alias("_s"), F.col("_bin").alias("_b"),
        F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_start"),
    )
    inside = W.partitionBy("source", "_bin").orderBy("_key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = binned.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = placed.join(starts, placed["source"].eqNullSafe(starts["_s"]) & (placed["_bin"] == starts["_b"]))
    part = F.least(F.col("size"), F.greatest(F.lit(0), F.col("_rest") - F.col("_start") - F.col("_before")))
    return joined.select(
        "doc_id", "size", "source", "source_size", "target", "epochs", *named,
        (F.col("epochs") * F.col("size") + part).alias("taken"),
    )


def text_name(text: str = "text"):
    """What stands for the id of a row that has none."""
    return F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def mix_documents(docs: DataFrame, labels: DataFrame | None = None, named: bool = False) -> DataFrame:
    """``mix`` over documents (doc_id, text, source), sized in words.

    Quality weights come from ``labels`` (doc_id, quality): 1 for good, 0.25 for bad
    and 0.5 for unlabelled documents. Null texts have size 0. Rows without id are drawn by a
    hash of their text; with ``named`` that hash comes as ``name`` (null for others). Other
    columns of ``docs`` are ignored.
    """
    name = F.when(F.col("doc_id").isNull(), text_name())
    rows = docs.select("doc_id", word_count(F.col("text")).alias("size"), "source", name.alias("name"))
    if labels is not None:
        known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("_q"))
        of_rows = F.when(F.col("_q") > 0, 1.0).when(F.col("_q") <= 0, 0.25).otherwise(0.5)
        # rows without id have no label; in the join they would all be one key
        labelled = rows.filter("doc_id is not null").join(known, F.col("doc_id") == F.col("_id"), "left").withColumn("weight", of_rows)
        rows = labelled.select(*rows.columns, "weight").unionByName(rows.filter("doc_id is null").withColumn("weight", F.lit(0.5)))
    out = mix(rows)
    return out if named else out.drop("name")
