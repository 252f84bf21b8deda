"""Components of a similarity join over lists of shared tokens.

Rows that share a token are in its list. Short lists are compared as they are. Long ones,
which groups of near copies make, are first compared with one member, a hub, and what
links with it becomes one component. Rounds go on, with new hubs and with what is still
open of the long lists, while they pay; then all pairs that are left between different
components are compared. Pairs inside a component can't change it, so nothing is lost by
leaving them out. A round's tables go when the next one's stand.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release
from .components import components

#: Lists up to this length aren't worth a hub.
SHORT_LIST = 16
#: Hub rounds go on while the pairs left exceed this many times the postings.
PAIRS_PER_POSTING = 4


def _placed(postings: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Postings with their component."""
    if labels is None:
        return postings.withColumn("comp", F.col("rep"))
    found = postings.drop("comp").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    return found.withColumn("comp", F.coalesce("component", "rep")).drop("component")


def _open(placed: DataFrame) -> DataFrame:
    """Lists of several components: token, size, and the largest component, ``major``."""
    own = placed.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("k"))
    return (
        own.groupBy("token")
        .agg(F.sum("k").alias("size"), F.max("k").alias("top"), F.max_by("comp", F.struct("k", "comp")).alias("major"))
        .filter("top < size")
        .drop("top")
    )


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``node, component`` of everything in ``labels``, or that ``links`` (a, b) now connect.

    Links are put between components, so only these are worked out anew.
    """
    if labels is None:
        return components(links)
    for end in ("a", "b"):
        own = labels.select(F.col("node").alias(end), F.col("component").alias("_c"))
        links = links.join(own, end, "left").withColumn(end, F.coalesce("_c", end)).drop("_c")
    new = materialize(components(links), "new-components")
    moved = new.select(F.col("node").alias("component"), F.col("component").alias("_to"))
    old = labels.join(moved, "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
    fresh = new.join(labels.select("node"), "node", "left_anti")
    out = materialize(old.unionByName(fresh), "components")
    release(new)
    return out


def linked(
    postings: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    close: Callable[[Column, Column], Column],
    meet: Callable[[DataFrame], DataFrame],
    also: DataFrame | None = None,
) -> DataFrame:
    """``node, component`` of everything that verified pairs, or pairs of ``also`` (a, b), connect; stored.

    ``postings``: ``token, rep, n, rank`` and what ``meet`` needs; the smallest
    ``rank`` of a list is its first hub. ``verify`` takes pairs ``a, b`` and returns
    those that link. ``close`` says whether two values of ``n`` may link. ``meet``
    takes the pairs of postings in a list (the second with ``_x`` behind each column)
    and returns distinct candidate pairs ``a, b``.
    """
    names = [*postings.columns, "comp"]
    many = postings.groupBy("token").agg(F.count(F.lit(1)).alias("_k")).filter("_k > 1")
    postings = materialize(postings.join(many, "token"), "postings")
    total = postings.count()
    labels = None if also is None else merged(None, also)
    long, before, turn = postings.filter(F.col("_k") > SHORT_LIST), math.inf, 0
    lists = None
    while True:
        placed = _placed(long, labels).drop("size", "major", "minor")
        still = materialize(placed.join(_open(placed), "token"), "open-lists").withColumn("minor", F.col("comp") != F.col("major"))
        release(lists)
        lists = long = still
        work = lists.agg(F.sum(F.when(F.col("minor"), F.col("size")))).first()[0] or 0
        if work <= PAIRS_PER_POSTING * total or work > 0.8 * before:
            break
        before = work
        order = F.struct("rank", "rep") if turn == 0 else F.struct(F.xxhash64("rep", F.lit(turn)), "rep")
        eligible = lists if turn == 0 else lists.filter(~F.col("minor"))
        hub = F.struct(F.col("rep").alias("hub"), F.col("n").alias("hub_n"), F.col("comp").alias("hub_comp"))
        hubs = eligible.groupBy("token").agg(F.min_by(hub, order).alias("h")).select("token", "h.*")
        pairs = (
            lists.join(hubs, "token")
            .filter((F.col("comp") != F.col("hub_comp")) & close(F.col("n"), F.col("hub_n")))
            .select(F.col("rep").alias("a"), F.col("hub").alias("b"))
            .distinct()
        )
        labels = _joined(labels, pairs, verify)
        turn += 1
    # long lists: what isn't of the largest component of its list meets all others
    x = lists.filter("minor").select("token", *(F.col(c).alias(f"{c}_x") for c in names if c != "token"))
    met = x.join(lists.select(*names, "minor"), "token").filter(
        (F.col("comp") != F.col("comp_x"))
        & (~F.col("minor") | (F.col("rep_x") < F.col("rep")))
        & close(F.col("n"), F.col("n_x"))
    )
    # short lists, of bounded length, are opened against themselves
    short = _placed(postings.filter(F.col("_k") <= SHORT_LIST), labels)
    row = F.struct(*(c for c in names if c != "token"))
    group = short.groupBy("token").agg(F.collect_list(row).alias("_all")).filter(F.size(F.array_distinct("_all.comp")) > 1)
    both = group.withColumn("_a", F.explode("_all")).withColumn("_b", F.explode("_all")).select(
        "token", *(F.col(f"_a.{c}").alias(f"{c}_x") for c in names if c != "token"), *(F.col(f"_b.{c}").alias(c) for c in names if c != "token")
    ).filter((F.col("rep_x") < F.col("rep")) & (F.col("comp") != F.col("comp_x")) & close(F.col("n"), F.col("n_x")))
    met = met.select(*both.columns).unionByName(both)
    labels = _joined(labels, meet(met), verify)
    release(lists, postings)
    return labels


def _joined(labels: DataFrame | None, pairs: DataFrame, verify) -> DataFrame:
    """Labels with the pairs that hold; pairs are stored, so that their size says how they are joined."""
    pairs = materialize(pairs, "pairs")
    found = materialize(verify(pairs), "similar")
    out = merged(labels, found)
    release(pairs, found, labels)
    return out
