"""Near-duplicate vectors by a forest of random-projection trees.

Each tree splits its vectors by random directions. A split is at the median of the
projections; vectors within ``SPILL`` of it (as a share of the vectors) go to both
sides, so close neighbours that a split would part still meet. Vectors of a leaf
are compared with each other in double precision, and what the trees find is joined.

Splits are learned from a bounded sample of a node's vectors, but every vector goes
through them. Leaves that are still too large, of which a group of near copies may
make many, are split again the same way in a next round, whatever their number.
Vectors that are the same after scaling to length one are one class first.

Splits would tear a group of near copies larger than a leaf apart, so such groups are
taken out first. In the sample of every node that is too large, a vector with links to
many others is a hub. All vectors that link with a hub belong to the nearest one, and
leave the trees. Whatever they link with is within twice the angle of the hub, and is
counted there, exactly and without writing pairs: vectors within half the angle of the
hub all link with each other, all others are compared block against block.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import components
from .exchange import rows_table
from .tables import ships_package

TREES, LEAF, SPILL = 8, 2_000, 0.05
#: Share of close pairs that a level of splits keeps together (at least, at cosine 0.9), and that all trees may miss.
KEPT, MISSED = 0.92, 0.02
#: Vectors that a round of splits of one node is learned from, and its deepest split.
SAMPLE, DEPTH = 8_000, 6
#: Share of a leaf from which a group gets a hub, what of it a sample has to show, and the vectors that are tried as hubs.
DENSE, SEEN, TRIED = 0.25, 8, 2_000
#: Vectors on either side of one task around a hub, and cells compared at a time.
BLOCK, CELLS = 8_000, 1 << 20
HUBS = "rep long, seen double, v binary"
AROUND = "hub long, rep long, members long, v binary, own boolean, taken boolean, inside boolean"
COUNTS = "rep long, others long, hub long"
NODES = "tree int, node long, rep long, v binary"
PLANS = "tree int, node long, plan binary"
PAIRS = "a long, b long"


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column as doubles and the number of each row; null lists and values are NaN."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.array([0 if n is None else n for n in pc.list_value_length(column).to_pylist()], np.int64)
    return column.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False), size


def _unit(batches):
    """vec_id, dim, v: vectors scaled to length one as bytes of doubles; null where there is none."""
    for batch in batches:
        values, size = _flat(batch.column("embedding"))
        at = np.cumsum(size) - size
        out, key = [], []
        for i, n in zip(at.tolist(), size.tolist(), strict=True):
            v = values[i : i + n]
            top = np.abs(v).max() if n else 0.0
            if not np.isfinite(top) or top == 0:
                out.append(None)
                key.append(None)
            else:
                v = v / top
                v = v / math.sqrt(float(v @ v))
                out.append(v.tobytes())
                key.append((v.astype(np.float32) + np.float32(0)).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(key, pa.binary()), pa.array(out, pa.binary())], names=["vec_id", "same", "v"]
        )


def _matrix(column) -> np.ndarray:
    return np.stack([np.frombuffer(x.as_py(), np.float64) for x in column])


def _grow(x: np.ndarray, total: int, leaf: int, rng, depth: int):
    """A nest of (direction, low, high, left, right); ``None`` is a leaf. ``total`` vectors stand for ``x``."""
    if total <= leaf or depth == 0 or len(x) < 8:
        return None
    for _ in range(4):
        d = rng.normal(size=x.shape[1])
        p = x @ d
        low, mid, high = np.quantile(p, [0.5 - SPILL, 0.5, 0.5 + SPILL])
        left, right = p <= high, p >= low
        if left.all() or right.all():  # all on one spot: no spill, and perhaps no split
            low = high = mid
            left, right = p <= mid, p > mid
        if left.any() and right.any() and not left.all() and not right.all():
            parts = [_grow(x[s], round(total * s.mean()), leaf, rng, depth - 1) for s in (left, right)]
            return d, float(low), float(high), *parts
    return None


def _route(tree, x: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(leaf, rows) of a nest; leaves are numbered by their turns from the top."""
    out, open_ = [], [(1, tree, np.arange(len(x)))]
    while open_:
        number, node, rows = open_.pop()
        if node is None:
            out.append((number, rows))
            continue
        d, low, high, left, right = node
        p = x[rows] @ d
        if low == high:
            a, b = p <= high, p > low
        else:
            a, b = p <= high, p >= low
        open_ += [(2 * number, left, rows[a]), (2 * number + 1, right, rows[b])]
    return out


def _learn(leaf: int):
    def run(key, group):
        tree, node = key[0].as_py(), key[1].as_py()
        group = group.sort_by("rep")
        rng = np.random.default_rng([tree, node & (2**63 - 1)])
        plan = _grow(_matrix(group.column("v")), group.column("total")[0].as_py(), leaf, rng, DEPTH)
        return rows_table([(tree, node, pickle.dumps(plan))], PLANS)

    return run


def _send(batches):
    """Put vectors into the leaves of their node's plan."""
    plans: dict[bytes, object] = {}
    for batch in batches:
        rows: dict[bytes, list[int]] = {}
        for i, raw in enumerate(batch.column("plan").to_pylist()):
            rows.setdefault(raw, []).append(i)
        for raw, own in rows.items():
            if raw not in plans:
                plans.clear()
                plans[raw] = pickle.loads(raw)
            part = batch.take(pa.array(own))
            x = _matrix(part.column("v"))
            for number, at in _route(plans[raw], x):
                if len(at) == 0:
                    continue
                chosen = part.take(pa.array(at))
                node = chosen.column("node").to_numpy() * (2 ** (DEPTH + 1)) + number
                done = np.full(len(at), plans[raw] is None)
                yield pa.RecordBatch.from_arrays(
                    [chosen.column("tree"), pa.array(_wrap(node)), chosen.column("rep"), chosen.column("v"), pa.array(done)],
                    names=["tree", "node", "rep", "v", "done"],
                )


def _wrap(node: np.ndarray) -> np.ndarray:
    """Node numbers are mixed, so that they stay distinct at any depth."""
    x = node.astype(np.int64).view(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))).view(np.int64)


def _compare(least: float):
    def run(group: pa.Table) -> pa.Table:
        """All pairs of one leaf, in blocks; a leaf that can't be split may be long."""
        group = group.sort_by("rep")
        ids, x = group.column("rep").to_numpy(), _matrix(group.column("v"))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        step = 512
        for i in range(0, len(ids), step):
            for j in range(i, len(ids), step):
                p, q = np.nonzero(x[i : i + step] @ x[j : j + step].T >= least - 1e-9)
                keep = ids[i + p] < ids[j + q]
                p, q = p[keep] + i, q[keep] + j
                sure = np.einsum("ij,ij->i", x[p], x[q]) >= least
                a.append(ids[p[sure]])
                b.append(ids[q[sure]])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return run


def _linked(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Which rows of ``x`` link with which of ``y``; cosines near ``least`` are taken again one by one."""
    cosine = x @ y.T
    out = cosine >= least
    p, q = np.nonzero(np.abs(cosine - least) < 1e-9)
    out[p, q] = np.einsum("ij,ij->i", x[p], y[q]) >= least
    return out


def _find_hubs(least: float, leaf: int):
    def run(key, group):
        """Vectors of a node that link with many, the one with most first, then those of what it leaves."""
        group = group.sort_by("rep")
        x, raw, ids = _matrix(group.column("v")), group.column("v"), group.column("rep").to_numpy()
        scale = group.column("total")[0].as_py() / len(x)
        rng = np.random.default_rng([key[0].as_py(), key[1].as_py() & (2**63 - 1), 1])
        tried = np.sort(rng.permutation(len(x))[:TRIED])
        near = np.concatenate([_linked(x[tried[i : i + 128]], x, least) for i in range(0, len(tried), 128)])
        seen, rows = near.sum(axis=1), []
        while True:
            top = int(seen.argmax())
            if seen[top] * scale < DENSE * leaf or seen[top] < SEEN:
                return rows_table(rows, HUBS)
            rows.append((int(ids[tried[top]]), float(seen[top] * scale), raw[int(tried[top])].as_py()))
            gone = np.flatnonzero(near[top])
            seen = seen - near[:, gone].sum(axis=1)
            near[:, gone] = False

    return run


def _apart(rows, least: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Hubs (ids, vectors) by length, those that see most first, without what links with an earlier one."""
    out: dict[int, tuple[list, list]] = {}
    for rep, _, raw in sorted(rows, key=lambda r: (-r[1], r[0])):
        v = np.frombuffer(bytes(raw), np.float64)
        ids, kept = out.setdefault(len(raw), ([], []))
        if not kept or (np.stack(kept) @ v).max() < least:
            ids.append(rep)
            kept.append(v)
    return {n: (np.array(ids, np.int64), np.stack(kept)) for n, (ids, kept) in out.items()}


def _by_hub(batch, hubs):
    """Parts of a batch with vectors of one length, as rows, matrix and the hubs of that length."""
    size = pc.binary_length(batch.column("v")).to_numpy()
    for n in np.unique(size).tolist():
        if n in hubs:
            ids, h = hubs[n]
            step = max(1, CELLS // len(ids))
            rows = np.flatnonzero(size == n)
            for i in range(0, len(rows), step):
                part = batch.take(pa.array(rows[i : i + step]))
                yield part, _matrix(part.column("v")), ids, h


def _nearest(hubs, least: float):
    def run(batches):
        """The nearest hub of every vector that links with one."""
        for batch in batches:
            for part, x, ids, h in _by_hub(batch, hubs):
                ok = _linked(x, h, least)
                best = np.where(ok, x @ h.T, -2.0).argmax(axis=1)
                at = np.flatnonzero(ok.any(axis=1))
                yield pa.RecordBatch.from_arrays([part.column("rep").take(pa.array(at)), pa.array(ids[best[at]])], names=["rep", "home"])

    return run


def _around(hubs, least: float):
    far = (2 * least * least - 1 if least > 0 else -1.0) - 1e-9
    half = math.sqrt((1 + least) / 2) + 1e-9

    def run(batches):
        """Every vector with each hub within twice the angle: only there can be what the hub's own link with."""
        for batch in batches:
            for part, x, ids, h in _by_hub(batch, hubs):
                cosine = x @ h.T
                i, j = np.nonzero(cosine >= far)
                near = part.take(pa.array(i))
                home = near.column("home")
                taken = home.is_valid().to_numpy(zero_copy_only=False)
                own = taken & (home.fill_null(0).to_numpy(zero_copy_only=False) == ids[j])
                columns = [pa.array(ids[j]), near.column("rep"), near.column("members"), near.column("v"), pa.array(own), pa.array(taken), pa.array(cosine[i, j] >= half)]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in AROUND.split(", ")])

    return run


def _count_links(least: float):
    def run(key, group):
        """Members that a block of a hub's own links with in a block around it; and the other way for those of no hub."""
        group = group.sort_by("rep")
        first = group.column("first").to_numpy()
        a, b = group.filter(pa.array(first)), group.filter(pa.array(~first))
        if not a.num_rows or not b.num_rows:
            return rows_table([], COUNTS)
        x, y = _matrix(a.column("v")), _matrix(b.column("v"))
        wx, wy = (t.column("members").to_numpy().astype(np.float64) for t in (a, b))
        nx, ny = np.zeros(len(x)), np.zeros(len(y))
        for i in range(0, len(x), 1024):
            for j in range(0, len(y), 1024):
                hit = _linked(x[i : i + 1024], y[j : j + 1024], least).astype(np.float64)
                nx[i : i + 1024] += hit @ wy[j : j + 1024]
                ny[j : j + 1024] += wx[i : i + 1024] @ hit
        p, q = np.flatnonzero(nx), np.flatnonzero(ny)
        n = np.concatenate([nx[p], np.where(b.column("taken").to_numpy()[q], 0, ny[q])]).astype(np.int64)
        ids = np.concatenate([a.column("rep").to_numpy()[p], b.column("rep").to_numpy()[q]])
        return pa.table({"rep": ids, "others": n, "hub": np.full(len(ids), key[0].as_py())})

    return run


def _dense_links(vectors: DataFrame, homes: DataFrame, hubs, least: float) -> tuple[DataFrame, DataFrame]:
    """``rep, others`` of all links that an end with a hub has, and links ``a, b`` of the same components.

    ``vectors``: rep, members, v. ``homes``: rep, home (hub) of what left the trees.
    """
    around = vectors.select("rep", "members", "v").join(homes, "rep", "left").mapInArrow(_around(hubs, least), AROUND)
    around = materialize(around, "around-hubs")

    def blocks(which):
        return F.ceil(F.count(F.when(which, True)) / F.lit(float(BLOCK)))

    own, inside = F.col("own"), F.col("inside")
    sizes = around.groupBy("hub").agg(
        blocks(own & ~inside).alias("a0"), blocks(own & inside).alias("a1"), blocks(~inside).alias("b0"), blocks(inside).alias("b1"),
        F.sum(F.when(inside, F.col("members")).otherwise(0)).alias("all_inside"),
    )
    sizes = materialize(sizes, "hub-sizes")
    placed = around.join(sizes, "hub")
    u = F.xxhash64("rep", "hub")

    def side(rows, first, outer, inner, other_outer, other_all):
        own_block = F.when(inside, F.col(outer) + F.pmod(u, F.greatest(F.col(inner), F.lit(1)))).otherwise(F.pmod(u, F.greatest(F.col(outer), F.lit(1))))
        others = F.when(inside, F.col(other_outer)).otherwise(other_all)  # what is inside links with all that is inside
        rows = rows.withColumn("_n", others).filter("_n > 0")
        mine, theirs = ("a", "b") if first else ("b", "a")
        rows = rows.select("hub", "rep", "members", "v", "taken", own_block.alias(mine), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias(theirs))
        return rows.select("hub", "a", "b", "rep", "members", "v", "taken", F.lit(first).alias("first"))

    tasks = side(placed.filter(own), True, "a0", "a1", "b0", F.col("b0") + F.col("b1")).unionByName(
        side(placed, False, "b0", "b1", "a0", F.col("a0") + F.col("a1"))
    )
    counts = materialize(tasks.groupBy("hub", "a", "b").applyInArrow(_count_links(least), COUNTS), "hub-counts")
    # everything counts itself once, as one of the block or of those inside
    base = placed.filter(own).select("rep", (F.when(inside, F.col("all_inside")).otherwise(0) - F.col("members")).alias("others"))
    degree = counts.select("rep", "others").unionByName(base).groupBy("rep").agg(F.sum("others").alias("others"))
    links = counts.select(F.col("rep").alias("a"), F.col("hub").alias("b")).unionByName(homes.select(F.col("rep").alias("a"), F.col("home").alias("b")))
    return degree, links.filter("a <> b").distinct()


def near_pairs(
    vectors: DataFrame, least: float = 0.9, trees: int = TREES, leaf: int = LEAF
) -> tuple[DataFrame, DataFrame | None, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Distinct pairs ``a < b`` of ``vectors`` (rep, v) that meet in a leaf with cosine >= ``least``.

    Dense groups are left out: their vectors (``rep, home``; null if there are none) and
    hubs come with the pairs.
    """
    homes, hubs = None, {}
    nodes = vectors.select(
        F.explode(F.array(*(F.lit(t) for t in range(trees)))).alias("tree"),
        F.length("v").cast("long").alias("node"),  # only vectors of one length meet
        "rep", "v",
    )
    pairs = None
    while True:
        sizes = nodes.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("total"))
        sizes = materialize(sizes, "leaf-sizes")
        small = nodes.join(sizes.filter(F.col("total") <= leaf), ["tree", "node"]).select("tree", "node", "rep", "v")
        found = small.groupBy("tree", "node").applyInArrow(_compare(least), PAIRS)
        large = sizes.filter(F.col("total") > leaf)
        if large.isEmpty():
            pairs = (found if pairs is None else pairs.unionByName(found)).distinct()
            if homes is not None:  # what has a hub is counted there
                for end in ("a", "b"):
                    pairs = pairs.join(homes.select(F.col("rep").alias(end)), end, "left_anti")
            return pairs.select("a", "b"), homes, hubs
        found = materialize(found, "near-pairs")  # in the first turn, of lengths that few vectors have
        pairs = found if pairs is None else pairs.unionByName(found)
        rest = nodes.join(large, ["tree", "node"])
        u = F.pmod(F.xxhash64("rep", "tree", "node"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        sample = rest.filter(u * F.col("total") < SAMPLE)
        new = _apart(sample.groupBy("tree", "node").applyInArrow(_find_hubs(least, leaf), HUBS).collect(), least)
        if new:
            free = vectors.select("rep", "v")
            free = free if homes is None else free.join(homes, "rep", "left_anti")
            own = free.mapInArrow(_nearest(new, least), "rep long, home long")
            homes = materialize(own if homes is None else homes.unionByName(own), "hub-members")
            for n, (ids, h) in new.items():
                hubs[n] = (np.concatenate([hubs[n][0], ids]), np.concatenate([hubs[n][1], h])) if n in hubs else (ids, h)
            nodes = materialize(rest.drop("total").join(homes, "rep", "left_anti").select("tree", "node", "rep", "v"), "leaves")
            continue
        plans = sample.groupBy("tree", "node").applyInArrow(_learn(leaf), PLANS)
        sent = rest.join(plans, ["tree", "node"]).select("tree", "node", "rep", "v", "plan").mapInArrow(_send, NODES + ", done boolean")
        sent = materialize(sent, "leaves")
        # what no direction splits is compared as it is, in blocks
        stuck = sent.filter("done").groupBy("tree", "node").applyInArrow(_compare(least), PAIRS)
        pairs = stuck if pairs is None else pairs.unionByName(stuck)
        nodes = sent.filter(~F.col("done")).drop("done")


def trees_for(n: int, leaf: int = LEAF) -> int:
    """Trees that leave at most ``MISSED`` of the close pairs of ``n`` vectors apart in all of them.

    A tree keeps a pair together with a chance of ``KEPT`` for each of its levels, so deeper
    forests need more trees: 8 up to four million vectors, 18 for 1e9.
    """
    depth = math.ceil(math.log2(max(1.0, n / leaf)))
    together = KEPT**depth
    return max(TREES, 0 if together >= 1 else math.ceil(math.log(MISSED) / math.log(1 - together)))


@ships_package
def near_vectors(vectors: DataFrame, least: float = 0.9, trees: int | None = None, leaf: int = LEAF) -> DataFrame:
    """Links and components of vectors by cosine; ``trees`` by default as many as ``trees_for`` their number.

    ``vectors``: ``vec_id`` (integer), ``embedding`` (array of numbers); other columns
    are ignored. Returns vec_id, n_links (other rows linked with it), component_id
    (smallest vec_id reachable) and kept (vec_id = component_id), a row for each row.
    Vectors that are null, empty, zero, or hold null or non-finite values link with
    nothing, as do vectors of different lengths. Rows of one vec_id count as rows of
    their own in n_links. A row without id takes part in no link; its component is
    null and it is kept. No rows give no rows.
    """
    unit = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(
        _unit, "vec_id long, same binary, v binary"
    )
    unit = materialize(unit, "unit-vectors")
    usable = unit.filter("v is not null and vec_id is not null")
    # a class is named by its smallest id, or by its vector where that id has several rows
    repeated = usable.groupBy("vec_id").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select(F.col("vec_id").alias("class_id"), F.lit(True).alias("_twice"))
    classes = usable.groupBy("same").agg(
        F.min("vec_id").alias("class_id"), F.count(F.lit(1)).alias("members"), F.min("v").alias("v")
    ).join(repeated, "class_id", "left")
    classes = classes.withColumn("rep", F.when(F.col("_twice"), F.xxhash64("same")).otherwise(F.col("class_id"))).drop("_twice")
    classes = materialize(classes, "vector-classes")
    trees = trees_for(classes.count(), leaf) if trees is None else trees
    pairs, homes, hubs = near_pairs(classes.select("rep", "v"), least, trees, leaf)
    links = materialize(pairs, "vector-links")
    named = classes.select("same", "class_id", "members", "rep")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    members = named.select(F.col("rep").alias("b"), "members")
    degree = both.join(members, "b").select(F.col("a").alias("rep"), F.col("members").alias("others"))
    if homes is not None:
        dense, more = _dense_links(classes.select("rep", "members", "v"), homes, hubs, least)
        degree, links = degree.unionByName(dense), links.unionByName(more)
    degree = degree.groupBy("rep").agg(F.sum("others").alias("others"))
    parts = components(links).withColumnRenamed("node", "rep")
    small = parts.join(named.select("rep", "class_id"), "rep").groupBy("component").agg(F.min("class_id").alias("smallest"))
    named = named.join(degree, "rep", "left").join(parts.join(small, "component").select("rep", "smallest"), "rep", "left")
    own = F.coalesce("smallest", "class_id", "vec_id")
    linked = usable.select("vec_id", "same").join(named, "same").select(
        "vec_id", (F.col("members") - 1 + F.coalesce("others", F.lit(0))).cast("long").alias("n_links"), own.alias("component_id"),
    )
    alone = unit.filter("v is null or vec_id is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).select("*", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
