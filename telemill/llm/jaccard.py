"""Join documents whose sets of word shingles are similar, by adaptive prefixes.

All shingles have one order: by how many documents hold them, then by hash. If two
sets have Jaccard similarity 0.75 or more, the first ``n - ceil(0.75 n) + l``
shingles of each share at least ``l``. A document picks its own ``l``: a longer
prefix makes more postings but asks for more matches, and the choice is the one of
least estimated cost. A pair needs the smaller ``l`` of the two.

1. Shingle counts come from ``exchange``-like messages of distinct hashes by piece.
   Shingles of one document only come first in its order, so a document with more
   than a quarter of them has no partner and goes no further.
2. Documents of equal sets become one class.
3. Prefixes are posted by shingle, and ``joining`` finds the components: dense groups
   by way of hubs, all pairs between different components by counting matches and
   verifying what has enough.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import keep, materialize, scratch
from .exchange import bits, cut, pack, rows_table, unpack
from .joining import linked
from .tables import in_pieces, pieces, ships_package
from .words import LOWER, U, first_of_runs, grams, mix, word_hashes, words_of

SHINGLE = 5
PIECE_BYTES = 5_000_000
#: Longest prefix extension tried, and the cost of verifying a pair in postings.
LONGEST, VERIFY = 8, 1.0
COUNTS = "piece long, bucket long, n long, keys binary, often binary"
CODES = "piece long, bucket long, n long, bits binary, codes binary"
SETS = "doc_id long, text_hash long, n_shingles long, signature binary, shared binary, codes binary"
POSTINGS = "token long, rep long, n long, at long, rank long, l int"
PAIR = "a long, b long"


def needed(n):
    """Smallest overlap that a set of ``n`` can have with a similar one: three quarters, rounded up."""
    return (3 * n + 3) // 4


def shingles(column, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and how many each has."""
    words = words_of(column)
    h = word_hashes(words, fold=LOWER)
    g, whole = grams(h, words.doc, k)
    first, out = words.first, []
    counts = np.zeros(len(words.counts), np.int64)
    for r, size in enumerate(words.counts.tolist()):
        i = int(first[r])
        if size >= k:
            x = np.sort(g[i : i + size - k + 1] & ~U(1))
            x = x[first_of_runs(x)]
        elif size:
            y = U(size)
            for v in h[i : i + size]:
                y = mix(y * U(0x9E3779B97F4A7C15) + v)
            x = np.array([y & ~U(1)])
        else:
            continue
        counts[r] = len(x)
        out.append(x)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), counts


def _send(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        piece = table.column("piece")[0].as_py()
        with np.errstate(over="ignore"):
            x = np.sort(shingles(table.column("text"))[0])
        at = first_of_runs(x)
        u, size = x[at], np.diff(np.append(at, len(x)))
        edges = cut(u, buckets)
        rows = []
        for b, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if j > i:
                more = np.flatnonzero(size[i:j] > 1)
                often = np.stack([more, size[i:j][more]]).astype(np.int64)
                rows.append((piece, b, int(j - i), pack(u[i:j]), often.tobytes()))
        return rows_table(rows, COUNTS)

    return run


def _count(group: pa.Table) -> pa.Table:
    """One bucket: a code for the number of documents of every hash; 0 stands for one."""
    t = group.sort_by("piece").to_pydict()
    if not t["n"]:
        return rows_table([], CODES)
    keys = np.concatenate([unpack(k) for k in t["keys"]])
    size = np.ones(len(keys), np.int64)
    i = 0
    for n, raw in zip(t["n"], t["often"], strict=True):
        where, value = np.frombuffer(raw, np.int64).reshape(2, -1)
        size[i + where] = value
        i += n
    order = np.argsort(keys)
    at = first_of_runs(keys[order])
    total = np.add.reduceat(size[order], at)
    code = np.floor(4 * np.log2(total)).astype(np.uint8)
    codes = np.empty(len(keys), np.uint8)
    codes[order] = np.repeat(code, np.diff(np.append(at, len(keys))))
    rows, i = [], 0
    for piece, bucket, n in zip(t["piece"], t["bucket"], t["n"], strict=True):
        own = codes[i : i + n]
        if own.any():
            rows.append((piece, bucket, n, np.packbits(own > 0).tobytes(), own[own > 0].tobytes()))
        i += n
    return rows_table(rows, CODES)


def _sets(buckets: int):
    def run(key, table: pa.Table, replies: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            x, counts = shingles(table.column("text"))
        u = np.unique(x)
        edges = cut(u, buckets)
        hot, code = [u[:0]], [np.zeros(0, np.uint8)]
        t = replies.sort_by("bucket").to_pydict() if replies.num_rows else {k: [] for k in ("bucket", "n", "bits", "codes")}
        for b, n, raw, own in zip(t["bucket"], t["n"], t["bits"], t["codes"], strict=True):
            hot.append(u[edges[b] : edges[b + 1]][bits(raw, n)])
            code.append(np.frombuffer(own, np.uint8))
        hot, code = np.concatenate(hot), np.concatenate(code)
        codes = np.zeros(len(x), np.uint8)
        if len(hot):
            at = np.searchsorted(hot, x)
            at[at == len(hot)] = 0
            codes = np.where(hot[at] == x, code[at], 0).astype(np.uint8)
        rows, seen, i = [], set(), 0
        for doc_id, text_hash, n in zip(table.column("doc_id").to_pylist(), table.column("text_hash").to_pylist(), counts.tolist(), strict=True):
            own, c = x[i : i + n], codes[i : i + n]
            i += n
            if n == 0 or doc_id is None:
                rows.append((doc_id, text_hash, n, None, None, None))
                continue
            signature = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
            keep = np.flatnonzero(c)
            if len(keep) < needed(n):
                rows.append((doc_id, text_hash, n, None, None, None))
            elif signature in seen:
                rows.append((doc_id, text_hash, n, signature, None, None))
            else:
                seen.add(signature)
                order = keep[np.lexsort((own[keep], c[keep]))]
                rows.append((doc_id, text_hash, n, signature, own[order].tobytes(), c[order].tobytes()))
        return rows_table(rows, SETS)

    return run


def text_hash(text: str = "text"):
    """What tells rows of one doc_id apart."""
    return F.coalesce(F.xxhash64(F.lit(3), text), F.lit(0))


def shingle_sets(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles and, where a document may have a partner, signature and ordered shared shingles.

    Of equal sets in one piece of the corpus one row has the shingles.
    """
    n = pieces(docs, PIECE_BYTES)
    docs = docs.select("doc_id", "text", text_hash().alias("text_hash"))
    parts = in_pieces(docs, n, "doc_id", "text", "text_hash")
    counts = parts.groupBy("piece").applyInArrow(_send(n), COUNTS)
    codes = counts.groupBy("bucket").applyInArrow(_count, CODES)
    return parts.groupBy("piece").cogroup(codes.groupBy("piece")).applyInArrow(_sets(n), SETS)


def best_length(n: int, codes: np.ndarray) -> tuple[int, int]:
    """The extension ``l`` of least estimated cost, and the shared shingles its prefix has.

    What a prefix costs is estimated for a partner of the same size, which may miss
    one shingle in seven: the documents in its lists, and of those the share that may
    have enough matches and gets verified.
    """
    alone = n - len(codes)
    visits = np.concatenate([[0.0], np.cumsum(np.exp2(codes / 4.0))])
    best, choice = math.inf, (1, 0)
    for length in range(1, LONGEST + 1):
        size = n - needed(n) + length - alone
        if size > len(codes):
            break
        typical = n - (6 * n + 6) // 7 + length - alone
        cost = visits[min(max(typical, 0), len(codes))] * (1 + VERIFY / length)
        if cost < best:
            best, choice = cost, (length, max(size, 0))
    return choice


def _post(batches):
    for batch in batches:
        rows = []
        t = batch.to_pydict()
        for rep, n, shared, codes in zip(t["rep"], t["n"], t["shared"], t["codes"], strict=True):
            c = np.frombuffer(codes, np.uint8)
            length, size = best_length(n, c)
            alone = n - len(c)
            for at, token in enumerate(np.frombuffer(shared, np.int64)[:size].tolist()):
                rows.append((token, rep, n, alone + at, alone, length))
        yield from rows_table(rows, POSTINGS).to_batches()


def _verify(batches):
    for batch in batches:
        rows = []
        t = batch.to_pydict()
        for a, b, na, nb, x, y in zip(*(t[k] for k in ("a", "b", "na", "nb", "xa", "xb")), strict=True):
            both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
            both.sort()
            same = int((both[1:] == both[:-1]).sum())
            if 7 * same >= 3 * (na + nb):
                rows.append((a, b))
        yield from rows_table(rows, PAIR).to_batches()


def verified(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sets have 100 * intersection >= 75 * union."""
    x = classes.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("shared").alias("xa"))
    y = classes.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("shared").alias("xb"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "na", "nb", "xa", "xb").mapInArrow(_verify, PAIR)


def _close(a, b):
    """Sizes that 0.75 allows."""
    return (4 * F.least(a, b)) >= (3 * F.greatest(a, b))


def _overlap(a, b):
    """Smallest overlap of two similar sets: 3 / 7 of both sizes, rounded up."""
    return F.ceil((F.lit(3) * (a + b)) / F.lit(7))


def _meet(met: DataFrame) -> DataFrame:
    """Pairs with enough matches.

    The first ``l`` common shingles stand before place ``n - overlap + l`` in either
    set. Behind the last match that was seen, no more can match than the shorter rest.
    """
    spare = F.least("l", "l_x") - _overlap(F.col("n"), F.col("n_x"))
    met = met.filter((F.col("at") < F.col("n") + spare) & (F.col("at_x") < F.col("n_x") + spare))
    # either of a pair may come first, so both are put in order before matches are counted
    turned = F.col("rep") < F.col("rep_x")

    def both(c):
        return F.when(turned, F.col(f"{c}_x")).otherwise(F.col(c)), F.when(turned, F.col(c)).otherwise(F.col(f"{c}_x"))

    (a, b), (na, nb), (at, bt) = both("rep"), both("n"), both("at")
    counted = (
        met.select(a.alias("a"), b.alias("b"), na.alias("na"), nb.alias("nb"), at.alias("at"), bt.alias("bt"), F.least("l", "l_x").alias("l"))
        .groupBy("a", "b", "na", "nb", "l")
        .agg(F.count(F.lit(1)).alias("matches"), F.max("at").alias("at"), F.max("bt").alias("bt"))
        .withColumn("rest", F.least(F.col("na") - F.col("at"), F.col("nb") - F.col("bt")) - 1)
    )
    enough = (F.col("matches") >= F.col("l")) & (F.col("matches") + F.col("rest") >= _overlap(F.col("na"), F.col("nb")))
    return counted.filter(enough).select("a", "b")


def linked_classes(classes: DataFrame, also: DataFrame | None) -> DataFrame:
    """``node, component`` of classes (rep, n, shared, codes) that similarity or ``also`` (a, b) connects."""
    postings = classes.select("rep", "n", "shared", "codes").mapInArrow(_post, POSTINGS)
    return linked(postings, lambda pairs: verified(pairs, classes), _close, _meet, also)


def _classes(sets: DataFrame) -> DataFrame:
    """Distinct sets that may have a partner: signature, class_id (smallest doc_id), n, shared, codes, rep; stored.

    ``rep`` names a class by its smallest id, or by its set where that id has several rows.
    """
    classes = (
        sets.filter("signature is not null").groupBy("signature").agg(
            F.min("doc_id").alias("class_id"), F.first("n_shingles").alias("n"),
            F.first("shared", ignorenulls=True).alias("shared"), F.first("codes", ignorenulls=True).alias("codes"),
        )
    )
    repeated = sets.filter("doc_id is not null").groupBy(F.col("doc_id").alias("class_id")).agg(
        F.count(F.lit(1)).alias("_k")
    ).filter("_k > 1").select("class_id", F.lit(True).alias("_twice"))
    named = classes.join(materialize(repeated, "repeated-ids"), "class_id", "left").withColumn(
        "rep", F.when(F.col("_twice"), F.xxhash64("signature")).otherwise(F.col("class_id"))
    )
    return materialize(named.drop("_twice"), "classes")


def _with_classes(sets: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``sets`` that have a class, with class_id and rep, and those that have none.

    Most rows have none; they take no part in a join, where they would all be one key.
    """
    own = sets.filter("signature is not null").select("doc_id", "text_hash", "n_shingles", "signature")
    rest = sets.filter("signature is null").select("doc_id", "text_hash", "n_shingles")
    return own.join(classes.select("signature", "class_id", "rep"), "signature").drop("signature"), rest


@ships_package
def similar_documents(docs: DataFrame) -> DataFrame:
    """Component of every document under similarity of its 5-word shingles.

    ``docs``: ``doc_id`` (integer), ``text``; other columns are ignored. A-Z are
    lower-cased, a shorter text is one shingle, a text without words has none and
    links with nothing. Two documents link when 100 * intersection >= 75 * union.
    Returns doc_id, n_shingles, class_id (smallest doc_id of an equal set) and
    component_id (smallest doc_id that links reach), a row for each row. Rows of one
    doc_id are one document: what any of its texts links with is linked. A row
    without id gets a null class and component and links with nothing. No rows
    give no rows. Tables of the join are deleted when it ends; the result is stored.
    """
    with scratch(docs.sparkSession):
        sets = materialize(shingle_sets(docs), "shingle-sets")
        classes = _classes(sets)
        repeated = sets.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_k")).filter("_k > 1")
        repeated = materialize(repeated.select("doc_id"), "repeated-ids")
        rows, rest = _with_classes(sets, classes)
        of_repeated = rows.join(repeated, "doc_id", "left_semi")
        together = of_repeated.join(
            of_repeated.groupBy("doc_id").agg(F.min("rep").alias("b")), "doc_id"
        ).select(F.col("rep").alias("a"), "b")
        labels = linked_classes(classes, together)
        labels = classes.select("rep", "class_id").join(labels.withColumnRenamed("node", "rep"), "rep")
        labels = materialize(labels, "labels")
        smallest = labels.groupBy("component").agg(F.min("class_id").alias("component_id"))
        named = materialize(labels.join(smallest, "component").select("rep", "component_id"), "named")
        out = rows.join(named, "rep", "left").select(
            "doc_id", "n_shingles", "class_id", F.coalesce("component_id", "class_id").alias("component_id"),
        ).unionByName(rest.select("doc_id", "n_shingles", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id")))
        again = out.join(repeated, "doc_id", "left_semi")
        shared = again.groupBy("doc_id").agg(F.min("component_id").alias("_all"))
        again = again.join(shared, "doc_id").select("doc_id", "n_shingles", "class_id", F.col("_all").alias("component_id"))
        once = out.join(repeated, "doc_id", "left_anti")
        return keep(materialize(once.unionByName(again), "similar-documents"))


@ships_package
def similar_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay if of each group of similar texts one does: doc_id, text_hash, copies.

    As ``similar_documents``, but every row is a text of its own: rows of one doc_id with
    different texts are in one group only if their texts are similar. Of a group the row of
    the smallest doc_id stays, of several with that id the one of the smallest ``text_hash``;
    ``copies`` says how many rows of the table have this id and hash. Rows without
    id are in no group and not listed; texts without words each stay.
    """
    with scratch(docs.sparkSession):
        sets = materialize(shingle_sets(docs), "shingle-sets")
        classes = _classes(sets)
        rows, rest = _with_classes(sets, classes)
        labels = linked_classes(classes, None)
        named = rows.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("_group", F.coalesce("component", "rep"))
        key = F.struct("doc_id", "text_hash")
        counted = named.groupBy("_group", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
        first = counted.groupBy("_group").agg(F.min_by(F.struct("doc_id", "text_hash", "copies"), key).alias("_f")).select("_f.*")
        alone = rest.filter("doc_id is not null").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"), F.max("n_shingles").alias("_n"))
        # rows of one id and text are similar if the text has words
        alone = alone.select("doc_id", "text_hash", F.when(F.col("_n") > 0, F.col("copies")).otherwise(F.lit(1)).alias("copies"))
        return keep(materialize(first.unionByName(alone), "similar-rows"))
