"""Short codes for vectors: each part of a vector is named by the nearest entry of a codebook.

Vectors become integers and are cut into parts; every part position has a codebook,
fitted by rounds of exact k-means. All arithmetic is on integers, so results don't depend
on how rows are dealt out. A round is one pass over blocks of vectors, each
task with all codebooks (a few hundred integers) at hand. Most distances are never taken
(ball k-means). With an entry's members as a ball around it,

- only entries nearer than twice the ball's radius are its neighbours,
- a member nearer than half the way to the nearest neighbour is in the stable core and
  stays as it is,
- the others lie in rings between half the ways to one neighbour and the next, and
  are compared with the neighbours inside their ring only,
- a codebook that the last round left as it was is skipped.

Blocks carry their codes to the next round and the sums from which the next
codebooks are made; only sums reach the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors of a block.
BLOCK = 8_192
#: Integers must stay below this, so that squared distances of up to 64 components fit 64 bits.
LARGEST = 1 << 27
#: Share of all rows from which a label is joined by broadcast; at most so many labels can have it.
HOT_LABELS = 4_096


def _integers(column, scale: int) -> list[np.ndarray | None]:
    """Each vector as integers; None where it is null or holds a null or non-finite component."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = [0 if n is None else n for n in pc.list_value_length(column).to_pylist()]
    values = column.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    out, i = [], 0
    for n, ok in zip(size, column.is_valid().to_pylist(), strict=True):
        v = values[i : i + n]
        i += n
        if not ok or not np.isfinite(v).all():
            out.append(None)
            continue
        v = np.floor(v * scale)
        if n and np.abs(v).max() >= LARGEST:
            raise ValueError(f"components must be below {LARGEST // scale} in absolute value")
        out.append(v.astype(np.int64))
    return out


def _blocks(dim: int, scale: int, block: int):
    """Usable vectors of length ``dim`` as blocks of integers, as narrow as they allow."""

    def run(batches):
        for batch in batches:
            found = _integers(batch.column("embedding"), scale)
            at = [i for i, v in enumerate(found) if v is not None and len(v) == dim]
            for i in range(0, len(at), block):
                own = at[i : i + block]
                x = np.stack([found[j] for j in own])
                width = 2 if np.abs(x).max(initial=0) < 1 << 15 else 4
                part = batch.take(pa.array(own))
                yield _block(part.column("vec_id"), part.column("label"), x, width, None, None, None)

    return run


def _lists(column) -> pa.Array:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)


def _block(ids, labels, x, width, codes, sums, counts) -> pa.RecordBatch:
    """A row for one block."""
    raw = x.astype(f"<i{width}").tobytes()
    columns = {
        "ids": _lists(ids), "labels": _lists(labels), "x": pa.array([raw], pa.binary()), "width": pa.array([width], pa.int32()),
        "codes": pa.array([None if codes is None else codes.tobytes()], pa.binary()),
        "sums": pa.array([None if sums is None else sums.tobytes()], pa.binary()),
        "counts": pa.array([None if counts is None else counts.tobytes()], pa.binary()),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def nearest(x: np.ndarray, book: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Index of the nearest entry of ``book`` for every row, ties to the lower one, starting from the entry ``before``."""
    own = ((x - book[before]) ** 2).sum(axis=1)
    gaps = ((book[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(gaps, -1)
    order = np.argsort(gaps, axis=1, kind="stable")[:, 1:]
    np.fill_diagonal(gaps, 0)
    ways = np.take_along_axis(gaps, order, axis=1)
    # squared radius of each entry's ball; a neighbour is within twice the radius
    radius = np.zeros(len(book), np.int64)
    np.maximum.at(radius, before, own)
    neighbours = (ways <= 4 * radius[:, None]).sum(axis=1)
    best, choice = own.copy(), before.astype(np.int64)
    rows = np.flatnonzero(neighbours[before] > 0)
    for ring in range(order.shape[1]):
        # beyond the ring a neighbour is more than twice as far from the entry as the member, so it can't be nearer
        rows = rows[(neighbours[before[rows]] > ring) & (ways[before[rows], ring] <= 4 * own[rows])]
        if not len(rows):
            break
        other = order[before[rows], ring]
        d = ((x[rows] - book[other]) ** 2).sum(axis=1)
        nearer = (d < best[rows]) | ((d == best[rows]) & (other < choice[rows]))
        best[rows[nearer]], choice[rows[nearer]] = d[nearer], other[nearer]
    return choice.astype(np.uint8)


def _matrix(block, dim: int) -> np.ndarray:
    return np.frombuffer(block["x"].as_py(), f"<i{block['width'].as_py()}").astype(np.int64).reshape(-1, dim)


def _assigned(block, x: np.ndarray, books: np.ndarray, last: np.ndarray | None) -> np.ndarray:
    """Codes of a block (row, part) under ``books``; ``last`` are those its codes come from."""
    raw, w = block["codes"].as_py(), books.shape[2]
    old = np.zeros((len(x), len(books)), np.uint8) if raw is None else np.frombuffer(raw, np.uint8).reshape(len(x), -1)
    codes = old.copy()
    for p, book in enumerate(books):
        if raw is None or last is None or not np.array_equal(book, last[p]):
            codes[:, p] = nearest(x[:, p * w : (p + 1) * w], book, old[:, p])
    return codes


def _each(batch):
    for i in range(batch.num_rows):
        yield {c: batch.column(c)[i] for c in batch.schema.names}


def _round(books: np.ndarray, last: np.ndarray | None):
    dim, w = books.shape[0] * books.shape[2], books.shape[2]

    def run(batches):
        """Blocks with new codes, and the sums and counts of every entry."""
        for batch in batches:
            for block in _each(batch):
                x = _matrix(block, dim)
                codes = _assigned(block, x, books, last)
                sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
                for p in range(len(books)):
                    np.add.at(sums[p], codes[:, p], x[:, p * w : (p + 1) * w])
                    counts[p] = np.bincount(codes[:, p], minlength=books.shape[1])
                yield _block(block["ids"].values, block["labels"].values, x, block["width"].as_py(), codes, sums, counts)

    return run


def _last(books: np.ndarray, last: np.ndarray):
    dim, w = books.shape[0] * books.shape[2], books.shape[2]

    def run(batches):
        """A row for each vector: its code and error."""
        for batch in batches:
            for block in _each(batch):
                x = _matrix(block, dim)
                codes = _assigned(block, x, books, last)
                error = np.zeros(len(x), np.int64)
                for p in range(len(books)):
                    error += ((x[:, p * w : (p + 1) * w] - books[p][codes[:, p]]) ** 2).sum(axis=1)
                text = codes.tobytes().hex()
                step = 2 * len(books)
                names = pa.array([text[i : i + step] for i in range(0, len(text), step)], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [block["ids"].values, block["labels"].values, names, pa.array(error)], names=["vec_id", "label", "code", "error"]
                )

    return run


def _add_up(batches):
    """Sums of the blocks of a task, by entry and place."""
    sums = counts = None
    for batch in batches:
        for a, b in zip(batch.column("sums").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            a, b = np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)
            sums, counts = (a, b) if sums is None else (sums + a, counts + b)
    if sums is not None:
        both = np.concatenate([sums, counts])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(both))), pa.array(both)], names=["at", "n"])


def moved(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The next codebooks: every entry at the floor of its members' mean, entries without members as they were.

    The driver gets one number for each entry and component, and one for each entry.
    """
    totals = state.select("sums", "counts").mapInArrow(_add_up, "at long, n long").groupBy("at").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
    flat = [0] * (books.size + books.shape[0] * books.shape[1])
    for r in totals.collect():
        flat[r["at"]] = int(r["n"])
    counts = flat[books.size :]
    width = books.shape[2]
    mean = [s // counts[i // width] if counts[i // width] else int(old) for i, (s, old) in enumerate(zip(flat, books.ravel(), strict=False))]
    return np.array(mean, np.int64).reshape(books.shape)


def _first_entries(vectors: DataFrame, parts: int, entries: int, scale: int) -> np.ndarray | None:
    """Codebooks of the vectors with the smallest ids; those of other lengths than the first don't count."""
    def ints(batches):
        for batch in batches:
            found = _integers(batch.column("embedding"), scale)
            keep = [i for i, v in enumerate(found) if v is not None and len(v) and len(v) % parts == 0 and batch.column("vec_id")[i].is_valid]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(keep, pa.int64())), pa.array([found[i] for i in keep], pa.list_(pa.int64()))], names=["vec_id", "v"]
            )

    usable = vectors.select("vec_id", "embedding").mapInArrow(ints, "vec_id long, v array<long>")
    head = usable.orderBy("vec_id", "v").limit(1).collect()
    if not head:
        return None
    dim = len(head[0]["v"])
    rows = usable.filter(F.size("v") == dim).orderBy("vec_id", "v").limit(entries).collect()
    seeds = np.array([r["v"] for r in rows], np.int64)
    return seeds.reshape(len(rows), parts, dim // parts).transpose(1, 0, 2).copy()


def book_digest(books: np.ndarray) -> str:
    """SHA-256 of all integers by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _with_label_errors(coded: DataFrame) -> DataFrame:
    """Add the error of all rows of a label; nulls are one label.

    Labels of more than a few thousandths of all rows, which are few, are joined by
    broadcast, so that none of them is one key of a shuffle.
    """
    sums = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_n")), "label-errors")
    total = sums.agg(F.sum("_n")).first()[0] or 0
    hot = F.col("_n") * HOT_LABELS >= total
    out = None
    for some, hint in ((hot, F.broadcast), (~hot, lambda x: x)):
        own = sums.filter(some).select(F.col("label").alias("_label"), "label_error")
        rows = coded if hint is F.broadcast else coded.join(F.broadcast(sums.filter(hot).select(F.col("label").alias("_label"))), F.col("label").eqNullSafe(F.col("_label")), "left_anti")
        joined = rows.join(hint(own), F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
        out = joined if out is None else out.unionByName(joined)
    return out


def encode(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, block: int = BLOCK
) -> tuple[DataFrame, np.ndarray | None]:
    """Codes and errors of all usable vectors, and the codebooks (part, entry, component).

    ``vectors``: vec_id (integer), embedding (array of numbers), and label if there is
    one. Rows whose vector is null or holds null or non-finite components are dropped.
    Codebooks begin as the vectors of the smallest ids (equal ids in order of their
    integers; rows without id come later than all and are never first); with fewer
    vectors they have fewer entries. All vectors must have one length, that of the
    first, a multiple of ``parts``; rows of other lengths, empty ones included, are kept with a null
    code and error. Rows repeated in full are rows of their own. No usable rows: None.
    """
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", label.alias("label"))
    kind = vectors.schema["label"].dataType.simpleString()
    books = _first_entries(vectors, parts, entries, scale)
    out = f"vec_id long, label {kind}, code string, error long"
    if books is None:
        return _other_lengths(vectors, -1, out), None
    dim = books.shape[0] * books.shape[2]
    row = f"ids array<long>, labels array<{kind}>, x binary, width int, codes binary, sums binary, counts binary"
    state, last = materialize(vectors.mapInArrow(_blocks(dim, scale, block), row), "vector-blocks"), None
    for turn in range(rounds):
        state = materialize(state.mapInArrow(_round(books, last), row), f"vector-codes-{turn}")
        books, last = moved(state, books), books
    coded = state.mapInArrow(_last(books, last), out)
    return materialize(coded.unionByName(_other_lengths(vectors, dim, out)), "vector-codes"), books


def _other_lengths(vectors: DataFrame, dim: int, out: str) -> DataFrame:
    """Finite vectors of another length than ``dim``, without a code."""
    whole = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    return vectors.filter(whole & (F.size("embedding") != dim)).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")
    )


def vector_codes(vectors: DataFrame, **settings) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every usable vector; see ``encode``.

    ``label_error`` sums the errors of rows with the same label, null being one.
    """
    coded, books = encode(vectors, **settings)
    digest = F.lit(None if books is None else book_digest(books)).cast("string")
    return _with_label_errors(coded).select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))
