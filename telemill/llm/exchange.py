"""Find which hashes of many pieces of text also occur elsewhere.

Rolling windows make as many hashes as there are words, too many to shuffle as
rows. Each piece (a few MB of text) therefore sends the sorted set of its distinct
hashes, cut by range into buckets, at five bytes and two flags each; a hash that
fills a piece is sent once. A bucket compares what it got from all pieces and
answers with one bit per hash, in the order in which they were sent, so the piece
can work out its hashes again from the text and read the bits.

Within a bucket hashes are told apart by 40 bits. The odd false match (about one in
a million) only makes a candidate, which the caller has to confirm.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .words import U, first_of_runs

KEYS = "piece long, bucket long, n long, keys binary, marked binary, many binary"
REPLY = "piece long, bucket long, n long, bits binary"
_LOW = U((1 << 40) - 2)


def distinct(hashes: np.ndarray, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct hashes (lowest bit cut), whether any was marked, whether any came twice."""
    x = np.sort((hashes & ~U(1)) | marked.astype(np.uint64))
    at = first_of_runs(x >> U(1))
    if len(at) == 0:
        return x, np.zeros(0, bool), np.zeros(0, bool)
    last = np.append(at[1:], len(x)) - 1
    return x[at] & ~U(1), (x[last] & U(1)).astype(bool), last > at


def cut(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted hashes, and their number at the end."""
    of = ((hashes >> U(32)) * U(buckets)) >> U(32)
    return np.searchsorted(of, np.arange(buckets + 1, dtype=np.uint64))


def pack(hashes: np.ndarray, width: int = 5) -> bytes:
    return hashes.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(raw: bytes, width: int = 5) -> np.ndarray:
    part = np.frombuffer(raw, np.uint8).reshape(-1, width)
    out = np.zeros((len(part), 8), np.uint8)
    out[:, :width] = part
    return out.view(np.uint64).ravel()


def bits(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


def key_rows(piece: int, hashes: np.ndarray, marked: np.ndarray, buckets: int) -> pa.Table:
    """The rows of one piece, for ``KEYS``."""
    u, m, many = distinct(hashes, marked)
    at = cut(u, buckets)
    rows = [
        (piece, b, int(j - i), pack(u[i:j]), np.packbits(m[i:j]).tobytes(), np.packbits(many[i:j]).tobytes())
        for b, (i, j) in enumerate(zip(at[:-1], at[1:], strict=True))
        if j > i
    ]
    return rows_table(rows, KEYS)


TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}


def rows_table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.table([pa.array(c, TYPES[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[f for f, _ in fields])


def _match(group: pa.Table) -> pa.Table:
    """One bucket: a hash counts if it is marked somewhere and comes at least twice."""
    t = group.sort_by("piece").to_pydict()
    if not t["n"]:
        return rows_table([], REPLY)
    keys = np.concatenate([unpack(k) for k in t["keys"]]) & _LOW
    marked = np.concatenate([bits(b, n) for b, n in zip(t["marked"], t["n"], strict=True)])
    many = np.concatenate([bits(b, n) for b, n in zip(t["many"], t["n"], strict=True)])
    order = np.argsort(keys)
    at = first_of_runs(keys[order])
    size = np.diff(np.append(at, len(keys)))
    hot = np.logical_or.reduceat(marked[order], at) & ((size > 1) | np.logical_or.reduceat(many[order], at))
    back = np.empty(len(keys), bool)
    back[order] = np.repeat(hot, size)
    rows, i = [], 0
    for piece, bucket, n in zip(t["piece"], t["bucket"], t["n"], strict=True):
        if back[i : i + n].any():
            rows.append((piece, bucket, n, np.packbits(back[i : i + n]).tobytes()))
        i += n
    return rows_table(rows, REPLY)


def shared_hashes(keys: DataFrame) -> DataFrame:
    """Answers to ``key_rows`` of all pieces; a bucket without a hit gives no row."""
    return keys.groupBy("bucket").applyInArrow(_match, REPLY)


def hot_of(replies: pa.Table, hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The sorted hashes of a piece that its replies name; ``hashes`` as sent."""
    u = np.unique(hashes & ~U(1))
    at = cut(u, buckets)
    keep = [np.zeros(0, np.uint64)]
    t = replies.sort_by("bucket").to_pydict()
    for b, n, raw in zip(t["bucket"], t["n"], t["bits"], strict=True):
        keep.append(u[at[b] : at[b + 1]][bits(raw, n)])
    return np.concatenate(keep)


def among(hot: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of ``hashes`` are in ``hot`` (sorted, lowest bit cut)."""
    if len(hot) == 0:
        return np.zeros(len(hashes), bool)
    x = hashes & ~U(1)
    at = np.searchsorted(hot, x)
    at[at == len(hot)] = 0
    return hot[at] == x
