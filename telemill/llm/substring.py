"""Remove word passages that an earlier document holds already.

Fixed-block anchors. Every text is cut into blocks of ``BLOCK`` words that do not
overlap; those are the index. Every window of ``BLOCK`` words of every text probes
it. A passage of ``WINDOW >= 2 * BLOCK - 1`` words holds a whole block wherever it
starts, so each repeat has an anchor. Around anchors the windows of ``WINDOW``
words are fingerprinted with 96 bits, the smallest document of each is found, and
the covered words of later documents grow together into maximal exact repeats.

Three passes over the text, all on one shuffle of it into pieces:

1. block and probe hashes -> which are shared (``exchange``),
2. windows that hold a shared anchor -> is there a smaller document,
3. covered words are removed.

A passage in thousands of documents is sent once per piece, never as pairs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import KEYS, among, bits, cut, hot_of, key_rows, pack, rows_table, shared_hashes, unpack
from .tables import in_pieces, pieces
from .words import U, grams, word_hashes, words_of

WINDOW = 13
BLOCK = 7
PIECE_BYTES = 5_000_000
PRINTS = "piece long, bucket long, n long, prints binary, docs binary"
EARLIER = "piece long, bucket long, n long, bits binary, kind long"
OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, repeat_starts array<int>, repeat_ends array<int>"
LAST = np.iinfo(np.int64).max


def _ids(table: pa.Table) -> np.ndarray:
    """Ids in row order; rows without one come after all others."""
    return table.column("doc_id").cast(pa.int64()).fill_null(LAST).to_numpy()


def _anchors(words, hashes):
    """Rolling block hashes, and which windows are blocks of the index."""
    h, whole = grams(hashes, words.doc, BLOCK)
    within = np.arange(len(h)) - words.first[words.doc[: len(h)]]
    return h, whole, within % BLOCK == 0


def _candidates(table: pa.Table, replies: pa.Table, buckets: int):
    """Windows of a piece around shared anchors: words, first word, two hashes, document."""
    words = words_of(table.column("text"))
    hashes = word_hashes(words)
    h, whole, _ = _anchors(words, hashes)
    hot = np.zeros(len(h), bool)
    hot[whole] = among(hot_of(replies, h[whole], buckets), h[whole])
    first, inside = grams(hashes, words.doc, WINDOW)
    if len(first) == 0:
        return words, np.zeros(0, np.int64), first, first, np.zeros(0, np.int64)
    reach = WINDOW - BLOCK + 1
    sums = np.concatenate([[0], np.cumsum(hot)])
    near = sums[reach : reach + len(first)] - sums[: len(first)] > 0
    at = np.flatnonzero(near & inside)
    if len(at) == 0:
        return words, at, first[:0], first[:0], np.zeros(0, np.int64)
    second, _ = grams(word_hashes(words, salt=1), words.doc, WINDOW)
    return words, at, first[at], second[at], _ids(table)[words.doc[at]]


def _smallest(a: np.ndarray, b: np.ndarray, ids: np.ndarray):
    """Order by print, first of each print in it, smallest id of each print."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(new)
    low = np.minimum.reduceat(ids[order], at) if len(at) else ids[:0]
    return order, at, low


def _send_prints(buckets: int):
    def run(key, table: pa.Table, replies: pa.Table) -> pa.Table:
        if table.num_rows == 0:
            return rows_table([], PRINTS)
        _, _, a, b, ids = _candidates(table, replies, buckets)
        b &= U(0xFFFFFFFF)
        order, at, low = _smallest(a, b, ids)
        a, b = a[order][at], b[order][at]
        edges = cut(a, buckets)
        rows = [
            (key[0].as_py(), k, int(j - i), pack(a[i:j], 8) + pack(b[i:j], 4), _pack_ids(low[i:j]))
            for k, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if j > i
        ]
        return rows_table(rows, PRINTS)

    return run


def _pack_ids(ids: np.ndarray) -> bytes:
    """Ids in as few bytes as the largest distance from the smallest needs."""
    base = ids.min()
    gaps = (ids.astype(np.uint64) - base.astype(np.uint64)) if len(ids) else ids.astype(np.uint64)
    width = next(w for w in (2, 3, 4, 5, 8) if w == 8 or int(gaps.max()) < 1 << (8 * w))
    return np.int64(base).tobytes() + bytes([width]) + pack(np.ascontiguousarray(gaps), width)


def _unpack_ids(raw: bytes) -> np.ndarray:
    base = np.frombuffer(raw[:8], np.int64)[0]
    return (unpack(raw[9:], raw[8]) + base.astype(np.uint64)).astype(np.int64)


def _match_prints(group: pa.Table) -> pa.Table:
    """One bucket: for each piece's print, whether another piece has it in a smaller document."""
    t = group.sort_by("piece").to_pydict()
    if not t["n"]:
        return rows_table([], EARLIER)
    a = np.concatenate([unpack(p[: 8 * n], 8) for p, n in zip(t["prints"], t["n"], strict=True)])
    b = np.concatenate([unpack(p[8 * n :], 4) for p, n in zip(t["prints"], t["n"], strict=True)])
    ids = np.concatenate([_unpack_ids(x) for x in t["docs"]])
    order, at, low = _smallest(a, b, ids)
    least = np.empty(len(a), np.int64)
    least[order] = np.repeat(low, np.diff(np.append(at, len(a))))
    rows, i = [], 0
    for piece, bucket, n in zip(t["piece"], t["bucket"], t["n"], strict=True):
        earlier = least[i : i + n] < ids[i : i + n]
        if earlier.any():
            rows.append((piece, bucket, n, np.packbits(earlier).tobytes(), 1))
        i += n
    return rows_table(rows, EARLIER)


def _remove(buckets: int, with_text: bool):
    def run(key, table: pa.Table, replies: pa.Table) -> pa.Table:
        anchors = replies.filter(pc.equal(replies.column("kind"), 0))
        prints = replies.filter(pc.equal(replies.column("kind"), 1))
        words, at, a, b, ids = _candidates(table, anchors, buckets)
        b &= U(0xFFFFFFFF)
        order, starts, low = _smallest(a, b, ids)
        runs = np.diff(np.append(starts, len(a)))
        edges = cut(a[order][starts], buckets)
        elsewhere = np.zeros(len(starts), bool)
        t = prints.to_pydict()
        for k, n, raw in zip(t["bucket"], t["n"], t["bits"], strict=True):
            elsewhere[edges[k] : edges[k + 1]] = bits(raw, n)
        repeated = np.empty(len(a), bool)
        repeated[order] = (ids[order] > np.repeat(low, runs)) | np.repeat(elsewhere, runs)
        n = len(words.starts)
        depth = np.zeros(n + 1, np.int32)
        np.add.at(depth, at[repeated], 1)
        np.add.at(depth, at[repeated] + WINDOW, -1)
        gone = np.cumsum(depth)[:n] > 0
        return _results(table, words, gone, with_text)

    return run


def _results(table: pa.Table, words, gone: np.ndarray, with_text: bool) -> pa.Table:
    first = words.first
    removed = np.concatenate([[0], np.cumsum(gone)])
    rows = []
    data = words.data.tobytes()
    for r, doc_id in enumerate(table.column("doc_id").to_pylist()):
        i, j = int(first[r]), int(first[r + 1])
        flags = gone[i:j]
        keep = np.flatnonzero(~flags) + i
        text = b" ".join([data[s:e] for s, e in zip(words.starts[keep].tolist(), words.ends[keep].tolist(), strict=True)])
        edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
        rows.append((doc_id, j - i, int(removed[j] - removed[i]), hashlib.sha256(text).hexdigest(),
                     text.decode() if with_text else None, edge[::2].tolist(), edge[1::2].tolist()))
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in range(7)]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    names = [f.split()[0] for f in OUT.split(", ")]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Remove each word covered by a window that a document of smaller doc_id holds too.

    ``docs``: ``doc_id`` (integer), ``text``; other columns are ignored. A window is
    13 consecutive words of one document, judged on the input. Returns doc_id,
    n_words, n_removed, kept_sha256 (of the kept words joined by one space),
    kept_text (null unless ``with_text``) and the word ranges of the maximal repeats,
    ``repeat_starts`` to ``repeat_ends`` (exclusive). Null and empty texts have no
    words. Rows of one doc_id don't count as earlier than each other, so repeated
    rows keep their words; a row without id comes after all others and stays in the
    result with a null id. No rows give no rows.
    """
    n = pieces(docs, PIECE_BYTES)
    parts = in_pieces(docs, n, "doc_id", "text")

    def send(table: pa.Table) -> pa.Table:
        words = words_of(table.column("text"))
        h, whole, block = _anchors(words, word_hashes(words))
        return key_rows(table.column("piece")[0].as_py(), h[whole], block[whole], n)

    anchors = shared_hashes(parts.groupBy("piece").applyInArrow(send, KEYS))
    prints = parts.groupBy("piece").cogroup(anchors.groupBy("piece")).applyInArrow(_send_prints(n), PRINTS)
    earlier = prints.groupBy("bucket").applyInArrow(_match_prints, EARLIER)
    replies = anchors.withColumn("kind", F.lit(0).cast("long")).unionByName(earlier)
    return parts.groupBy("piece").cogroup(replies.groupBy("piece")).applyInArrow(_remove(n, with_text), OUT)
