"""Remove lines that an earlier document has already, up to a few edits.

Segment-partition join. If two lines are at most ``EDITS`` edits apart, one of
``EDITS + 1`` segments of the shorter stands unchanged in the longer, near its own
place. Every line indexes its segments by (length, number, content) and probes with
those substrings of its own that could be a segment of a line of its length or up to
``EDITS`` shorter. What meets is verified with a bit-parallel edit distance in a band
of ``2 * EDITS + 1`` diagonals, many pairs at once.

Keys that no other line shares are sorted out by ``exchange`` before any line is
moved; equal lines are one line from then on. Lines too short for edits have one key, their
whole content, and are compared by equality.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .exchange import KEYS, among, hot_of, key_rows, shared_hashes
from .joining import linked
from .tables import in_pieces, join_spread, pieces, ships_package
from .words import U, find, mix, utf8, word_hashes

EDITS = 2
#: Shorter lines, in characters, have to be equal.
SHORTEST = 20
PIECE_BYTES = 5_000_000
BREAK = np.zeros(256, bool)
BREAK[[0x0A, 0x0D]] = True
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0B, 0x0C]] = True
FOUND = "row long, doc_id long, n_lines long, places array<int>, ids array<long>, line_id long, line string, keys binary, marks binary"
POSTINGS = "token long, rep long, n long, rank long, marked boolean, counts array<int>"
#: Groups of characters that are counted; an edit moves two counts by one at most.
COUNTED = 24
#: Characters and columns that one verification step holds.
STEP_CELLS = 4_000_000


class Lines:
    """Non-empty lines of a batch of texts, without white space at either end."""

    def __init__(self, column):
        data, offsets = utf8(column)
        self.w = w = find(data, offsets, BREAK)
        solid = np.flatnonzero(~(SPACE | BREAK)[data])
        a, b = np.searchsorted(solid, w.starts), np.searchsorted(solid, w.ends) - 1
        keep = b >= a
        start, end = solid[a[keep]], solid[b[keep]] + 1
        doc = w.doc[keep]
        self.counts = np.bincount(doc, minlength=len(offsets) - 1)
        self.place = np.arange(len(doc)) - np.repeat(np.cumsum(self.counts) - self.counts, self.counts)
        whole = type(w)(data, start, end, doc, self.counts)
        # two hashes make the id of a line: 63 bits
        self.ids = ((word_hashes(whole) ^ (word_hashes(whole, salt=1) >> U(7))) >> U(1)).view(np.int64)
        heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        self.size = heads[end] - heads[start]
        self.data, self.start, self.end, self.doc = data, start, end, doc

    def distinct(self) -> np.ndarray:
        """One place of every different line that is long enough."""
        long = np.flatnonzero(self.size >= SHORTEST)
        return long[np.unique(self.ids[long], return_index=True)[1]]

    def short(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids and keys of every different shorter line."""
        ids = np.unique(self.ids[self.size < SHORTEST])
        return ids, mix(ids.view(np.uint64) + U(0x2545F4914F6CDD1D))


def line_keys(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, line and whether it is an index key, of all lines, about a MB of them at a time."""
    out, i, held = [], 0, 0
    for j, x in enumerate(raw):
        held += len(x)
        if held >= 1 << 20 or j == len(raw) - 1:
            keys, of, marks = _keys(raw[i : j + 1])
            out.append((keys, of + i, marks))
            i, held = j + 1, 0
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _keys(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys of all segments and probes of some lines."""
    chars = [np.frombuffer(x.decode().encode("utf-32-le"), np.uint32) for x in raw]
    size = np.array([len(x) for x in chars], np.int64)
    first = np.cumsum(size) - size
    base = U(0x9E3779B97F4A7C15)
    n = int(size.max(initial=0))
    up, down = np.full(n + 1, base), np.full(n + 1, U(pow(int(base), -1, 2**64)))
    for x in (up, down):
        x[0] = 1
        np.cumprod(x, out=x)
    text = np.concatenate(chars) if chars else np.zeros(0, np.uint32)
    at = np.arange(len(text)) - np.repeat(first, size)
    # sums run over all lines; differences inside a line don't depend on what came before
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(text.astype(np.uint64) + U(1)) * up[at])])
    keys, lines, marks = [], [], []

    def add(length, number, start, width, ok, marked):
        i = np.flatnonzero(ok)
        s, e = first[i] + start[i], first[i] + start[i] + width[i]
        h = (sums[e] - sums[s]) * down[start[i]]
        keys.append(mix(h + U(0xD6E8FEB86659FD93) * (length[i].astype(np.uint64) * U(64) + U(number))))
        lines.append(i)
        marks.append(np.full(len(i), marked))

    parts = EDITS + 1
    for apart in range(EDITS + 1):
        length = size - apart  # of the line whose segments are met
        short, extra = length // parts, length % parts
        for i in range(parts):
            # the last ``extra`` segments are one longer
            width = short + (i >= parts - extra)
            place = i * short + np.maximum(0, i - (parts - extra))
            if apart == 0:
                add(length, i, place, width, width > 0, True)
            left, right = i, parts - 1 - i
            for shift in range(-EDITS, EDITS + 1):
                if abs(shift) > left or abs(shift - apart) > right or (apart == 0 and shift == 0):
                    continue
                start = place + shift
                add(length, i, start, width, (width > 0) & (start >= 0) & (start + width <= size) & (length >= SHORTEST), False)
    return np.concatenate(keys), np.concatenate(lines), np.concatenate(marks)


def edit_distances(a: list[str], b: list[str], most: int = EDITS) -> np.ndarray:
    """Edit distance of pairs of lines, exact up to ``most`` and larger beyond it.

    Column by column, the differences of neighbouring cells in the band are bits of a
    word per pair, and all pairs move on together.
    """
    n = len(a)
    out = np.full(n, most + 1, np.int64)
    x = [np.frombuffer(s.encode("utf-32-le"), np.uint32) for s in a]
    y = [np.frombuffer(s.encode("utf-32-le"), np.uint32) for s in b]
    x, y = [p if len(p) >= len(q) else q for p, q in zip(x, y, strict=True)], [q if len(p) >= len(q) else p for p, q in zip(x, y, strict=True)]
    m, w = np.array([len(p) for p in x], np.int64), np.array([len(q) for q in y], np.int64)
    order = np.argsort(w, kind="stable")
    order = order[(m - w)[order] <= most]
    i = 0
    while i < len(order):
        j = i + 1
        while j < len(order) and (j - i + 1) * (int(w[order[j]]) + 2 * most + 1) <= STEP_CELLS:
            j += 1
        part = order[i:j]
        out[part] = _banded([x[k] for k in part], [y[k] for k in part], m[part], w[part], most)
        i = j
    return out


def _banded(x, y, m, w, most):
    band = 2 * most + 1
    ones = np.int64((1 << band) - 1)
    columns = int(w.max(initial=0))
    rows = np.zeros((columns + 2 * most + 1, len(x)), np.int64)  # 0 matches nothing; row r is at r + most
    text = np.full((columns, len(x)), -1, np.int64)
    for k, (p, q) in enumerate(zip(x, y, strict=True)):
        rows[most + 1 : most + 1 + len(p), k] = p[: columns + most].astype(np.int64) + 1
        text[: len(q), k] = q.astype(np.int64) + 1
    # bit k of column j stands for row j - most + k; rows up from 1 grow by one at the start
    vp = np.full(len(x), ones & ~np.int64((1 << most) - 1))
    vn = np.zeros(len(x), np.int64)
    distance = np.zeros(len(x), np.int64)
    final = np.where(w == 0, m, most + 1)
    for j in range(1, columns + 1):
        equal = np.zeros(len(x), np.int64)
        for k in range(band):
            equal |= (rows[j + k] == text[j - 1]).astype(np.int64) << k
        d0 = ((((equal & vp) + vp) ^ vp) | equal | vn) & ones
        hp = (vn | ~(d0 | vp)) & ones
        hn = d0 & vp
        distance += 1 - ((d0 >> most) & 1)
        vp = (hn | ~((d0 >> 1) | hp)) & ones
        vn = (d0 >> 1) & hp
        done = np.flatnonzero(w == j)
        if len(done):
            more = ((np.int64(1) << (m - w)[done]) - 1) << most
            bits = np.bitwise_count(vp[done] & more).astype(np.int64) - np.bitwise_count(vn[done] & more)
            final[done] = distance[done] + bits
    return final


def _verify_batches(batches):
    for batch in batches:
        x, y = batch.column("xa").to_pylist(), batch.column("xb").to_pylist()
        yield batch.select(["a", "b"]).filter(pa.array(edit_distances(x, y) <= EDITS))


def _send(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        lines = Lines(table.column("text"))
        own = lines.distinct()
        keys, _, marks = line_keys([bytes(lines.data[lines.start[i] : lines.end[i]]) for i in own])
        _, short = lines.short()
        keys, marks = np.concatenate([keys, short]), np.concatenate([marks, np.ones(len(short), bool)])
        return key_rows(table.column("piece")[0].as_py(), keys, marks, buckets)

    return run


def _find(buckets: int):
    def run(key, table: pa.Table, replies: pa.Table) -> pa.Table:
        lines = Lines(table.column("text"))
        own = lines.distinct()
        raw = [bytes(lines.data[lines.start[i] : lines.end[i]]) for i in own]
        keys, of, marks = line_keys(raw)
        ids, short = lines.short()
        hot = hot_of(replies, np.concatenate([keys, short]), buckets)
        hit = among(hot, keys)
        rows = []
        wanted = set(ids[among(hot, short)].tolist())
        order = np.flatnonzero(hit)[np.argsort(of[hit], kind="stable")]
        edges = np.searchsorted(of[order], np.arange(len(own) + 1))
        for k in range(len(own)):
            mine = order[edges[k] : edges[k + 1]]
            if len(mine):
                line_id = int(lines.ids[own[k]])
                wanted.add(line_id)
                rows.append((None, None, None, None, None, line_id, raw[k].decode(), keys[mine].tobytes(), np.packbits(marks[mine]).tobytes()))
        # lines that come twice in this piece count even without a partner elsewhere
        twice, n = np.unique(lines.ids, return_counts=True)
        wanted |= set(twice[n > 1].tolist())
        first = np.concatenate([[0], np.cumsum(lines.counts)])
        for r, doc_id in enumerate(table.column("doc_id").to_pylist()):
            span = slice(int(first[r]), int(first[r + 1]))
            both = [(p, i) for p, i in zip(lines.place[span].tolist(), lines.ids[span].tolist(), strict=True) if i in wanted]
            rows.append(((key[0].as_py() << 40) + r, doc_id, int(lines.counts[r]), [p for p, _ in both], [i for _, i in both], None, None, None, None))
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in range(9)]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64(), pa.string(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[f.split()[0] for f in FOUND.split(", ")])

    return run


def _post(batches):
    """A posting for each key that a line shares, with counts of its characters by group."""
    for batch in batches:
        rows = []
        t = batch.to_pydict()
        for line_id, n, line, raw, marks in zip(*(t[c] for c in ("line_id", "n", "line", "keys", "marks")), strict=True):
            keys = np.frombuffer(raw, np.int64)
            flags = np.unpackbits(np.frombuffer(marks, np.uint8), count=len(keys)).astype(bool)
            chars = np.frombuffer(line.encode("utf-32-le"), np.uint32)
            counts = np.bincount(chars % COUNTED, minlength=COUNTED).tolist()
            rows += [(k, line_id, n, n, f, counts) for k, f in dict(sorted(zip(keys.tolist(), flags.tolist(), strict=True))).items()]
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in range(6)]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int32())]
        names = [f.split()[0] for f in POSTINGS.split(", ")]
        yield from pa.table([pa.array(c, k) for c, k in zip(columns, types, strict=True)], names=names).to_batches()


@ships_package
def repeated_lines(docs: DataFrame) -> DataFrame:
    """Lines of every document that an earlier place has already, up to ``EDITS`` edits.

    Lines end at line feed or carriage return; white space at either end and empty
    lines don't count. Lines of ``SHORTEST`` characters or more that chains of at most
    ``EDITS`` edits (insert, delete, replace one character) connect are one group, and so are
    equal shorter lines; a group's line in the smallest doc_id, there the first, stays
    and all others go. ``docs``: ``doc_id`` (integer), ``text``; other columns are
    ignored. Returns doc_id, n_lines, n_removed, removed_lines (numbers from 0 among
    the lines that count), a row for each row. A null id comes last; rows of one
    doc_id are the same document, so a line stays in all or none of them. Null and
    empty texts have no lines; no rows give no rows.
    """
    n = pieces(docs, PIECE_BYTES)
    parts = in_pieces(docs, n, "doc_id", "text")
    replies = shared_hashes(parts.groupBy("piece").applyInArrow(_send(n), KEYS))
    found = materialize(parts.groupBy("piece").cogroup(replies.groupBy("piece")).applyInArrow(_find(n), FOUND), "found-lines")
    lines = found.filter("line_id is not null").groupBy("line_id").agg(
        F.first("line").alias("line"), F.first("keys").alias("keys"), F.first("marks").alias("marks")
    )
    lines = materialize(lines.withColumn("n", F.length("line").cast("long")), "lines")
    postings = lines.select("line_id", "n", "line", "keys", "marks").mapInArrow(_post, POSTINGS)

    def verify(pairs: DataFrame) -> DataFrame:
        x = lines.select(F.col("line_id").alias("a"), F.col("line").alias("xa"))
        y = lines.select(F.col("line_id").alias("b"), F.col("line").alias("xb"))
        return pairs.join(x, "a").join(y, "b").select("a", "b", "xa", "xb").mapInArrow(_verify_batches, "a long, b long")

    def meet(met: DataFrame) -> DataFrame:
        apart = F.aggregate(F.zip_with("counts", "counts_x", lambda a, b: F.abs(a - b)), F.lit(0), lambda acc, d: acc + d)
        return met.filter(F.expr("marked or marked_x") & (apart <= 2 * EDITS)).select(F.greatest("rep", "rep_x").alias("a"), F.least("rep", "rep_x").alias("b")).distinct()

    groups = linked(postings, verify, lambda a, b: F.abs(a - b) <= EDITS, meet)
    rows = found.filter("row is not null").select("row", "doc_id", "n_lines", "places", "ids")
    places = rows.select("row", F.coalesce("doc_id", F.lit(2**63 - 1)).alias("key"), F.explode(F.arrays_zip("places", "ids")).alias("p")).select(
        "row", "key", F.col("p.places").alias("place"), F.col("p.ids").alias("line_id")
    )
    named = places.join(groups.select(F.col("node").alias("line_id"), "component"), "line_id", "left").withColumn(
        "group", F.coalesce("component", "line_id")
    )
    named = materialize(named.select("row", "key", "place", "group"), "named-lines")
    keeper = named.groupBy("group").agg(F.min(F.struct("key", "place")).alias("first"), F.count(F.lit(1)).alias("many"))
    gone = join_spread(named, materialize(keeper, "keepers"), "group", "many").filter(
        (F.col("key") != F.col("first.key")) | (F.col("place") != F.col("first.place"))
    )
    removed = gone.groupBy("row").agg(F.array_sort(F.collect_list("place")).alias("removed_lines"))
    out = rows.drop("places", "ids").join(removed, "row", "left")
    none = F.array().cast("array<int>")
    return out.select(
        "doc_id", "n_lines", F.coalesce(F.size("removed_lines"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed_lines", none).alias("removed_lines"),
    )
