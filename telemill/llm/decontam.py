"""Find benchmark items in documents, also with other numbers, names and units.

Words are brought to a template: a word with a digit becomes a number, a unit of
measure after a number a unit, and a capitalised word inside a sentence a name;
other words lose case and outer punctuation. Windows of ``WINDOW`` template words
(whole items where those are shorter) are joined by hash, and so are windows of the
plain words in lower case, whatever they are. A hit is verified word by
word. A window whose words and values are all equal counts whatever stands around it.
Windows with other values have to agree with those and with each other, in the order
of the document: one value of the item always stands for one value of the document.
That tells a question with new values from chance.

The benchmark is taken in blocks of at most ``BLOCK_WORDS`` words. The table of a
block goes to the tasks and all documents are read against it, whatever the size
of either side, without a shuffle. What a block finds is stored before the next one is
read, so the driver holds one block at a time.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .exchange import rows_table
from .mixing import word_count
from .words import U, find, grams, mix, slices, utf8, word_hashes, words_of

WINDOW = 13
#: Words of a window with other values that must be literal, not slots; of a shorter item the same share.
LITERAL = 8
BLOCK_WORDS = 1_000_000
#: Units of measure, in lower case (fixed values).
UNITS = (
    "mm cm dm m km in inch inches ft feet foot yd yards mi mile miles mg g kg t oz lb lbs ml cl l liter liters litre "
    "litres gal gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months "
    "year years hz khz mhz ghz b kb mb gb tb w kw mw v a c f k pa kpa bar usd eur gbp dollar dollars euro euros cent "
    "cents pound pounds percent degree degrees"
).split()
KINDS = ("exact", "reparameterised")
OUT = "doc_id long, item_id long, kind string, n_windows long, first_word long, last_word long, n_slots long, n_changed long"
NUMBER, UNIT, NAME = U(1), U(2), U(3)


@dataclass
class Template:
    words: object  # in lower case
    plain: np.ndarray  # word, by hash
    hashes: np.ndarray  # template word, by hash
    slot: np.ndarray  # 0 literal, 1 number, 2 unit, 3 name


def _unit_hashes() -> np.ndarray:
    w = find(*utf8(pa.array([" ".join(UNITS)])))
    return np.sort(word_hashes(w))


_IS_PUNCT = np.zeros(256, bool)
_IS_PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_IS_DIGIT = np.zeros(256, bool)
_IS_DIGIT[48:58] = True
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?:"]] = True


def _count(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[ends] - sums[starts]


def _core(w):
    """Words without punctuation at either end, all of a word where there is nothing else."""
    solid = np.flatnonzero(~_IS_PUNCT[w.data])
    a = np.searchsorted(solid, w.starts)
    b = np.searchsorted(solid, w.ends) - 1
    some = b >= a
    start, end = w.starts.copy(), w.ends.copy()
    start[some], end[some] = solid[a[some]], solid[b[some]] + 1
    return type(w)(w.data, start, end, w.doc, w.counts)


def template(column) -> Template:
    """Template words of a batch of texts, at the places of their words."""
    w = words_of(column)
    n = len(w.starts)
    if n == 0:
        return Template(w, np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int8))
    low = _core(words_of(pc.utf8_lower(column)))
    core = _core(w)
    start, end = core.starts, core.ends
    hashes = word_hashes(low)
    slot = np.zeros(n, np.int8)
    digit = _count(_IS_DIGIT[w.data], start, end) > 0
    slot[digit] = NUMBER
    units = _unit_hashes()
    at = np.searchsorted(units, hashes)
    at[at == len(units)] = 0
    opens = np.ones(n, bool)  # the first word of a text, line or sentence
    opens[1:] = (w.doc[1:] != w.doc[:-1]) | _ENDS[w.data[w.ends[:-1] - 1]]
    lines = np.cumsum(w.data == 10)
    opens[1:] |= lines[w.starts[1:]] != lines[w.starts[:-1]]
    after = np.zeros(n, bool)
    after[1:] = digit[:-1] & ~opens[1:]
    slot[after & (units[at] == hashes) & ~digit] = UNIT
    first = w.data[start]
    capital = ((first >= 65) & (first <= 90)) | ((first == 0xC3) & (w.data[np.minimum(start + 1, len(w.data) - 1)] < 0x9F))
    slot[capital & ~opens & (slot == 0)] = NAME
    return Template(low, hashes, np.where(slot > 0, slot.astype(np.uint64), hashes), slot)


def _windows(t: Template, size: int, plain: bool) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every window of ``size`` words, of templates only with enough literals."""
    h, whole = grams(t.plain if plain else t.hashes, t.words.doc, size)
    if not len(h):
        return np.zeros(0, np.int64), h
    if not plain:
        literal = np.concatenate([[0], np.cumsum(t.slot == 0)])
        whole = whole & (literal[size:] - literal[: len(literal) - size] >= math.ceil(size * LITERAL / WINDOW))
    at = np.flatnonzero(whole)
    return at, mix(h[at] + U(size))


class Block:
    """Windows of some benchmark items, sorted by hash, with their words."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids = ids
        t = template(pa.array(texts, pa.large_string()))
        self.first = t.words.first
        self.slot = t.slot
        self.text = [bytes(t.words.data[a:b]) for a, b in zip(t.words.starts, t.words.ends, strict=True)]
        self.sizes = sorted({int(min(WINDOW, c)) for c in t.words.counts if c})
        #: Hash, place, size and item of the windows of templates, and of those of plain words.
        self.windows = [self._sorted(t, plain) for plain in (False, True)]

    def _sorted(self, t: Template, plain: bool) -> tuple[np.ndarray, ...]:
        counts = t.words.counts
        hashes, place, size = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n in self.sizes:
            at, h = _windows(t, n, plain)
            keep = counts[t.words.doc[at]] >= WINDOW if n == WINDOW else counts[t.words.doc[at]] == n
            hashes.append(h[keep])
            place.append(at[keep])
            size.append(np.full(int(keep.sum()), n))
        hashes, place, size = np.concatenate(hashes), np.concatenate(place), np.concatenate(size)
        order = np.argsort(hashes, kind="stable")
        return hashes[order], place[order], size[order], np.searchsorted(self.first, place[order], "right") - 1

    def hits(self, column) -> list[tuple]:
        """(row, item, kind, windows, first word, last word, slots, changed) of verified matches."""
        if not self.sizes:
            return []
        return [(i + h[0], *h[1:]) for i, part in slices(column) for h in self._hits(part)]

    def _hits(self, column) -> list[tuple]:
        t = template(column)
        first = t.words.first
        found: dict[tuple[int, int, int], set[tuple[int, int, int]]] = {}
        for n in self.sizes:
            for plain, (hashes, place, size, item) in enumerate(self.windows):
                at, h = _windows(t, n, bool(plain))
                lo, hi = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
                for k in np.flatnonzero(hi > lo).tolist():
                    row = int(t.words.doc[at[k]])
                    for j in range(int(lo[k]), int(hi[k])):
                        if size[j] == n:
                            shift = int(at[k]) - int(place[j])
                            found.setdefault((row, int(item[j]), shift), set()).add((int(at[k]), int(place[j]), n))
        out: dict[tuple[int, int], tuple] = {}
        for (row, i, shift), spans in sorted(found.items()):
            match = self._verify(t, sorted(spans))
            if match is None:
                continue
            windows, words, slots, changed = match
            hit = (windows, -changed, min(words) - int(first[row]), max(words) - int(first[row]), slots)
            if (row, i) not in out or hit[:2] > out[row, i][:2]:
                out[row, i] = hit
        return [(row, self.ids[i], KINDS[h[1] < 0], h[0], h[2], h[3], h[4], -h[1]) for (row, i), h in sorted(out.items())]

    def _verify(self, t: Template, spans):
        """Windows and words of a match: all that are equal, then those whose values agree with the ones before."""
        same, other = [], []
        for at, place, n in spans:
            pairs, equal, ok = [], True, True
            for d in range(n):
                a = bytes(t.words.data[t.words.starts[at + d] : t.words.ends[at + d]])
                b, kind = self.text[place + d], int(self.slot[place + d])
                differs = a != b
                if differs and (kind == 0 or kind != int(t.slot[at + d])):
                    ok = False
                    break
                equal &= not differs
                if kind:
                    pairs.append((b, a, at + d))
            if ok:
                (same if equal else other).append((at, n, pairs))
        there: dict[bytes, bytes] = {}
        words, good, slots = set(), 0, set()
        for at, n, pairs in same + other:
            new: dict[bytes, bytes] = {}
            if any(there.get(b, new.setdefault(b, a)) != a or new[b] != a for b, a, _ in pairs):
                continue
            there |= new
            slots.update(k for _, _, k in pairs)
            good += 1
            words.update(range(at, at + n))
        if not good:
            return None
        return good, words, len(slots), sum(a != b for b, a in there.items())


def blocks(benchmark: DataFrame):
    """Blocks of the benchmark and whether more follow, each read when it is due; rows without id or text are left out."""
    rows = benchmark.filter("item_id is not null and text is not null").select("item_id", "text")
    total = rows.agg(F.sum(word_count(F.col("text")))).first()[0] or 0
    n = max(1, math.ceil(2 * total / BLOCK_WORDS))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        own = sorted({(r["item_id"], r["text"]) for r in rows.filter(part == k).collect()})
        yield Block([i for i, _ in own], [x for _, x in own]), k < n - 1


def find_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for every document and benchmark item that it holds.

    Returns doc_id, item_id, kind (``exact``, or ``reparameterised`` if a slot has
    another value), n_windows, first_word and last_word (where in the document),
    n_slots and n_changed (values of the item that differ). Null and empty texts hold
    nothing and match nothing; items whose windows are mostly slots can't be told
    apart with other values and match only as they are. Case doesn't count. Rows of ``docs`` are judged one by one, a null id
    included; of an item that a document holds more than once, its longest match is
    given. Other columns are ignored. No documents or no items give no rows.
    """
    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for block, more in blocks(benchmark):
        def run(batches, block=block):
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                rows = [(ids[h[0]], *h[1:]) for h in block.hits(batch.column("text"))]
                yield from rows_table(rows, OUT).to_batches()

        found = ready.mapInArrow(run, OUT)
        found = materialize(found, "block-items") if more else found
        out = found if out is None else out.unionByName(found)
        del block, run
    return out


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that hold no benchmark item."""
    for block, more in blocks(benchmark):
        def run(batches, block=block):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for hit in block.hits(batch.column("text")):
                    keep[hit[0]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
        docs = materialize(docs, "block-clean") if more else docs
        del block, run
    return docs
