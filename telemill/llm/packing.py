"""Pack documents into as few sequences as possible, with certified lower bounds.

Documents are tokenized, closed with an end id and, where longer than a sequence, cut
so that only the first piece is shorter than one. Whole pieces are sequences of their
own. The rest is dealt into parts of bounded size, and each part is packed by best-fit
decreasing. Dual-feasible functions of the piece lengths give a lower bound on the
sequences that a part needs: a part that meets its bound can't be packed better and
is certified. Parts with a gap give up all their pieces, certified ones those of
their emptiest sequences, since bounds of parts are each rounded up. These pieces are
exchanged between parts twice as large and packed again, as long as that saves
sequences and a part stays within ``MOST`` pieces.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .exchange import rows_table

TOKENIZER = "byte_bpe_50k.json"
#: Tokens of a sequence, and the id that ends a document.
SEQUENCE, END = 2048, 0
#: Pieces of a part in the first round and at most.
PART, MOST = 4_096, 65_536
#: Sequences, the emptiest ones, that a certified part gives up for exchange.
GIVEN = 16
#: Words held in a task's memory, their longest, and characters tokenized at once.
CACHED, CACHED_LENGTH, STEP = 500_000, 40, 1 << 18
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = "row long, doc_id long, piece int, start long, length long, ids_crc32 long, part long, bin int, offset long, bins long, bound long, given boolean, lead boolean"

_AFTER_SOLID = re.compile(r"(?<=\S) ")
_RUN = re.compile(r"\s\s\s|\s\s\Z")
#: Words whose characters every Unicode version classes alike.
_PLAIN = re.compile("[\n!-~\u00a1-\u017f]+")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: its own if printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _ranked(spec: dict) -> dict[bytes, int] | None:
    """Bytes and ids of a byte-level BPE whose merges come in the order of their ids; None for other models."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    level = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    extra = {t["content"] for t in spec["added_tokens"]}
    if model["type"] != "BPE" or not level or spec.get("normalizer") or any(re.search(r"\s", t) for t in extra):
        return None
    vocab = model["vocab"]
    merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if merged != sorted(merged):
        return None
    letters = _byte_letters()
    return {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in extra}


class Encoder(dict):
    """Ids (unsigned 32-bit, little-endian) that a tokenizer gives to texts.

    A byte-level BPE never joins characters before and after the space that begins a
    word, so its words are looked up one by one and each is tokenized once; words of
    common characters by the same merges in ``tiktoken``, which takes a third of the
    time. Any other tokenizer gets whole texts.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        if not os.path.isabs(path):
            import public_tokenizers

            path = public_tokenizers.path(path)
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.extra = [t["content"] for t in spec["added_tokens"]]
        ranks = _ranked(spec)
        self.by_words = ranks is not None
        if self.by_words:
            import public_tokenizers
            import tiktoken

            self.merges = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        """Ids of a space and the word behind it."""
        if _PLAIN.fullmatch(word) and not any(t in word for t in self.extra):
            ids = array("I", self.merges.encode_ordinary(" " + word)).tobytes()
        else:
            ids = self.encode(" " + word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED:
                self.clear()
            self[word] = ids
        return ids

    def _step(self, text: str) -> bytes:
        """Ids of a text that begins a document, or with a space that follows something solid."""
        words = text.split(" ")
        if _RUN.search(text):  # in longer runs of white space, words stay with what is before them
            joined = [words[0]]
            for w in words[1:]:
                before = joined[-1]
                if (not before or before[-1].isspace()) and (not w or w[0].isspace()):
                    joined[-1] = before + " " + w
                else:
                    joined.append(w)
            words = joined
        first = self.encode(words[0]) if words[0] else b""
        return first + b"".join(map(self.__getitem__, words[1:]))

    def __call__(self, text: str) -> bytes:
        """Ids of a whole text, taken in steps so that memory stays near that of the text."""
        if not self.by_words:
            return self.encode(text)
        out, i = [], 0
        while i < len(text):
            cut = _AFTER_SOLID.search(text, i + STEP) if len(text) - i > 2 * STEP else None
            j = cut.start() if cut else len(text)
            out.append(self._step(text[i:j]))
            i = j
        return b"".join(out)


_ENCODERS: dict[str, Encoder] = {}


def _tokenize(path: str, sequence: int, end: int):
    stop = np.array([end], "<u4").tobytes()

    def run(batches):
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        encoder = _ENCODERS[path]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = encoder(text.as_py() or "") + stop
                n = len(ids) // 4
                edges = [0, *range(n % sequence or sequence, n + 1, sequence)]
                for piece, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    rows.append((doc_id, piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
                if len(rows) >= 50_000:
                    yield from rows_table(rows, PIECES).to_batches()
                    rows = []
            yield from rows_table(rows, PIECES).to_batches()

    return run


def tokenized_pieces(docs: DataFrame, tokenizer: str = TOKENIZER, sequence: int = SEQUENCE, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: a row for each piece of each document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_tokenize(tokenizer, sequence, end), PIECES)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that pieces of these lengths need at least.

    The largest of the sums of: lengths as they are; lengths above ``capacity - k``
    raised to the capacity and those under ``k`` taken as nothing, for every k; and
    lengths rounded to multiples of 1/m of the capacity, for m up to 64. Each is a
    dual-feasible function: no sequence can hold more than the capacity of it.
    """
    if len(lengths) == 0:
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1)
    best = -(-int((counts * sizes).sum()) // capacity)
    k = np.arange(1, capacity // 2 + 1)
    many, mass = np.cumsum(counts), np.cumsum(counts * sizes)
    middle = mass[capacity - k] - mass[k - 1]
    raised = many[capacity] - many[capacity - k]
    best = max(best, int((raised - (-middle // capacity)).max()))
    for m in range(1, 65):
        whole = ((m + 1) * sizes) % capacity == 0
        # in units of capacity * m, so that all values are integers
        value = np.where(whole, sizes * m, ((m + 1) * sizes // capacity) * capacity)
        best = max(best, -(-int((counts * value).sum()) // (capacity * m)))
    return best


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of every length, taken in the order given, and the room left in each bin.

    Bins are held by the room they have left; one integer has a bit for each room that
    occurs, so the tightest bin that fits is found in one step.
    """
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins, offsets, left = 0, [], [], []
    for n in lengths:
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            own = open_[room]
            b = own.pop()
            if not own:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(left)
            left.append(capacity)
        bins.append(b)
        offsets.append(capacity - room)
        room -= n
        left[b] = room
        if not open_[room]:
            rooms |= 1 << room
        open_[room].append(b)
    return bins, offsets, left


def _pack(capacity: int):
    def run(group: pa.Table) -> pa.Table:
        """One part by best-fit decreasing, with its bound."""
        group = group.sort_by([("length", "descending"), ("row", "ascending")])
        lengths = group.column("length").to_numpy()
        bins, offsets, left = best_fit(lengths.tolist(), capacity)
        n = len(lengths)
        bound = lower_bound(lengths, capacity)
        bins = np.array(bins, np.int32)
        given = np.isin(bins, np.argsort(left)[::-1][:GIVEN])
        lead = np.arange(n) == 0
        columns = {
            "bin": pa.array(bins, pa.int32()), "offset": pa.array(offsets, pa.int64()),
            "bins": pa.array(np.full(n, len(left))), "bound": pa.array(np.full(n, bound)),
            "given": pa.array(given), "lead": pa.array(lead),
        }
        names = [f.split()[0] for f in PLACED.split(", ")]
        return pa.table([columns[c] if c in columns else group.column(c) for c in names], names=names)

    return run


def _dealt(pool: DataFrame, n: int, size: int, turn: int, capacity: int) -> DataFrame:
    parts = max(1, -(-n // size))
    part = F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(parts))
    return pool.select("row", "doc_id", "piece", "start", "length", "ids_crc32", part.alias("part")).groupBy("part").applyInArrow(
        _pack(capacity), PLACED
    )


def pack_pieces(pieces: DataFrame, capacity: int = SEQUENCE, part: int = PART, most: int = MOST) -> DataFrame:
    """Place ``pieces`` (as of ``tokenized_pieces``) into sequences.

    Adds sequence_id (any numbers), offset, and certified (the sequence is one of a
    part that meets its lower bound; a whole piece always is). Deterministic but for the
    numbering of rows. No rows give no rows.
    """
    named = materialize(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    whole = named.filter(F.col("length") == capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("row")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified"),
    )
    pool = named.filter(F.col("length") < capacity)
    n, old, size, turn, done, left = pool.count(), None, part, 0, [], None
    while n:
        placed = materialize(_dealt(pool, n, size, turn, capacity).withColumn("turn", F.lit(turn)), "packed")
        now = placed.filter("lead").agg(F.sum("bins")).first()[0]
        if old is not None and now >= old:
            break
        again = (F.col("bins") > F.col("bound")) | F.col("given")
        done.append(placed.filter(~again))
        pool = left = placed.filter(again)
        # every sequence has one piece at its start
        n, old = pool.agg(F.count(F.lit(1)), F.count(F.when(F.col("offset") == 0, True))).first()
        if old <= 1 or size >= most and turn:
            break
        size, turn = min(most, 2 * size), turn + 1
    rows = done + ([left] if left is not None else [])
    out = whole
    for r in rows:
        # turn, part and bin in one number: a part has at most some MOST bins
        number = F.shiftleft(F.col("turn").cast("long"), 56) + F.shiftleft(F.col("part"), 20) + F.col("bin")
        out = out.unionByName(r.select(
            "doc_id", "piece", "start", "length", "ids_crc32", number.alias("sequence_id"), "offset",
            (F.col("bins") == F.col("bound")).alias("certified"),
        ))
    return out


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, sequence: int = SEQUENCE) -> DataFrame:
    """Pack documents (doc_id, text) into sequences of at most ``sequence`` tokens.

    Returns a row for each piece: doc_id, piece (from 0), start (ids of the document
    before it), length, ids_crc32 (of its ids as little-endian unsigned 32-bit numbers),
    sequence_id, offset (gapless from 0 in its sequence) and certified. A null or empty
    text is its end id alone. Rows are documents of their own, also without id or with a
    repeated one. ``tokenizer`` is a file, by its path or by its name among the public
    tokenizers. Other columns are ignored; no rows give no rows.
    """
    return pack_pieces(tokenized_pieces(docs, tokenizer, sequence), sequence)
