"""How filters overlap: what every order of a set of filters removes at every step.

A document fails some of the filters; which ones is its mask. A mask decides what
becomes of the document in all orders, so it has one large integer with a field for
every order, step and counter, wide enough for any count. Integers are
added up per part of the corpus, first within a task, and the sums are cut into their
fields at the end. Nothing is joined or counted per order.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .exchange import rows_table
from .tables import WORD

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: Counters of each order and step: what is kept, removed, redundant; removed documents of good quality, and toxic ones.
COUNTERS = 5
#: Bits of a field. No count of rows reaches 2^64, so a field never runs over into the next.
WIDTH = 64
#: Sums that a task holds at a time, and groups in which the sums of all tasks are first added.
HELD, GROUPS = 500, 64
MASKED = "part string, mask int, good boolean, toxic boolean"
SUMS = "part string, salt int, total binary"
OUT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def packed(mask: int, good: bool, toxic: bool) -> int:
    """The integer of a document: its 1s in the fields of all 600 steps."""
    fields = np.zeros((COUNTERS, len(ORDERS), len(FILTERS)), "<u8")
    for o, order in enumerate(ORDERS):
        there = True
        for s, letter in enumerate(order):
            fails = mask >> FILTERS.index(letter) & 1
            fields[1, o, s] = there and fails
            fields[2, o, s] = fails and not there
            there = there and not fails
            fields[0, o, s] = there
    fields[3] = fields[1] * good
    fields[4] = fields[1] * toxic
    return int.from_bytes(fields.tobytes(), "little")


def unpacked(total: bytes) -> np.ndarray:
    """Fields of a sum: counter, order, step."""
    return np.frombuffer(total, "<u8").reshape(COUNTERS, len(ORDERS), len(FILTERS)).astype(np.int64)


def _bytes(total: int) -> bytes:
    return total.to_bytes(COUNTERS * len(ORDERS) * len(FILTERS) * WIDTH // 8, "little")


def _add(salt: int):
    """Integers of rows added up by part, within a task."""

    def run(batches):
        at = np.random.default_rng().integers(salt)  # sums are the same wherever they are added
        own: dict[int, int] = {}
        totals: dict[str, int] = {}
        for batch in batches:
            part = batch.column("part").dictionary_encode()
            code = batch.column("mask").to_numpy() + 32 * batch.column("good").cast(pa.int32()).to_numpy() + 64 * batch.column("toxic").cast(pa.int32()).to_numpy()
            both, n = np.unique(part.indices.to_numpy().astype(np.int64) * 128 + code, return_counts=True)
            names = part.dictionary.to_pylist()
            for key, many in zip(both.tolist(), n.tolist(), strict=True):
                code = key % 128
                if code not in own:
                    own[code] = packed(code & 31, bool(code & 32), bool(code & 64))
                name = names[key // 128]
                totals[name] = totals.get(name, 0) + many * own[code]
            if len(totals) > HELD:
                yield from rows_table([(p, int(at), _bytes(t)) for p, t in totals.items()], SUMS).to_batches()
                totals = {}
        yield from rows_table([(p, int(at), _bytes(t)) for p, t in totals.items()], SUMS).to_batches()

    return run


def _total(batches) -> dict[str, int]:
    out: dict[str, int] = {}
    for batch in batches:
        for part, total in zip(batch.column("part").to_pylist(), batch.column("total").to_pylist(), strict=True):
            out[part] = out.get(part, 0) + int.from_bytes(total, "little")
    return out


def _merge(group: pa.Table) -> pa.Table:
    return rows_table([(p, 0, _bytes(t)) for p, t in _total(group.to_batches()).items()], SUMS)


def _report(group: pa.Table) -> pa.Table:
    """The 600 rows of one part from its sum."""
    (part, total), = _total(group.to_batches()).items()
    kept, removed, redundant, good, toxic = unpacked(_bytes(total))
    # what a filter removes wherever it stands, and what only it fails: removed when it comes last
    shapley = {f: sum(int(removed[o, order.index(f)]) for o, order in enumerate(ORDERS)) for f in FILTERS}
    alone = {f: int(removed[next(o for o, order in enumerate(ORDERS) if order[-1] == f), -1]) for f in FILTERS}
    rows = []
    for o, order in enumerate(ORDERS):
        for s, f in enumerate(order):
            rows.append((
                part, order, s + 1, int(kept[o, s]), int(removed[o, s]), int(redundant[o, s]), alone[f],
                int(good[o, s]), int(toxic[o, s]), shapley[f],
            ))
    return rows_table(rows, OUT)


def audit(masks: DataFrame) -> DataFrame:
    """Every order and step of every part from ``masks`` (part, mask, good, toxic), a row for each document.

    ``mask`` has bit i set where the filter of the i-th letter fails. Sums of tasks are
    added in ``GROUPS`` groups of a part first, so a part of any size, and any number of
    tasks, is spread.
    """
    sums = masks.mapInArrow(_add(GROUPS), SUMS)
    once = sums.groupBy("part", "salt").applyInArrow(_merge, SUMS)
    return once.groupBy("part").applyInArrow(_report, OUT)


def text_failures(text) -> list:
    """Conditions A to D on a text (null: empty)."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    n = F.size(words)
    return [
        n < 200,
        F.size(F.array_distinct(words)) * 100 < n * 50,
        capitals.cast("long") * 100 > F.char_length(text).cast("long") * 3,
        text.rlike(r"[#$%&*|]"),
    ]


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, good, toxic of every document.

    A text is repeated (E) if a row with a smaller doc_id has the same, so of equal texts
    those of the smallest id pass. That id is found by a hash of the text; it is joined by
    text and id together, so a text that fills the corpus isn't one key.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    flags = text_failures(F.col("text"))
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(flags[1:], 1)), F.when(flags[0], 1).otherwise(0))
    rows = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
            F.unhex(F.sha2(text, 256)).alias("same"), mask.alias("mask"),
        ),
        "audit-rows",
    )
    named = rows.filter("doc_id is not null")
    first = named.groupBy("same").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    judged = named.join(first, ["same", "doc_id"], "left").join(known, "doc_id", "left")
    repeated = F.when(F.col("first"), 0).otherwise(1 << FILTERS.index("E"))
    judged = judged.select(
        "part", (F.col("mask") + repeated).alias("mask"),
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )
    # rows without id repeat nothing that counts and have no label
    rest = rows.filter("doc_id is null").select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    return judged.unionByName(rest)


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Audit five filters over documents (doc_id, text, lang) with labels (doc_id, quality, toxic).

    A: under 200 words. B: 100 * distinct words < 50 * words. C: 100 * ``[A-Z]``
    characters > 3 * code points. D: holds any of ``#$%&*|``. E: the text of a row with a
    smaller doc_id. Returns, for each part (lang; null: empty string), order and
    step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.
    A null text is empty. A row without id is never E, makes no other row E, and has no
    label. Rows of one id and text pass or fail E together. Of several labels of an id any 1
    counts. Null labels are 0. Other columns are ignored; no rows give no parts.
    """
    return audit(masks(docs, labels))
