"""The audit against a plain loop over documents and orders."""

import re
from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest

from telemill.llm import audit

LABELS = "doc_id long, quality int, toxic int"


def brute(rows, labels):
    """rows: (doc_id, text, part)."""
    least, out = {}, {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    fails = []
    for i, t, part in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        own = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and least[t] < i,
        }
        fails.append((part or "", {f for f, x in own.items() if x}, i in good and i is not None, i in toxic and i is not None))
    for part in {p for p, *_ in fails}:
        own = [r for r in fails if r[0] == part]
        total = defaultdict(int)
        for order in permutations("ABCDE"):
            there = own
            for step, f in enumerate(order, 1):
                gone = [r for r in there if f in r[1]]
                kept = [r for r in there if f not in r[1]]
                all_failing = sum(f in r[1] for r in own)
                out[part, "".join(order), step] = [
                    len(kept), len(gone), all_failing - len(gone), sum(r[1] == {f} for r in own),
                    sum(r[2] for r in gone), sum(r[3] for r in gone), f,
                ]
                total[f] += len(gone)
                there = kept
        for key in out:
            if key[0] == part:
                out[key][-1] = total[out[key][-1]]
    return {k: tuple(v) for k, v in out.items()}


def run(docs, labels):
    got = audit.audit_documents(docs, labels).collect()
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got}
    assert len(out) == len(got)
    return out


def test_documents(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    want = brute([(r.doc_id, r.text, r.lang) for r in documents.collect()], [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert run(documents, labels) == want


def test_odd_rows(spark, odd_documents):
    labels = [(1, 1, None), (3, 0, 1), (3, 1, 0), (4, None, None), (None, 1, 1), (5, 1, 1)]
    frame = spark.createDataFrame(labels, LABELS)
    rows = [(r.doc_id, r.text, r.lang) for r in odd_documents.collect()]
    assert run(odd_documents, frame) == brute(rows, labels)
    assert run(odd_documents.limit(0), frame) == {}
    assert run(odd_documents, frame.limit(0)) == brute(rows, [])


def test_every_mask(spark):
    """All 32 masks, repeated so that a count doesn't fit the bits of a small field."""
    long = " ".join(f"w{i}" for i in range(250))
    rows, i = [], 0
    for mask in range(16):
        text = "" if mask & 1 else long
        text = " ".join(["w"] * (50 if mask & 1 else 900)) if mask & 2 else text or "two words"
        text += " " + "A" * 2_000 if mask & 4 else ""
        text += " $" if mask & 8 else ""
        for _ in range(2 + mask):
            rows.append((i := i + 1, text, "x" if i % 3 else None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = run(docs, spark.createDataFrame([], LABELS))
    assert got == brute(rows, [])
    found = {r.mask for r in audit.masks(docs, spark.createDataFrame([], LABELS)).select("mask").distinct().collect()}
    assert found == set(range(32))


@pytest.mark.parametrize("code", [0, 1, 9, 22, 31])
def test_fields_hold_large_counts(code):
    """Fields don't run over: any count up to 2^63 comes back."""
    n = (1 << 62) + 12_345
    whole = audit._bytes(n * audit.packed(code, True, False))
    assert (audit.unpacked(whole) == n * audit.unpacked(audit._bytes(audit.packed(code, True, False)))).all()
    kept, removed, redundant, good, toxic = audit.unpacked(audit._bytes(audit.packed(code, True, False)))
    fails = np.array([[code >> "ABCDE".index(f) & 1 for f in o] for o in audit.ORDERS])
    assert (removed + redundant == fails).all() and (good == removed).all() and not toxic.any()
    assert (removed.sum(axis=1) == (code > 0)).all() and (kept[:, -1] == (code == 0)).all()


def test_many_parts(spark, monkeypatch):
    """More parts than a task holds at a time."""
    monkeypatch.setattr(audit, "HELD", 3)
    rows = [(i, "some text" if i % 2 else "OTHER", f"p{i % 11}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(2)
    assert run(docs, spark.createDataFrame([], LABELS)) == brute(rows, [])
