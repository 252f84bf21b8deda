import hashlib
import re

from telemill.llm import substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """{(doc_id, n_words, n_removed, sha)} from a dictionary of all windows."""
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    least = {}
    for i, w in words:
        key = float("inf") if i is None else i
        for a in range(len(w) - 12):
            k = tuple(w[a : a + 13])
            least[k] = min(least.get(k, key), key)
    out = []
    for i, w in words:
        key = float("inf") if i is None else i
        gone = [False] * len(w)
        for a in range(len(w) - 12):
            if least[tuple(w[a : a + 13])] < key:
                gone[a : a + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def run(docs):
    got = substring.remove_repeats(docs).collect()
    for r in got:
        spans = list(zip(r.repeat_starts, r.repeat_ends))
        assert sum(b - a for a, b in spans) == r.n_removed and all(b - a >= 13 for a, b in spans)
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256
    return sorted([tuple(r)[:4] for r in got], key=str)


def test_against_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = brute(rows)
    assert run(documents) == want and sum(w[2] for w in want) > 0


def test_small_pieces_and_planted_passages(spark, monkeypatch):
    import random

    monkeypatch.setattr(substring, "PIECE_BYTES", 2_000)
    rnd = random.Random(3)
    word = lambda: rnd.choice("abcdefgh") * rnd.randint(1, 3)
    passages = [[word() for _ in range(rnd.choice((12, 13, 14, 20, 60)))] for _ in range(8)]
    rows = []
    for i in range(150):
        w = [word() + str(rnd.randint(0, 40)) for _ in range(rnd.randint(0, 40))]
        for _ in range(rnd.randint(0, 2)):
            at = rnd.randint(0, len(w))
            w[at:at] = rnd.choice(passages)
        rows.append((rnd.randint(-50, 300), rnd.choice(" \n\t").join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(docs) == brute(rows)


def test_odd_rows(odd_documents, spark):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert run(odd_documents) == brute(rows)
    assert substring.remove_repeats(odd_documents.limit(0)).count() == 0
