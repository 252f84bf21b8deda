import random
import re

from telemill.llm import jaccard, joining

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """(doc_id, n_shingles, component_id) from all pairs."""
    sets = []
    for i, t in rows:
        w = [x.translate(LOWER) for x in WORD.findall(t or "")]
        sets.append((i, {tuple(w[a : a + 5]) for a in range(max(1, len(w) - 4))} if w else set()))
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 7 * len(a & b) >= 3 * (len(a) + len(b)):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return sorted([(i, len(a), None if i is None else root(i)) for i, a in sets], key=str)


def run(docs):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_documents(docs).collect()], key=str)


def test_against_brute_force(documents):
    want = brute([(r.doc_id, r.text) for r in documents.collect()])
    assert run(documents) == want and any(a != c for a, _, c in want)


def test_groups_of_near_copies_in_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PIECE_BYTES", 4_000)
    monkeypatch.setattr(joining, "SHORT_LIST", 4)
    monkeypatch.setattr(joining, "PAIRS_PER_POSTING", 0)
    rnd = random.Random(5)
    bases = [[f"{b}{rnd.randint(0, 10**6)}" for _ in range(rnd.choice((3, 5, 9, 30, 60)))] for b in "abcdefghij"]
    rows = []
    for i in range(260):
        w = list(bases[0] if i % 3 == 0 else rnd.choice(bases))
        for _ in range(rnd.choice((0, 0, 1, 1, 2, 3))):
            w[rnd.randrange(len(w))] = rnd.choice(("X", "y", str(rnd.randint(0, 9))))
        rows.append((1000 - i, " ".join(w) + rnd.choice(("", "\n", " tail"))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(docs) == brute(rows)


def test_odd_rows(odd_documents, spark):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert run(odd_documents) == brute(rows)
    assert jaccard.similar_documents(odd_documents.limit(0)).count() == 0
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    same_id = [(7, a), (7, b), (3, a), (9, b), (8, "alone"), (7, "also alone"), (7, None)]
    docs = spark.createDataFrame(same_id, "doc_id long, text string")
    assert run(docs) == brute(same_id)


def test_every_extension_keeps_a_match():
    """Whatever length two similar sets choose, their prefixes share enough."""
    rnd = random.Random(1)
    for _ in range(3000):
        n = rnd.randint(1, 40)
        a = set(rnd.sample(range(60), n))
        b = {x if rnd.random() > 0.1 else rnd.randint(0, 60) for x in a}
        if 7 * len(a & b) < 3 * (len(a) + len(b)):
            continue
        la, lb = rnd.randint(1, 8), rnd.randint(1, 8)
        pre = [sorted(s)[: len(s) - jaccard.needed(len(s)) + x] for s, x in ((a, la), (b, lb))]
        assert len(set(pre[0]) & set(pre[1])) >= min(la, lb, len(a & b))
