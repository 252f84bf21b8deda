import random
import re

from telemill.llm import joining, lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rnd, s, n):
    s = list(s)
    for _ in range(n):
        k = rnd.randrange(len(s) + 1)
        kind = rnd.randrange(3)
        if kind == 0:
            s.insert(k, rnd.choice("abé中 "))
        elif s and kind == 1:
            s.pop(min(k, len(s) - 1))
        elif s:
            s[min(k, len(s) - 1)] = rnd.choice("abé中 ")
    return "".join(s)


def test_banded_distance():
    rnd = random.Random(1)
    for most in (1, 2, 3):
        a = ["".join(rnd.choice("ab中") for _ in range(rnd.randint(0, 30))) for _ in range(1500)]
        b = [edited(rnd, s, rnd.randint(0, 4)) for s in a]
        got = lines.edit_distances(a, b, most).tolist()
        assert [min(x, most + 1) for x in got] == [min(distance(x, y), most + 1) for x, y in zip(a, b)]


def brute(rows):
    split = [[x.strip(" \t\x0b\x0c") for x in re.split("[\n\r]", t or "")] for _, t in rows]
    split = [[x for x in ls if x] for ls in split]
    every = sorted({x for ls in split for x in ls})
    up = {x: x for x in every}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    long = [x for x in every if len(x) >= lines.SHORTEST]
    for k, a in enumerate(long):
        for b in long[:k]:
            if abs(len(a) - len(b)) <= lines.EDITS and distance(a, b) <= lines.EDITS:
                x, y = sorted((root(a), root(b)))
                up[y] = x
    key = lambda i: 2**63 - 1 if i is None else i
    first = {}
    for (i, _), ls in zip(rows, split):
        for p, x in enumerate(ls):
            first[root(x)] = min(first.get(root(x), (2**64, 0)), (key(i), p))
    out = []
    for (i, _), ls in zip(rows, split):
        gone = [p for p, x in enumerate(ls) if first[root(x)] != (key(i), p)]
        out.append((i, len(ls), len(gone), gone))
    return sorted(out, key=str)


def run(docs):
    return sorted([tuple(r) for r in lines.repeated_lines(docs).collect()], key=str)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lines, "PIECE_BYTES", 3_000)
    monkeypatch.setattr(joining, "SHORT_LIST", 4)
    monkeypatch.setattr(joining, "PAIRS_PER_POSTING", 0)
    rnd = random.Random(2)
    base = ["".join(rnd.choice("abcdefghé ") for _ in range(rnd.randint(15, 45))) for _ in range(14)]
    base += [base[0][:25] + "".join(rnd.choice("xyz") for _ in range(20)) for _ in range(6)]
    rows = []
    for i in range(120):
        own = [edited(rnd, rnd.choice(base) if rnd.random() > 0.3 else base[0], rnd.choice((0, 0, 1, 2, 3))) for _ in range(rnd.randint(0, 5))]
        rows.append((rnd.randint(0, 400), rnd.choice(("\n", "\r\n", " \n\n")).join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert run(docs) == want and sum(w[2] for w in want) > 100


def test_odd_rows(spark, odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert run(odd_documents) == brute(rows)
    assert lines.repeated_lines(odd_documents.limit(0)).count() == 0


def test_exact_copies_are_all_found(documents):
    """Without edits brute force is a dictionary, so it can run over the whole table."""
    first, want = {}, set()
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    for i, t in rows:
        for p, x in enumerate([y for y in (z.strip(" \t") for z in re.split("[\n\r]", t)) if y]):
            if first.setdefault(x, (i, p)) != (i, p):
                want.add((i, p))
    got = {(r[0], p) for r in run(documents) for p in r[3]}
    assert want <= got and want


def test_short_lines_have_to_be_equal(spark):
    rows = [(1, "a short line\n}\nanother\n}"), (2, "a short lime\n}\nother"), (3, "another\n a short line \nx"), (None, "x\n}"), (4, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(docs) == brute(rows)
    got = {r.doc_id: r.removed_lines for r in lines.repeated_lines(docs).collect()}
    assert got == {1: [3], 2: [1], 3: [0, 1], 4: [0], None: [0, 1]}
