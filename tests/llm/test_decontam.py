import gc
import weakref

from telemill.llm import decontam

ITEM = "On Monday the farmer Smith sold 12 kg of apples and 7 boxes of pears to his friend Jones for 90 dollars before noon."


def run(spark, docs, items=((1, ITEM),)):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.kind for r in decontam.find_items(d, b).collect()}
    kept = {r.doc_id for r in decontam.keep_uncontaminated(d, b).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in got}
    return got


def test_slots(spark):
    other = ITEM.replace("12", "31").replace("Smith", "Weber").replace("90", "55").replace("kg", "lb")
    mixed = "Weber sold 12 kg of plums and 7 boxes of pears to his friend Weber for 90 dollars"
    same_value = ITEM.replace("12", "7")  # two values of the item can't both be 7
    near = ITEM.replace("apples", "plums").replace("friend", "aunt")
    got = run(spark, [(1, "Intro. " + ITEM + " End."), (2, other.lower().replace("weber", "Weber").replace("jones", "Jones").replace("on monday", "On Monday")),
                      (3, mixed), (4, same_value), (5, near), (6, None), (7, ""), (8, "x " + ITEM.upper())])
    # 4: the words behind the changed value make whole windows; 8: equal words in any case
    assert got == {(1, 1): "exact", (2, 1): "reparameterised", (4, 1): "reparameterised", (8, 1): "exact"}


def test_inconsistent_slots(spark):
    item = "the train leaves at 8 and the bus leaves at 8 so both of them leave at 8 in the morning"
    good, bad = item.replace("8", "9"), item.replace("8", "9", 1)
    # the bad one still holds 16 words of the item as they are
    assert run(spark, [(1, good), (2, bad)], [(5, item)]) == {(1, 5): "reparameterised", (2, 5): "exact"}
    short = bad.rsplit(" ", 6)[0]
    assert run(spark, [(2, short.replace("leaves at 8 and", "stops at 8 and"))], [(5, item)]) == {}


def test_conflicting_values_leave_the_rest(spark):
    """A value that disagrees takes only its own windows away; values may become equal."""
    item = "the train leaves at 8 and the bus leaves at 8 so both of them leave at 8 in the morning"
    docs = [(1, item.replace("8", "9", 1)), (2, ITEM.replace("12", "7")), (3, item.replace("leave at 8", "leave at 7").replace("8", "9", 1).replace("8", "6"))]
    assert run(spark, docs, [(5, item), (6, ITEM)]) == {(1, 5): "exact", (2, 6): "reparameterised"}
    two = "a farmer sold 12 of the apples and 7 of the pears to his friend"
    assert run(spark, [(1, two.replace("12", "4").replace("7", "4"))], [(1, two)]) == {(1, 1): "reparameterised"}


def test_exact_copies_of_any_words(spark):
    """Names, numbers, capitals and what stands before a copy don't hide it."""
    items = [
        (1, "Anna Berta Clara Dora Emil Frieda Gustav Heinrich Ida Julius Konrad Ludwig Martha Nordpol"),
        (2, "3 + 4 = 7 and 12 - 5 = 7 but 2 * 9 = 18"),
        (3, "Früh am Morgen ÜBT Jörg seine Übungen für den großen Auftritt in Köln"),
        (4, "Which of the two boys has more of the red marbles now"),
    ]
    docs = [(i, f"Then they asked: {x} - so it went") for i, x in items] + [(10 + i, f"x {x.upper()} x") for i, x in items[:2] + items[3:]]
    docs += [(23, "x früh am Morgen übt Jörg seine übungen FÜR den großen Auftritt in Köln."), (34, "He asked Which of the two boys\nhas more of the red marbles now")]
    got = run(spark, docs, items)
    assert got == {(i, i % 10): "exact" for i, _ in docs}
    assert run(spark, [(1, items[0][1].replace("Ida", "Ina")[:60]), (2, items[1][1].replace("12", "13"))], items) == {}


def test_short_items_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 20)
    items = [(i, " ".join(f"w{c}x" for c in f"{i:03d}" * 2) + " a b c") for i in range(5)] + [(9, None), (10, "")]
    items = [(i, t if t is None else t.replace("0", "zero").replace("1", "one").replace("2", "two").replace("3", "three").replace("4", "four")) for i, t in items]
    docs = [(i, f"before {t} after") for i, t in items] + [(None, items[0][1])]
    assert run(spark, docs, items) == {(i, i): "exact" for i in range(5)} | {(None, 0): "exact"}
    assert run(spark, docs, [(1, None)]) == {}
    assert run(spark, [], items) == {}


def test_one_block_at_a_time(spark, monkeypatch):
    """No earlier block is alive when the next one is made, nor more than one at the end."""
    made, alive = [], []
    make = decontam.Block.__init__

    def watched(self, *args):
        gc.collect()
        alive.append(sum(r() is not None for r in made))
        make(self, *args)
        made.append(weakref.ref(self))

    monkeypatch.setattr(decontam.Block, "__init__", watched)
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 20)
    words = "red blue green brown black white grey pink gold".split()
    items = [(i, " ".join(words[i:] + words[:i])) for i in range(6)]
    d = spark.createDataFrame([(i, f"x {t} x") for i, t in items] + [(9, "none")], "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.find_items(d, b)
    assert len(alive) > 2 and not any(alive)
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(i, i) for i in range(6)]
    assert found._jdf.queryExecution().logical().toString().count("MapInArrow") == 1  # a plan holds the blocks it names
    del found
    made.clear()
    alive.clear()
    kept = decontam.keep_uncontaminated(d, b)
    assert len(alive) > 2 and not any(alive)
    assert [r.doc_id for r in kept.collect()] == [9]


def test_documents_that_hold_whole_items(spark, documents):
    """Every document with all words of an item in a row is found, and nothing without 8 of them."""
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontam.find_items(documents, bench).collect()}
    items = {r.item_id: r.text.split() for r in bench.collect()}
    whole, part = set(), set()
    for r in documents.collect():
        text = " ".join((r.text or "").split())
        for i, w in items.items():
            if " ".join(w[1:-1]) in text:
                whole.add((r.doc_id, i))
            low = text.lower()
            if any(" ".join(w[a : a + 8]).lower() in low for a in range(len(w) - 7)):
                part.add((r.doc_id, i))
    assert whole <= got <= part and whole


def test_odd_rows(spark, odd_documents):
    bench = spark.createDataFrame([(1, "same text here twice over and over again for the test of ties", "x")], "item_id long, text string, doc_id string")
    got = [(r.doc_id, r.item_id) for r in decontam.find_items(odd_documents, bench).collect()]
    assert sorted(got) == [(3, 1), (4, 1), (4, 1)]
    kept = decontam.keep_uncontaminated(odd_documents, bench)
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count() - 3
