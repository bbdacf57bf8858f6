import random

from pyspark.sql import functions as F

from dqflow.llm import decontamination as dc


def plain(words, items, window=10):
    hit, names = set(), set()
    for name, item in items:
        n = min(window, len(item))
        wins = {tuple(item[i:i + n]) for i in range(len(item) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i:i + n]) in wins:
                hit |= set(range(i, i + n))
                if name is not None:
                    names.add(name)
    return hit, names


def case(seed):
    r = random.Random(seed)
    word = lambda: r.choice([b"a", b"b", b"c"])
    items = [(str(k) if k else None, [word() for _ in range(r.choice([1, 2, 4, 9, 10, 11, 25]))]) for k in range(8)]
    docs = []
    for _ in range(20):
        words = [word() if r.random() < 0.7 else b"x" for _ in range(r.randint(0, 60))]
        for _ in range(2):
            item = r.choice(items)[1]
            at = r.randint(0, len(words))
            words[at:at] = item[r.randint(0, 2):]
        docs.append(words)
    return items, docs


def test_automaton_equals_brute_force():
    for seed in range(40):
        items, docs = case(seed)
        automaton = dc.Automaton(items, 10)
        for words in docs:
            spans, names = automaton.scan(words)
            assert ({i for a, b in spans for i in range(a, b)}, names) == plain(words, items)
            assert all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False)) or all(x[1] <= y[0] for x, y in zip(spans, spans[1:], strict=False))


ITEMS = [(1, "One two three FOUR five six seven eight nine ten eleven"), (2, "short item"), (3, None), (4, "..."), (1, "another text of the same item id with enough words in it"),
         (None, "nameless words hit too but are never listed by any item")]
TEXTS = [(1, "x one, two three four five six seven eight nine ten y"), (2, "Short\tITEM and more"), (3, None), (4, ""), (5, "clean words only"),
         (6, "nameless words hit too but are never listed by any item"), (6, "nameless words hit too but are never listed by any item"), (7, "word " * 20000 + "short item")]


def test_blocks_of_any_size_agree(spark, odd, empty):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    want = []
    items = [(str(k) if k is not None else None, dc.words_of(t)) for k, t in ITEMS]
    for k, t in TEXTS:
        hit, names = plain(dc.words_of(t), items)
        want.append((k, len(dc.words_of(t)), len(hit), tuple(sorted(names))))
    for block_words in (3, 15, 10**6):
        got = [(r.doc_id, r.n_words, sum(b - a for a, b in r.hit_spans), tuple(r.item_ids)) for r in dc.scan(docs, bench, block_words=block_words).collect()]
        assert sorted(got) == sorted(want)
    assert dc.scan(odd, bench).count() == odd.count() and dc.scan(empty, bench).count() == 0
    assert all(r.hit_spans == [] for r in dc.scan(docs, bench.limit(0)).collect())


def test_spans_are_cut_and_covered_documents_go(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    passage = "one two three four five six seven eight nine ten"
    rows = [(1, f"Before it — {passage}; after it, {' '.join('w%d' % k for k in range(30))}."), (2, passage), (3, "Clean – text."), (4, None)]
    got = {r.doc_id: r.text for r in dc.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert set(got) == {1, 3, 4}
    assert got[1] == rows[0][1].replace(passage, "") and got[3] == rows[2][1] and got[4] is None
    kept = dc.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), bench, max_span=10, max_coverage=1.0)
    assert {r.doc_id: r.text for r in kept.collect()} == dict(rows)


def test_columns_of_any_name(spark):
    """Several blocks, and input columns named like anything the operator makes."""
    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven", "x")], "doc_id long, text string, hit_spans__ string")
    docs = docs.withColumns({c: F.lit("x") for c in ("item_ids__", "cut__", "n_words", "hit_spans", "item_ids")})
    items = spark.createDataFrame([("a", "one two three"), ("b", "nine ten eleven")], "item_id string, text string")
    r = dc.scan(docs, items, block_words=2).first()
    assert r.item_ids == ["a", "b"] and r.hit_spans == [[0, 3], [8, 11]] and r["hit_spans__"] == "x"
    kept = dc.decontaminate(docs, items, block_words=2, max_coverage=0.9)
    assert kept.columns == docs.columns and set(kept.drop("doc_id", "text").first()) == {"x"} and "four" in kept.first().text
