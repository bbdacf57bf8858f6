import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from .conftest import ODD, SF
from dqflow.llm import frames
from dqflow.llm import quality as ql


def plain_model(texts, order):
    """Interpolated modified Kneser-Ney probabilities by their textbook definition, over strings."""
    counts = {order: collections.Counter()}
    for t in texts:
        padded = "\x01" * (order - 1) + t
        counts[order].update(padded[i:i + order] for i in range(len(t)))
    for k in range(order - 1, 0, -1):
        counts[k] = collections.Counter(g[1:] for g in counts[k + 1])
    discounts, context = {}, {}
    for k, c in counts.items():
        n = [sum(1 for v in c.values() if v == i) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        discounts[k] = [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), float(i)) if n[i - 1] else 0.5 * i for i in (1, 2, 3)]
        context[k] = collections.defaultdict(lambda: [0, 0.0])
        for g, v in c.items():
            context[k][g[:-1]][0] += v
            context[k][g[:-1]][1] += discounts[k][min(v, 3) - 1]
    alphabet = len(counts[1]) + 1

    def probability(g):
        if not g:
            return 1 / alphabet
        k, below = len(g), probability(g[1:])
        if g[:-1] not in context[k]:
            return below
        total, spare = context[k][g[:-1]]
        v = counts[k].get(g, 0)
        return ((v - discounts[k][min(v, 3) - 1]) / total if v else 0.0) + spare / total * below

    return probability


def plain_perplexity(probability, text, order):
    padded = "\x01" * (order - 1) + text
    return math.exp(-np.mean([math.log(probability(padded[i:i + order])) for i in range(len(text))])) if text else None


@pytest.mark.parametrize("order", [2, 3, 5])
def test_perplexity_equals_the_definition(spark, order):
    r = random.Random(order)
    train = ["".join(r.choices("abcde ", k=r.randint(5, 60))) for _ in range(30)] + ["größe"]
    some = train[:5] + ["".join(r.choices("abcdexyzü ", k=40)) for _ in range(8)] + ["", None, "\x00zz"]
    probability = plain_model(train, order)
    known, unseen = ql.model(ql.counts(spark.createDataFrame([(t,) for t in train], "text string"), order), order)
    df = spark.createDataFrame([(k, t, "en") for k, t in enumerate(some)], "doc_id long, text string, lang string")
    got = {x.doc_id: x.perplexity for x in ql.perplexities(df, known, unseen, order=order).collect()}
    for k, t in enumerate(some):
        want = plain_perplexity(probability, t or "", order)
        assert got[k] is None if want is None else math.isclose(got[k], want, rel_tol=1e-4)


def test_thresholds_are_quantiles_of_trusted_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = ql.classify(docs, labels).collect()
    assert len(rows) == docs.count()
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(ql.HELD_OUT)) == 0
    good = {r.doc_id for r in labels.where("quality = 1").where(held_out).collect()}
    for lang in {r.lang for r in rows}:
        own = sorted(r.perplexity for r in rows if r.lang == lang and r.doc_id in good)
        limit = {r.threshold for r in rows if r.lang == lang}
        assert len(limit) == 1 and abs(np.searchsorted(own, limit.pop() / ql.MARGIN + 1e-9, "right") - math.ceil(ql.QUANTILE * len(own))) <= 1
    assert all(r.keep == (r.perplexity <= r.threshold) for r in rows)


def test_held_out_documents(spark):
    """Trained on four fifths of the labels, judged on the rest."""
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = ql.classify(docs, labels.where("doc_id % 5 > 0")).join(labels.where("doc_id % 5 = 0"), "doc_id").select("keep", "quality").collect()
    good, bad = ([r.keep for r in found if r.quality == q] for q in (1, 0))
    assert np.mean(good) > 0.9 and np.mean(bad) < 0.4


def test_odd_rows(spark, odd, empty):
    df = odd.withColumn("lang", F.when(F.col("doc_id") == 1, "en"))
    labels = spark.createDataFrame([(1, 1), (4, 1), (4, 0), (None, 1), (8, None)], "doc_id long, quality int")
    rows = ql.classify(df, labels).collect()
    assert len(rows) == len(ODD) and all(r.keep for r in rows if not r.perplexity)
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r.keep for r in ql.classify(df, nothing).collect()) and ql.keep_good(df, nothing).count() == len(ODD)
    assert ql.classify(empty, labels).count() == 0


def test_toxic_documents_are_not_trusted(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 1, None), (4, 0, 0), (5, 1, 0), (5, 1, 1), (6, 1, 0), (6, 1, 0), (7, None, 0)],
                                   "doc_id long, quality int, toxic int")
    assert sorted(r.id for r in ql.trusted_ids(labels).collect()) == [1, 6]
    assert sorted(r.id for r in ql.trusted_ids(labels.drop("toxic")).collect()) == [1, 2, 3, 5, 6]


def test_toxic_documents_do_not_train(spark):
    """Words of toxic documents alone stay unknown to the model."""
    rows = [(k, "a plain sentence of ordinary words", "en") for k in range(40)] + [(k, "zqxj vkwz qqzx", "en") for k in range(40, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1, int(k >= 40)) for k in range(58)], "doc_id long, quality int, toxic int")
    assert {r.doc_id for r in ql.classify(docs, labels).collect() if not r.keep} == set(range(40, 60))


def test_every_trusted_document_is_scored_unseen(spark):
    """Each by a model of the other folds; all of a language set its threshold, too few set none."""
    r = random.Random(7)
    texts = ["".join(r.choices("abcde ", k=r.randint(20, 60))) for _ in range(90)]
    langs = ["en"] * 60 + ["sw"] * ql.MIN_TRUSTED + [None] * 9 + ["yo"]
    df = spark.createDataFrame([(k, t, g) for k, (t, g) in enumerate(zip(texts, langs, strict=True))], "doc_id long, text string, lang string")
    df = df.union(spark.createDataFrame([(100, "\u4e2d\u6587 ngôn ngữ", "yo"), (101, "ἐν ἀρχῇ", "grc"), (102, "zzqq" * 9, "sw")], df.schema))
    fold = {x.doc_id: x.f for x in df.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(ql.HELD_OUT)).alias("f")).collect()}
    rows = {x.doc_id: x for x in ql.classify(df, df.where("doc_id < 90").selectExpr("doc_id", "1 AS quality", "0 AS toxic")).collect()}
    for f in range(ql.HELD_OUT):
        probability = plain_model([t for k, t in enumerate(texts) if fold[k] != f], ql.ORDER)
        for k in [k for k in range(90) if fold[k] == f]:
            assert math.isclose(rows[k].perplexity, plain_perplexity(probability, texts[k], ql.ORDER), rel_tol=1e-4)
    for lang in ("en", "sw"):
        own = [rows[k].perplexity for k in range(90) if rows[k].lang == lang]
        assert all(math.isclose(x.threshold, max(own) * ql.MARGIN) for x in rows.values() if x.lang == lang)
    # Languages with too few trusted documents, or none, keep theirs.
    assert {k for k, x in rows.items() if not x.keep} == {102}
    assert all(math.isinf(x.threshold) for x in rows.values() if x.lang not in ("en", "sw"))


def test_tasks_hand_over_bounded_batches_and_give_memory_back(spark, tmp_path, monkeypatch):
    """No Arrow batch is as large as a piece or a block, and a task releases what it held when it ends."""
    got = list(ql._batches(gram=np.arange(2 * ql.BATCH_ROWS + 5), n0=np.ones(2 * ql.BATCH_ROWS + 5, np.int64)))
    assert [b.num_rows for b in got] == [ql.BATCH_ROWS, ql.BATCH_ROWS, 5] and got[2].column("gram").to_pylist()[-1] == 2 * ql.BATCH_ROWS + 4
    assert list(ql._batches(gram=np.zeros(0, np.int64))) == []
    calls = []
    monkeypatch.setattr(frames, "give_back", lambda: calls.append(1))
    task = frames.in_task(lambda batches: (b for b in batches))
    assert list(task(iter("ab"))) == ["a", "b"] and calls == [1]
    with pytest.raises(ValueError):
        list(frames.in_task(lambda batches: map(int, batches))(iter("x")))
    assert calls == [1, 1]
    monkeypatch.undo()
    frames.give_back()


def test_counts_do_not_depend_on_the_sizes_of_pieces_and_batches(spark, monkeypatch):
    texts = spark.createDataFrame([(i, "abcab" * (i % 7) + str(i)) for i in range(40)], "doc_id long, text string")
    whole = sorted(map(tuple, ql.counts(texts, 3).collect()))
    got = spark.createDataFrame([], "gram long, n long")
    for first in range(0, 40, 9):
        got = got.unionByName(ql.counts(texts.where(f"doc_id >= {first} AND doc_id < {first + 9}"), 3))
    assert sorted(map(tuple, got.groupBy("gram").agg(F.sum("n")).collect())) == whole


def test_long_texts_come_to_python_in_small_batches(spark):
    """Spark's own batches of 10,000 rows would be of 64 MB; a session's own number stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    rows = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), 16 << 10).alias("text"))
    seen = rows.mapInArrow(lambda batches: (b.select(["text"]).from_arrays([[b.nbytes], [b.num_rows]], ["bytes", "rows"]) for b in batches), "bytes long, rows long")
    with frames.small_batches(spark):
        got = seen.collect()
    assert spark.conf.get(key, None) is None
    assert sum(r["rows"] for r in got) == 4000 and max(r["bytes"] for r in got) < 2 * frames.ARROW_BYTES
    with pytest.raises(ValueError), frames.small_batches(spark):
        raise ValueError
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "1m")
    try:
        with frames.small_batches(spark):
            assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key)


def test_a_task_deals_small_batches_into_blocks_together():
    """Else smaller batches would make more and smaller parts of each block, which compress worse."""
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * (1 << 20)] * 3)], ["text"])
    got = list(ql._gathered(iter([batch] * 11)))
    assert [b.num_rows for b in got] == [18, 15] and list(ql._gathered(iter([]))) == []


def test_scores_hold_no_texts():
    """Columns of a block that was read share its memory; those that go with the scores have their own."""
    held = ql._unzip(ql._zip(pa.RecordBatch.from_pydict({"id": [1, None, 3], "text": ["a" * 1000, "b", "c"], "lang": ["en", None, "de"]})))
    for name in ("id", "lang"):
        own = ql._apart(held.column(name))
        assert own.to_pylist() == held.column(name).to_pylist()
        assert not {b.address for b in own.buffers() if b} & {b.address for b in held.column(name).buffers() if b}
    assert ql._apart(pa.array([], pa.int64())).to_pylist() == []
