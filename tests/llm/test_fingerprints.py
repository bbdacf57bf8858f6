import hashlib

import numpy as np
from pyspark.sql import functions as F

from .conftest import ODD
from dqflow.llm import multiset_fingerprint as mf


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for (k, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        half = len(text) // 2
        new = text[:len(text) - half] + after[:half]
        v = mf.Vectors.of([text, new, after])
        near = v[[0, 0]].likeness(v[[1, 2]])
        out.append((str(k), len(text), hashlib.sha256(new.encode()).hexdigest(), v.hex()[0], v.hex()[1], round(float(near[0]), 9), round(float(near[1]), 9)))
    return sorted(out)


def found(df):
    return sorted((str(r[0]), *r[1:5], round(r[5], 9), round(r[6], 9)) for r in mf.against_next(df).collect())


def test_tables(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert found(documents.repartition(5)) == expected(rows)


def test_odd_rows(odd):
    # Rows that repeat an id have equal texts here, so their order does not matter.
    rows = [(k, t or "") for k, t in ODD]
    assert found(odd) == expected(rows)


def test_empty_and_single(spark, empty):
    assert mf.against_next(empty).count() == 0
    one = spark.createDataFrame([(3, "a\nb")], "doc_id long, text string")
    assert found(one) == expected([(3, "a\nb")])


def test_sums_do_not_depend_on_order():
    a, b = mf.Vectors.of(["one\ntwo\nthree", "three\n\n one \ntwo"]).hex()
    assert a == b
    assert len(set(mf.Vectors.of(["one\ntwo", "one\ntwo\ntwo", "one", ""]).hex())) == 4


def test_edits_follow(spark):
    df = spark.createDataFrame([("a\nb\nc", "d\ne", "b"), ("x", None, "x")], "text string, extra string, gone string")
    start = mf.fingerprints(df)
    got = [r.fingerprint for r in mf.edited(start, "extra", "gone").orderBy(F.col("text")).collect()]
    assert got == mf.Vectors.of(["a\nc\nd\ne", ""]).hex()


def test_likeness_follows_overlap():
    lines = [f"paragraph number {k}" for k in range(200)]
    v = mf.Vectors.of(["\n".join(lines), "\n".join(lines[:100] + [f"other {k}" for k in range(100)]), "\n".join(f"else {k}" for k in range(200))])
    near = v[[0, 0, 0]].likeness(v)
    assert near[0] == 1.0 and abs(near[1] - 0.5) < 0.15 and near[2] < 0.2
    assert np.all(mf.Vectors.of(["", ""])[[0]].likeness(mf.Vectors.of([""])) == 1.0)


def test_very_frequent_lines():
    v = mf.Vectors.of(["same line\n" * 40_000, "same line\n" * 20_000 + "other\n" * 100])
    assert v[[0]].likeness(v[[1]])[0] > 0.9
    assert mf.Vectors.read(v.hex()).likeness(v).tolist() == [1.0, 1.0] and v.plus(v).minus(v).hex() == v.hex()


def test_long_lines_share_what_is_kept():
    words = " ".join(f"word{k * k % 97}" for k in range(200))
    for text in (words, "word " * 60, "".join(chr(0x4E00 + k * k % 997) for k in range(400)), "word" * 60):
        own, new = mf.paragraphs(text.strip()), mf.paragraphs(mf.edit(text.strip(), "#" * 10_000))
        assert len(own) > 1 and set(own) & set(new) and all(len(p.decode()) <= mf.LONG_LINE for p in own)
    # A word in front changes the first pieces only.
    assert len(set(mf.paragraphs(words)) & set(mf.paragraphs("more " + words))) > len(set(mf.paragraphs(words))) / 2
