import hashlib
import random

import pytest

from .conftest import ODD
from dqflow.llm import substring_dedup as sd


def rows_of(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in df.collect())


def expected(rows, length):
    return sorted((k if k is not None else -1, *b) for (k, _), b in zip(rows, sd.brute_force([t for _, t in rows], length), strict=True))


def corpus(seed, n=60, alphabet="abcd é"):
    """Texts that share passages, some edited, some periodic."""
    r = random.Random(seed)
    word = lambda k: "".join(r.choices(alphabet, k=k))
    passages = [word(r.randint(350, 900)) for _ in range(6)] + ["xy" * 400, "q" * 700]
    rows = []
    for k in range(n):
        parts = []
        for _ in range(r.randint(1, 4)):
            p = r.choice(passages)
            a = r.randint(0, 60)
            p = p[a:len(p) - r.randint(0, 60)]
            if r.random() < 0.3:
                at = r.randrange(len(p))
                p = p[:at] + "#" + p[at + 1:]
            parts += [word(r.randint(0, 300)), p]
        rows.append((k, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(sd.dedup(df)) == expected(rows, sd.LENGTH)


def test_hot_hash_is_counted_window_by_window(spark, monkeypatch):
    monkeypatch.setattr(sd, "GROUP", 2)
    rows = corpus(3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(sd.dedup(df)) == expected(rows, sd.LENGTH)


def test_pieces_of_long_texts(spark, monkeypatch):
    # Workers import the module afresh, so the piece size is tried on the sampling itself.
    monkeypatch.setattr(sd, "PIECE", 1000)
    r = random.Random(5)
    data = bytes(r.choices(b"abcdef", k=5000))
    starts = []
    for at, piece in sd._pieces(data, sd.LENGTH):
        import numpy as np

        for _, _, a, b in zip(*sd._sampled(np.frombuffer(piece, np.uint8), sd.LENGTH), strict=True):
            starts += range(at + a, at + b + 1)
    assert starts == list(range(len(data) - sd.LENGTH + 1))


def test_odd_rows(odd):
    assert rows_of(sd.dedup(odd)) == expected(ODD, sd.LENGTH)


def test_empty(empty):
    assert sd.dedup(empty).count() == 0


def test_tables(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert rows_of(sd.dedup(documents)) == expected(rows, sd.LENGTH)
