import base64
import hashlib
import json
import random
import struct

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from .conftest import ODD, SF
from dqflow.llm import byte_bpe, pretokens, queries, token_counts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
FUZZ = "'stremvld aZé\n\t  1²!.\0\x85　\x1c中🙂<|endoftext|>"


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def fuzz(n, seed=0):
    r = random.Random(seed)
    return ["".join(r.choices(FUZZ, k=r.randint(0, 30))) for _ in range(n)]


def texts():
    r = random.Random(4)
    return [t for _, t in ODD] + fuzz(400) + ["a" * 900, "ab" * 500, "".join(r.choices("abcdefghij", k=600)), "x" + " " * 300 + "y", "<|endoftext|>a <|endoftext|>"]


def test_pieces_equal_the_pattern():
    pattern = regex.compile(public_tokenizers.PATTERN)
    some = fuzz(20000, 1) + [t for _, t in ODD if t]
    index, counts, words = pretokens.distinct(some)
    words, at = words.to_pylist(), 0
    for text, n in zip(some, counts.tolist(), strict=True):
        assert [words[i] for i in index[at:at + n]] == [x.encode() for x in pattern.findall(text)]
        at += n


def test_pieces_do_not_depend_on_slices(monkeypatch):
    some = fuzz(500, 2)

    def every():
        index, counts, words = pretokens.distinct(some)
        return counts.tolist(), [words[i].as_py() for i in index.tolist()]

    whole = every()
    monkeypatch.setattr(pretokens, "SLICE_CHARS", 50)
    assert every() == whole


def test_ids_equal_the_library_and_decode(spark, library):
    some = texts()
    df = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    for packed in (False, True):
        ids = byte_bpe.encode(df, RANKS, packed=packed)
        for r in byte_bpe.decode(ids, RANKS).collect():
            want = library.encode_ordinary(some[r.doc_id] or "")
            assert (bytes(r.ids) == struct.pack(f"<{len(want)}I", *want)) if packed else (r.ids == want)
            assert bytes(r.decoded).decode() == (some[r.doc_id] or "")


def test_odd_rows_and_columns(spark, odd, empty, library):
    got = sorted((str(r.doc_id), tuple(r.ids)) for r in byte_bpe.encode(odd, RANKS).collect())
    assert got == sorted((str(k), tuple(library.encode_ordinary(t or ""))) for k, t in ODD)
    assert byte_bpe.encode(empty, RANKS).count() == 0
    counted = sorted((str(r.doc_id), r.n_bytes) for r in token_counts.token_counts(odd, VOCABULARY).collect())
    assert counted == sorted((str(k), len((t or "").encode())) for k, t in ODD)
    assert token_counts.token_counts(empty, VOCABULARY).count() == 0


def test_ids_out_of_range_are_errors(spark):
    from pyspark.errors import PythonException

    with pytest.raises(PythonException):
        byte_bpe.decode(spark.createDataFrame([([60000],)], "ids array<int>"), RANKS).collect()
    nothing = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [bytes(r.decoded) for r in byte_bpe.decode(nothing, RANKS).collect()] == [b"", b""]


def test_equal_blocks_keep_their_rows(spark):
    """The same rows in every partition make equal blocks."""
    df = spark.createDataFrame([(1, "same words"), (1, "same words"), (1, "same words")], "doc_id long, text string").repartition(3)
    assert [r.ids for r in byte_bpe.encode(df, RANKS).collect()].count([]) == 0
    assert byte_bpe.encode(df, RANKS).count() == 3


def test_counts_equal_the_library(spark):
    some = texts()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in some]
    df = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(df, VOCABULARY).collect()}
    assert [got[k] for k in range(len(some))] == want


def test_merges_of_overlapping_pairs():
    assert token_counts._from_left(np.array([0, 1, 2, 5, 7, 8])).tolist() == [0, 2, 5, 7]


def test_cut_shards_and_long_words(spark, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "FOLD_WORDS", 7)
    monkeypatch.setattr(byte_bpe, "FOLD_BYTES", 5)
    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", 200)
    some = fuzz(200, 5)
    df = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    assert {r.doc_id: r.ids for r in byte_bpe.encode(df, RANKS).collect()} == {k: library.encode_ordinary(t) for k, t in enumerate(some)}


def test_rank_map_is_not_in_the_plan(odd, capsys):
    byte_bpe.encode(odd, RANKS).explain(True)
    assert 100 < len(capsys.readouterr().out) < 100_000


def test_rank_map_is_small_and_whole():
    literal, sizes = byte_bpe.rank_map(RANKS)
    tables, pieces = json.loads(literal), byte_bpe.pieces_of(RANKS)
    assert len(literal) < 2_000_000 and [len(tables[t]) for t in "ab"] == list(sizes)
    ids, found = {p: i for i, p in enumerate(pieces)}, 0
    for i, p in enumerate(pieces):
        for cut in range(1, len(p)):
            if p[:cut] in ids and p[cut:] in ids:
                pair = ids[p[:cut]] << 16 | ids[p[cut:]]
                assert min(tables[t][pair % size] ^ pair << 16 for t, size in zip("ab", sizes)) == i
                found += 1
    assert found == sum(x >> 16 != 0 for t in "ab" for x in tables[t]) + (pieces[0] * 2 in ids)  # the pair 0
    assert all(tables[t][0] in (byte_bpe.EDGE, ids.get(pieces[0] * 2)) for t in "ab")


def test_registered_queries_equal_the_libraries(spark, library):
    table = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    for r in queries.queries()["op5_byte_bpe"](spark, SF).collect():
        ids = library.encode_ordinary(table[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(table[r.doc_id].encode()).hexdigest()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    for r in queries.queries()["op10_token_counts"](spark, SF).collect():
        n = len(tokenizer.encode(table[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(table[r.doc_id].encode()), n, n > 512)
