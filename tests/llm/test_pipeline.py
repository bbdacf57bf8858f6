import base64

import public_tokenizers
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline as cp
from .conftest import SF
from dqflow.llm import decontamination as dc
from dqflow.llm import pii, quality, simhash
from .test_decontamination import plain
from .test_simhash import plain_components


def test_stages_and_run(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    docs, kept = documents, {}
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, SF).cache()
        if name != cp.STAGES[-1][0]:
            assert docs.columns == documents.columns
        kept[name] = docs
    # quality: as the classifier decides, on the stage's own input
    verdict = {r.doc_id: r.keep for r in quality.classify(documents, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert {r.doc_id for r in kept["quality"].collect()} == {k for k, v in verdict.items() if v}
    # near duplicates: the first of each brute-force component
    rows = [(r.doc_id, r.text) for r in kept["quality"].collect()]
    assert sorted(str(r.doc_id) for r in kept["near_duplicates"].collect()) == sorted({c for _, _, c in plain_components(rows)})
    # decontamination: what is mostly benchmark goes, the rest holds no window
    items = [(str(r.item_id), dc.words_of(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r.doc_id: r for r in kept["decontamination"].collect()}
    for r in kept["near_duplicates"].collect():
        words = dc.words_of(r.text)
        hit, _ = plain(words, items)
        assert (r.doc_id in clean) == (len(hit) <= dc.MAX_COVERAGE * len(words))
        if r.doc_id in clean:
            assert not plain(dc.words_of(clean[r.doc_id].text), items)[0]
            if not hit:
                assert clean[r.doc_id] == r
    # personal data: no entity is left as it was
    import re

    for r in kept["personal_data"].collect():
        before = clean[r.doc_id].text
        assert r.n_chars == len(r.text)
        for address in re.findall(r"[\w.]+@[\w.]+\w", before):
            assert address not in r.text
        if not pii_like(before):
            assert r.text == before
    # tokens: as the library has them
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in kept["personal_data"].collect()}
    want = {k: library.encode_ordinary(t) for k, t in texts.items()}
    assert {r.doc_id: r.ids for r in kept["byte_bpe"].collect()} == want
    assert {r.doc_id: r.ids for r in entry.queries()["pipeline"](spark, SF).collect()} == want


def pii_like(text):
    import re

    return re.search(r"@|\d", text) or re.search(r"\b(Mrs?|Ms|Miss|Herr|Frau|Sra?|Señora?|Monsieur|Madame|Mme|Mlle)\b", text)


def test_one_row_of_repeated_rows_stays(spark):
    rows = [(1, "some words of a text that repeats"), (1, "some words of a text that repeats"), (2, "some words of a text that repeats"),
            (None, "another text without id"), (None, "another text without id"), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((str(r.doc_id), r.text or "") for r in simhash.keep_one(df).collect()) == [
        ("1", rows[0][1]), ("3", ""), ("None", "another text without id")]


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert pii.KINDS[0] == "email"
