import random
import re
import string

import numpy as np

from .conftest import ODD
from dqflow.llm import secret_scan as ss

TEXTS = [
    'x = "1"; Password: \'hunter22\' token=abc api_key="zzzzzz" and passwd  :  "a.b/c+d=" end', "secret=token=abcdef, token=token:abcdefgh",
    "AKIA" + "A" * 16 + " AKIA" + "B" * 15 + " xAKIAAKIA" + "C" * 20, "é" * 5 + "deadbeef" * 3 + "g" + "a" * 23, "paſſword=abcdef Key toKen=ABCDEF", "", "no secrets here",
]


def plain(text):
    found = []
    for m in re.finditer(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_base_spans():
    r = random.Random(1)
    bits = ["password", "PASSWD", "token", "api_key", "apikey", "secret", "=", ":", " ", '"', "'", "abcdef", "x", "AKIA", "ABCD1234EFGH5678", "0123456789abcdef" * 2, "é", "\n"]
    for text in TEXTS + ["".join(r.choices(bits, k=12)) for _ in range(3000)]:
        assert [x[:3] for x in ss.base_spans(text)] == plain(text)


def words(r, n):
    syllables = ["the", "an", "ing", "re", "con", "ver", "to", "ma", "li", "ser", "ta", "ble"]
    return ["".join(r.choices(syllables, k=r.randint(3, 8))) for _ in range(n)]


def random_strings(r, n):
    return ["".join(r.choices(string.ascii_letters + string.digits, k=r.randint(20, 40))) for _ in range(n)]


def test_random_strings_are_told_from_identifiers(spark):
    r = random.Random(2)
    train = [(k, " ".join(words(r, 50)) + f" token={s} ") for k, s in enumerate(random_strings(r, 400))]
    counts = ss.labelled_counts(spark.createDataFrame(train, "doc_id long, text string"))
    ratio = ss.log_ratio(counts)
    held_out = random_strings(r, 200), [w for w in words(r, 2000) if len(w) >= ss.STRING_LENGTH]
    hits = [bool(ss.spans_of(f"see {s} here", ratio)) for s in held_out[0]]
    false = [bool(ss.spans_of(f"see {s} here", ratio)) for s in held_out[1]]
    assert np.mean(hits) > 0.95 and np.mean(false) < 0.01
    # added spans stand beside base ones, which stay
    text = f"{held_out[0][0]} token={held_out[0][1]}"
    kinds = [ss.KINDS[k] for _, k, _ in ss.spans_of(text, ratio)]
    assert kinds == ["random", "assign"]


def test_odd_rows(spark, odd, empty):
    ratio = ss.log_ratio(ss.labelled_counts(odd))
    assert ratio is None  # no base span to learn from
    got = ss.scan(odd, ratio).collect()
    assert len(got) == len(ODD) and all(r.secret_spans == [] for r in got)
    assert ss.scan(empty, None).count() == 0 and not ss.labelled_counts(empty).any()


def test_strings_beside_base_spans_are_scored():
    counts = np.zeros((2, ss.SYMBOLS, ss.SYMBOLS))
    counts[1] += 9
    counts[0, :, :5] = 999  # ordinary strings hold few characters
    ratio = ss.log_ratio(counts)
    key, hexes = "Zq8Xw7Vu6Ts5Rr4Pp3", "0123456789abcdef" * 2
    for text in (f"{key}/{hexes}/{key}", f"a {key}-{hexes} b", f"{hexes}_{key}", f"{key}-token=abcdefg", f"{key[:9]}/{hexes}/{key[:9]}"):
        base = [(a, k, b) for a, k, b, _ in ss.base_spans(text)]
        inside = [False] * len(text)
        for a, _, b in base:
            inside[a:b] = [True] * (b - a)
        want, at = list(base), 0
        for i in range(len(text) + 1):  # runs of the alphabet without base spans
            if i == len(text) or inside[i] or text[i] not in ss.ALPHABET:
                string = text[at:i]
                if len(string) >= ss.STRING_LENGTH:
                    symbols = [ss.ALPHABET.index(c) + 1 for c in string]
                    score = sum(ratio[x, y] for x, y in zip([0, *symbols], symbols))
                    if score > ss.RATIO and score > ss.RATIO_PER_CHARACTER * len(string):
                        want.append((at, 3, i))
                at = i + 1
        assert ss.spans_of(text, ratio) == sorted(want) and (len(want) > len(base)) == (key in text)


def test_registered_query(spark):
    """Base spans and their digest from the contract's patterns; added spans recomputed with the query's own counts."""
    import hashlib

    from .conftest import SF
    from dqflow.llm import queries

    documents = spark.read.parquet(f"{SF}/documents.parquet")
    ratio = ss.log_ratio(ss.labelled_counts(documents))
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    done = queries.queries()["op2_secret_scan"](spark, SF)
    assert done.columns[:6] == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    for r in done.collect():
        base = plain(texts[r.doc_id])
        listed = lambda spans: ",".join(f"{ss.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert r.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest()
        assert r.spans == listed(ss.spans_of(texts[r.doc_id], ratio))
