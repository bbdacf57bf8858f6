import itertools
import random

import numpy as np
import xxhash

from .conftest import ODD
from dqflow.llm import simhash as sh
from dqflow.llm.components import components


def plain_fingerprint(text):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\t", " ").replace("\n", " ").replace("\x0b", " ")
             .replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, distance=3):
    prints = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= distance:
            root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return sorted((str(k), p, str(least.get(find(i)))) for i, ((k, _), p) in enumerate(zip(rows, prints, strict=True)))


def found(df):
    return sorted((str(r.doc_id), r.simhash % 2**64, str(r.component_id)) for r in sh.near_duplicates(df).collect())


def test_equals_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert found(documents) == plain_components(rows)


def test_odd_rows(odd):
    assert found(odd) == plain_components(ODD)


def test_empty(empty):
    assert sh.near_duplicates(empty).count() == 0


def test_a_group_keeps_every_link():
    r = np.random.default_rng(1)
    centres = r.integers(0, 2**63, 30, dtype=np.int64).astype(np.uint64)
    values = np.unique(np.concatenate([centres] + [centres ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) for a, b in r.integers(0, 38, (40, 2))]))
    free = ((0, 38),)
    mask = np.uint64((1 << 38) - 1)
    values = np.unique(values & mask)  # members agree on the other bits
    for fine in (16, 10**9):
        before, sh.FINE = sh.FINE, fine
        try:
            links = list(sh.links_of_group(values, 3, sh._references(sh.PIVOTS), free))
        finally:
            sh.FINE = before
        root = {int(v): int(v) for v in values}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in ((int(a), int(b)) for x, y in links for a, b in zip(x, y, strict=True)):
            assert (a ^ b) != 0
            root[max(find(a), find(b))] = min(find(a), find(b))
        want = {int(v): int(v) for v in values}
        sets = {int(v): {int(v)} for v in values}
        for a, b in itertools.combinations(map(int, values), 2):
            if (a ^ b).bit_count() <= 3 and sets[a] is not sets[b]:
                sets[a] |= sets[b]
                for x in sets[b]:
                    sets[x] = sets[a]
        want = {v: min(s) for v, s in sets.items()}
        assert {v: find(v) for v in want} == want


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randint(0, 400), r.randint(0, 400)) for _ in range(300)] + [(k, k + 1) for k in range(1000, 1100)] + [(5000, k) for k in range(5001, 5200)]
    sets = {}
    for a, b in edges:
        merged = sets.get(a, {a}) | sets.get(b, {b})
        for x in merged:
            sets[x] = merged
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: min(s) for v, s in sets.items() if len(s) > 1}
