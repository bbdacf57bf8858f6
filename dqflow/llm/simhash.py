"""SimHash near-duplicates through pivot distance tables.

A text's words give shingles, their XXH64 values vote on 64 bits, and texts whose fingerprints
differ in at most ``max_distance`` bits are linked.  All work on links is on distinct
fingerprints, so any number of copies counts as one.

Candidates: the 64 bits are cut into ``max_distance + 2`` blocks; two fingerprints within the
distance agree on at least two blocks, so each fingerprint is dealt once per pair of blocks, by
the bits of that pair.  Within a group that agrees on such bits, the Hamming distances to
``PIVOTS`` fixed reference fingerprints are tabled.  By the triangle inequality, two rows whose
table entries differ by more than ``max_distance`` at any pivot cannot be linked: the group is
swept in order of the first pivot, pairs are discarded by their largest coordinate difference, and
survivors are verified by their exact distance.  No pair leaves its group: a group of m
fingerprints gives at most m - 1 links, to the smallest member of each linked set.  A group over
``FINE`` members is first cut by the bits that its members may still differ in, as often as that
helps; what then remains lies within a few bits and is swept in bounded chunks.  Components of
the links are found by large-star and small-star rounds, each written to the shared folder.

Defined cases: a text without words has fingerprint zero, linked like any other; one of fewer
words than a shingle is one shingle; a component is named by its smallest id, ids that are null
count last; repeated rows each give a row; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqflow.llm.components import components
from dqflow.llm.frames import col, in_task, with_arrow_columns
from dqflow.session import scratch_path

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
PIVOTS = 24
#: Members of a group that are compared without cutting the group further.
FINE = 2048
#: Pairs in memory at once.
CHUNK_PAIRS = 1 << 21

_MASK = (1 << 64) - 1


def _references(n: int) -> np.ndarray:
    """Reference fingerprints: XXH64 of 0, 1, 2, ..."""
    return np.array([xxhash.xxh64_intdigest(i.to_bytes(8, "little")) for i in range(n)], np.uint64)


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    words = text.encode().lower().split() if text else []  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    n = max(1, len(words) - shingle_words + 1)
    starts = [0, *ends[:n - 1]]
    digest = xxhash.xxh64_intdigest
    ones, total = np.zeros(64, np.int64), 0
    for at in range(0, n, 65536):
        hashed = np.array([digest(joined[a:b - 1], SEED) for a, b in
                           zip(starts[at:at + 65536], ends[min(shingle_words, len(words)) - 1 + at:][:65536], strict=False)], "<u8")
        ones += np.unpackbits(hashed.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
        total += len(hashed)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def with_fingerprint(df: DataFrame, text_column: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``df`` with ``simhash`` long, the 64 bits of each row's fingerprint as a signed number."""

    def make(batch):
        texts = batch.column(text_column)
        values = np.fromiter((fingerprint(t.as_py(), shingle_words) for t in texts), np.uint64, len(texts))
        return [pa.array(values.view(np.int64))]

    return with_arrow_columns(df, "simhash long", make)


def _blocks(n: int) -> list[tuple[int, int]]:
    """(shift, width) of ``n`` blocks of the 64 bits."""
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in itertools.pairwise(cuts)]


def _linked(values: np.ndarray, pivots: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of ``values`` within the distance, by sweeping and pruning on the pivot table."""
    table = np.bitwise_count(values[:, None] ^ pivots[None, :]).astype(np.int16)
    order = np.argsort(table[:, 0], kind="stable")
    values, table = values[order], table[order]
    # Rows after each that lie within the distance at the first pivot.
    upto = np.searchsorted(table[:, 0], table[:, 0] + distance, "right")
    reach = upto - np.arange(len(values)) - 1
    at = 0
    while at < len(values):
        to = at + max(1, int(np.searchsorted(np.cumsum(reach[at:]), CHUNK_PAIRS, "right")))
        for skip in range(0, max(1, int(reach[at:to].max())), CHUNK_PAIRS):
            n = np.clip(reach[at:to] - skip, 0, CHUNK_PAIRS)
            i = np.repeat(np.arange(at, at + len(n)), n)
            j = i + 1 + skip + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
            for p in range(1, table.shape[1]):
                near = np.abs(table[i, p] - table[j, p]) <= distance
                i, j = i[near], j[near]
            near = np.bitwise_count(values[i] ^ values[j]) <= distance
            yield order[i[near]], order[j[near]]
        at = to


def _roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index of each index's linked set."""
    root = np.arange(n)
    for i, j in pairs:
        while len(i):
            a, b = root[i], root[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root != root[root]).any():
                root = root[root]
    return root


def links_of_group(values: np.ndarray, distance: int, pivots: np.ndarray, free: tuple[tuple[int, int], ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(member, smaller member) links of one group of distinct fingerprints; at most len - 1 of each cut.

    ``free``: the blocks in which members may differ."""
    if len(values) > FINE and sum(w for _, w in free) > distance:
        # Members within the distance agree on one of distance + 1 parts of the free bits.
        bits = [s + b for s, w in free for b in range(w)]
        parts = [bits[len(bits) * k // (distance + 1):len(bits) * (k + 1) // (distance + 1)] for k in range(distance + 1)]
        cuts = []
        for part in parts:
            mask = np.uint64(sum(1 << b for b in part))
            key = values & mask
            order = np.argsort(key, kind="stable")
            begin = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
            cuts.append((part, order, begin, np.diff(np.append(begin, len(order))).max()))
        if max(c[3] for c in cuts) < len(values):
            for part, order, begin, _ in cuts:
                rest = tuple((b, 1) for b in bits if b not in set(part))
                for a, b in itertools.pairwise([*begin.tolist(), len(order)]):
                    if b - a > 1:
                        yield from links_of_group(values[order[a:b]], distance, pivots, rest)
            return
    values = np.sort(values)
    root = _roots(len(values), _linked(values, pivots, distance))
    child = np.flatnonzero(root != np.arange(len(values)))
    if len(child):
        yield values[child], values[root[child]]


def links(distinct: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """(a, b) of a spanning set of the links among the distinct fingerprints of column ``simhash``."""
    blocks = _blocks(distance + 2)
    pairs = list(itertools.combinations(range(len(blocks)), 2))

    def dealt(batches):
        for batch in batches:
            values = batch.column("simhash").to_numpy(zero_copy_only=False).view(np.uint64)
            for t, (x, y) in enumerate(pairs):
                key = np.zeros(len(values), np.uint64)
                for shift, width in (blocks[x], blocks[y]):
                    key = key << np.uint64(width) | values >> np.uint64(shift) & np.uint64((1 << width) - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((key * np.uint64(len(pairs)) + np.uint64(t)).view(np.int64)), pa.array(values.view(np.int64))], ["part", "simhash"])

    def swept(batches):
        pivots = _references(PIVOTS)
        held_key, held = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in itertools.chain(batches, [None]):
            key, values = held_key, held
            if batch is not None:
                key = np.append(held_key, batch.column("part").to_numpy(zero_copy_only=False))
                values = np.append(held, batch.column("simhash").to_numpy(zero_copy_only=False).view(np.uint64))
            if not len(key):
                continue
            begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            ends = np.append(begin[1:], len(key))
            last = begin[-1] if batch is not None else len(key)  # the last group may go on
            several = (ends - begin > 1) & (ends <= last)
            found = []
            for a, b in zip(begin[several].tolist(), ends[several].tolist(), strict=True):
                x, y = pairs[int(key[a]) % len(pairs)]
                free = tuple(s for k, s in enumerate(blocks) if k not in (x, y))
                if b - a == 2:
                    if int(values[a] ^ values[a + 1]).bit_count() <= distance and (
                            np.abs(np.bitwise_count(values[a] ^ pivots).astype(np.int16) - np.bitwise_count(values[a + 1] ^ pivots)) <= distance).all():
                        found.append((values[a:a + 1], values[a + 1:a + 2]))
                else:
                    found.extend(links_of_group(values[a:b], distance, pivots, free))
            held_key, held = key[last:], values[last:]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found]).view(np.int64)) for k in (0, 1)], ["a", "b"])

    spread = distinct.select("simhash").mapInArrow(in_task(dealt), "part long, simhash long").repartition("part").sortWithinPartitions("part")
    return spread.mapInArrow(in_task(swept), "a long, b long")


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(id, simhash long, component_id, text_hash, group) of each row.

    ``component_id``: the smallest id that can be reached over links; ``text_hash``: XXH64 of the
    text; ``group``: the component's smallest fingerprint."""
    spark = df.sparkSession
    rows = df.select(col(id_column).alias("id"), F.coalesce(col(text_column), F.lit("")).alias("text"))
    path = scratch_path(spark, "simhash")
    rows.transform(with_fingerprint, "text", shingle_words).select("id", "simhash", F.xxhash64("text").alias("text_hash")).write.parquet(path)
    hashed = spark.read.parquet(path)
    named = hashed.groupBy("simhash").agg(F.min("id").alias("least"))
    roots = components(links(named, max_distance))
    group = named.join(roots, named["simhash"] == roots["node"], "left").select("simhash", "least", F.coalesce("root", "simhash").alias("group"))
    least = group.groupBy("group").agg(F.min("least").alias("component_id"))
    names = group.select("simhash", "group").join(least, "group")
    return hashed.join(names, "simhash").select(F.col("id").alias(id_column), "simhash", "component_id", "text_hash", "group")


def keep_one(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``df`` with one row of each component: that of the smallest id (null ids last), then text hash."""
    found = near_duplicates(df, id_column, text_column, **options).withColumnRenamed(id_column, "kept_id")
    first = found.groupBy("group").agg(F.min(F.struct(F.col("kept_id").isNull(), "kept_id", "text_hash")).alias("first"))
    path = scratch_path(df.sparkSession, "simhash-kept")
    first.select("first.*").select("kept_id", "text_hash").distinct().write.parquet(path)
    kept = df.sparkSession.read.parquet(path)
    text_hash = F.xxhash64(F.coalesce(col(text_column), F.lit("")))
    out = df.join(kept, col(id_column).eqNullSafe(kept["kept_id"]) & (text_hash == kept["text_hash"]), "left_semi")
    repeated = found.groupBy("kept_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return out.dropDuplicates([id_column, text_column]) if repeated.take(1) else out
