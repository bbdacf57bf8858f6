"""Exact substring dedup: every byte covered by a long string that also starts elsewhere.

Suffix sorting by induction, laid out as Spark jobs.  Only sampled suffixes are sorted; what stands
before them is induced from their order:

1. Sampling.  A suffix is sampled where the hash of its first ``GRAM`` bytes is the smallest of
   some window (the leftmost of equals), so equal windows sample the same place, and each window
   belongs to the one suffix that its smallest hash begins.  A sampled suffix stands for the run of
   windows that belong to it and for their bytes, its context (at most ``2 * length - GRAM`` bytes).
2. Reduction.  Suffixes of equal hash and equal context are one class.  Windows of a class of
   several suffixes are repeated; a class alone with its hash has no repeated window.  What is left
   are classes that share their hash with others.
3. Induced sorting.  One suffix of each such class travels as a tuple: hash, the bytes before it and
   those from it on.  Spark sorts the tuples by hash and bytes (its sort spills to disk, so a
   partition may be far larger than memory), and the common prefix with the one before follows in
   that order.  Then the order of the suffixes one byte to the left is induced, again and again:
   tuples are distributed stably by the byte before them, and a common-prefix value becomes the
   smallest since the last tuple with the same byte.  A window that starts ``j`` bytes before its
   suffix is repeated if a neighbour among those of equal ``j`` bytes has a common prefix of
   ``length - j``.  Tuples that can no more reach the length are dropped.
4. A hash with over ``GROUP`` classes is not sorted in one task; the windows of its classes are
   counted one by one with partial aggregation instead, which gives the same result.

Repeated windows go back to their documents, and each document loses their union.

The sort of step 3 takes the place of disk-backed priority queues of tuples: Spark's shuffle files
are the one disk that survives a lost task, and its sort is the merge of sorted runs.

Defined cases: null or empty text has no bytes; a text shorter than ``length`` keeps all of them;
strings never cross texts, rows that repeat are texts that repeat; an empty table gives an empty
result; positions are bytes of UTF-8.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqflow.llm.frames import col
from dqflow.session import scratch_path

LENGTH, GRAM = 400, 64
#: Bytes hashed at once; a longer text is taken in pieces.
PIECE = 4 << 20
#: Classes of one hash that one task sorts.
GROUP = 20_000
#: Tuples induced at once.
CHUNK = 20_000
#: Bits of a place in a piece; the rest of a word orders places by hash.
PLACE = 28

_WORDS = np.array([xxhash.xxh64_intdigest(bytes([b]), 1) for b in range(256)], np.uint64)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each place on, by doubling."""
    out, size = _WORDS[data], 1
    with np.errstate(over="ignore"):
        while size < GRAM:
            left = out[:-size] * np.uint64(0x9E3779B97F4A7C15 + 2 * size)
            left ^= left >> np.uint64(31)
            out = left + out[size:]
            size *= 2
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    return out


def _sampled(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, place, first start, last start) of each sampled suffix and its run of windows."""
    hashes = _gram_hashes(data)
    word = hashes >> np.uint64(PLACE) << np.uint64(PLACE) | np.arange(len(hashes), dtype=np.uint64)
    width, size = length - GRAM + 1, 1
    while 2 * size <= width:
        word = np.minimum(word[:-size], word[size:])
        size *= 2
    if size < width:
        word = np.minimum(word[:size - width], word[width - size:])
    place = (word & np.uint64((1 << PLACE) - 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:], len(place)) - 1
    return hashes[place[first]], place[first], first, last


def _pieces(data: bytes, length: int):
    """(offset, bytes) whose windows together are those of the text, each once."""
    at = 0
    while at + length <= len(data):
        yield at, data[at:at + PIECE + length - 1]
        at += PIECE


def _keyed(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return df.select(col(id_column).alias("id"), F.coalesce(col(text_column), F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))


def _table(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sampled_suffixes(rows: DataFrame, length: int) -> DataFrame:
    """(gram, context, id, hash, place, first, last) of each sampled suffix of each text."""
    kind = rows.schema["id"].dataType.simpleString()

    def sampled(batches):
        for batch in batches:
            gram, context, owner, places = [], [], [], []
            for row, text in enumerate(batch.column("text")):
                for at, data in _pieces(text.as_py().encode(), length):
                    g, p, a, b = _sampled(np.frombuffer(data, np.uint8), length)
                    gram.append(g)
                    # The suffix's place in its context tells how its windows lie around it.
                    context.append(np.array([xxhash.xxh3_64_intdigest(data[x:y + length], seed=z) for x, y, z in
                                             zip(a.tolist(), b.tolist(), (p - a).tolist(), strict=True)], np.uint64))
                    owner.append(np.full(len(g), row))
                    places.append(np.stack([p, a, b]) + at)
            if not gram:
                continue
            owner, places = pa.array(np.concatenate(owner)), np.concatenate(places, axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(gram).view(np.int64)), pa.array(np.concatenate(context).view(np.int64)),
                batch.column("id").take(owner), batch.column("hash").take(owner), *map(pa.array, places)],
                ["gram", "context", "id", "hash", "place", "first", "last"])

    return rows.mapInArrow(sampled, f"gram long, context long, id {kind}, hash long, place int, first int, last int")


def _zipped(rows: DataFrame) -> DataFrame:
    """The rows with their texts compressed, for shuffles."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        z = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            blob = pa.array([z.compress(t.as_py().encode()) for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("hash"), blob], ["id", "hash", "z"])

    return rows.mapInArrow(run, f"id {kind}, hash long, z binary")


def _joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on (id, hash), null ids being equal; keeps the left's."""
    on = left["id"].eqNullSafe(right["id"]) & (left["hash"] == right["hash"])
    return left.join(right, on, how).drop(right["id"], right["hash"])


def induced(left: list[bytes], right: list[bytes], group: np.ndarray, length: int) -> np.ndarray:
    """Which windows are repeated: [tuple, bytes before its suffix], of tuples sorted by (group, right)."""
    n = len(left)
    reach = max(map(len, left), default=0)
    marked = np.zeros((n, reach + 1), bool)
    before = np.array([len(x) for x in left], np.int64)
    table = np.zeros((n, max(reach, 1)), np.uint8)  # bytes before the suffix, the nearest first
    for row, x in enumerate(left):
        table[row, :len(x)] = np.frombuffer(x, np.uint8)[::-1]
    width = max(map(len, right), default=0)
    text = np.zeros((n, width), np.int16) - 1
    for row, x in enumerate(right):
        text[row, :len(x)] = np.frombuffer(x, np.uint8)
    lcp = np.zeros(n, np.int64)
    for at in range(1, n, 4096):
        a, b = text[at - 1:min(at + 4096, n) - 1], text[at:at + 4096]
        apart = (a != b) | (a < 0)
        lcp[at:at + 4096] = np.where(apart.any(1), apart.argmax(1), width)
    lcp[np.flatnonzero(np.diff(group, prepend=group[:1] - 1 if n else None))] = 0
    rows, klass = np.arange(n), np.cumsum(np.diff(group, prepend=group[:1]) != 0) if n else np.zeros(0, np.int64)
    for j in range(reach + 1):
        # Common prefix with the nearest neighbour of the class on either side.
        near = np.maximum(lcp, np.append(lcp[1:], 0))
        marked[rows[near >= length - j], j] = True
        live = (before[rows] > j) & (near > 0) & (length - near <= before[rows])
        if not live.any():
            break
        byte = table[rows, np.minimum(j, table.shape[1] - 1)].astype(np.int64)
        # Tuples that are dropped still bound the prefixes across them.
        at = np.flatnonzero(live)
        at = at[np.argsort(klass[at] * 256 + byte[at], kind="stable")]
        key = klass[at] * 256 + byte[at]
        same = np.r_[False, key[1:] == key[:-1]] if len(at) else np.zeros(0, bool)
        new = np.zeros(len(at), np.int64)
        if same.any():
            q, p = at[same], at[np.flatnonzero(same) - 1]
            bounds = np.stack([p + 1, q + 1], axis=1).ravel()
            new[same] = np.minimum.reduceat(np.append(lcp, 0), bounds)[::2]
        rows, klass, lcp = rows[at], np.cumsum(~same), new
    return marked


def _starts(marks: np.ndarray, place: int) -> list[tuple[int, int]]:
    """Runs [first, last] of the window starts of one suffix."""
    edge = np.flatnonzero(np.diff(np.r_[False, marks, False].view(np.int8)))
    return [(place - int(b) + 1, place - int(a)) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def repeated_windows(rows: DataFrame, length: int) -> DataFrame:
    """(id, hash, first, last): runs of starts of windows of ``length`` bytes that start elsewhere too."""
    kind = rows.schema["id"].dataType.simpleString()
    suffixes = _table(sampled_suffixes(rows, length).withColumn("pick", F.xxhash64("id", "hash", "place")), "suffixes")
    classes = suffixes.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("n"), F.min("pick").alias("picked"))
    per_gram = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("k"))
    shared = classes.join(per_gram, "gram").where("n > 1 OR k > 1")
    met = _table(suffixes.join(shared, ["gram", "context"]).drop("context"), "suffix-classes")
    runs = "id {0}, hash long, first int, last int".format(kind)
    sure = met.where("n > 1").select("id", "hash", "first", "last")
    asked = met.where("k > 1 AND pick = picked").groupBy("id", "hash").agg(
        F.collect_set(F.struct("gram", (F.col("n") == 1).alias("alone"), (F.col("k") > GROUP).alias("hot"), "place", "first", "last")).alias("asked"))

    def tuples(batches):
        z = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for key, th, blob, want in zip(*(batch.column(c).to_pylist() for c in ("id", "hash", "z", "asked")), strict=True):
                data = z.decompress(blob)
                out += [(w["gram"], w["alone"], w["hot"], key, th, w["place"], data[w["first"]:w["place"]], data[w["place"]:w["last"] + length])
                        for w in want]
                if len(out) > CHUNK:
                    yield _batch(out, batch.schema.field("id").type)
                    out = []
            yield _batch(out, batch.schema.field("id").type)

    fields = f"gram long, alone boolean, hot boolean, id {kind}, hash long, place int, left binary, right binary"
    carried = _table(_joined(_zipped(rows), asked, "inner").mapInArrow(tuples, fields), "suffix-tuples")

    def sort_induced(batches):
        held: list[pa.RecordBatch] = []
        size = 0

        def done(table: pa.Table):
            left, right = table.column("left").to_pylist(), table.column("right").to_pylist()
            marked = induced(left, right, table.column("gram").to_numpy(), length)
            alone = table.column("alone").to_numpy()
            out = []
            for row in np.flatnonzero(marked.any(1) & alone).tolist():
                place = table.column("place")[row].as_py()
                out += [(table.column("id")[row].as_py(), table.column("hash")[row].as_py(), a, b) for a, b in _starts(marked[row], place)]
            return pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], table.schema.field("id").type), *(pa.array([o[k] for o in out], t) for k, t in ((1, pa.int64()), (2, pa.int32()), (3, pa.int32())))],
                ["id", "hash", "first", "last"])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= CHUNK:
                table = pa.Table.from_batches(held)
                gram = table.column("gram").to_numpy()
                cut = int(np.searchsorted(gram, gram[-1]))  # the last group may go on
                if cut:
                    yield done(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
                size = sum(b.num_rows for b in held)
        if held:
            yield done(pa.Table.from_batches(held))

    def windows(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                left, right, place = (batch.column(c)[row].as_py() for c in ("left", "right", "place"))
                data, at = left + right, place - len(left)
                digests = [xxhash.xxh3_128_digest(data[s:s + length]) for s in range(len(data) - length + 1)]
                n = len(digests)
                same = lambda c: batch.column(c).take(pa.array([row] * n, pa.int64()))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), same("alone"), same("id"), same("hash"), pa.array(range(at, at + n), pa.int32())],
                                                 ["window", "alone", "id", "hash", "first"])

    cold = carried.where("NOT hot").drop("hot").repartition("gram").sortWithinPartitions("gram", "right")
    hot = carried.where("hot").mapInArrow(windows, f"window binary, alone boolean, id {kind}, hash long, first int")
    again = hot.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window")
    of_hot = hot.where("alone").join(again, "window").select("id", "hash", "first", F.col("first").alias("last"))
    return sure.distinct().unionByName(cold.mapInArrow(sort_induced, runs)).unionByName(of_hot)


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = [("gram", pa.int64()), ("alone", pa.bool_()), ("hot", pa.bool_()), ("id", kind), ("hash", pa.int64()), ("place", pa.int32()), ("left", pa.binary()), ("right", pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(types)], [n for n, _ in types])


def dedup(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept binary, spans array<array<int>>) of each row."""
    rows = _keyed(df, id_column, text_column)
    kind = rows.schema["id"].dataType.simpleString()
    runs = repeated_windows(rows, length).groupBy("id", "hash").agg(F.collect_list(F.struct("first", "last")).alias("runs"))

    def cut(batches):
        z = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for blob, found in zip(batch.column("z").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                data, spans = z.decompress(blob), []
                for a, b in sorted((r["first"], r["last"] + length) for r in found or ()):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                at, parts = 0, []
                for a, b in spans:
                    parts.append(data[at:a])
                    at = b
                parts.append(data[at:])
                out.append((len(data), sum(b - a for a, b in spans), len(spans), b"".join(parts), spans))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array([o[k] for o in out], t) for k, t in enumerate(types))],
                                             ["id", "n_bytes", "n_removed", "n_spans", "kept", "spans"])

    met = _joined(_zipped(rows), runs, "left").select("id", "z", "runs")
    schema = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, spans array<array<int>>"
    return met.mapInArrow(cut, schema).withColumnRenamed("id", id_column)


def brute_force(texts: list[str | None], length: int = LENGTH) -> list[tuple[int, int, int, str]]:
    """(n_bytes, n_removed, n_spans, SHA-256 of what is kept) by listing every window; for tests."""
    seen: dict[bytes, int] = {}
    data = [(t or "").encode() for t in texts]
    for x in data:
        for s in range(len(x) - length + 1):
            seen[x[s:s + length]] = seen.get(x[s:s + length], 0) + 1
    out = []
    for x in data:
        gone = np.zeros(len(x), bool)
        for s in range(len(x) - length + 1):
            if seen[x[s:s + length]] > 1:
                gone[s:s + length] = True
        spans = int((np.diff(np.r_[False, gone].view(np.int8)) == 1).sum())
        kept = np.frombuffer(x, np.uint8)[~gone].tobytes()
        out.append((len(x), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out
