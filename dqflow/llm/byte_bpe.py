"""Byte-level BPE encoding and decoding.

Each task packs documents into blocks of bounded size and lists the distinct words (pre-tokens)
of a block.  Words are dealt to shards by hash, so that equal words of all blocks meet; there,
Spark's higher-order functions fold the ranked merges over the byte array of each distinct word.
The rank map is a row that a task makes of the rank file, broadcast to the folding tasks: as a
literal it would be in every description of the plan that the driver makes and keeps, and in every
task.  The ids of a block's words go back to it, as sizes and two bytes an id, and are laid out along
each document.  Texts are shuffled once, compressed, to meet their ids.

All requests of a shard are worked off together, so a word is folded once, a hot word as well as a
rare one; a shard of over ``FOLD_WORDS`` requests is cut, so no group is ever held whole.  A block is
known by a hash of its rows; if a second reading of the input should cut it differently the job
stops with an error instead of giving wrong ids.

Decoding concatenates the binary piece of each id.

Defined cases: null or empty text has no ids and decodes to empty bytes; null ids decode to empty
bytes; a null id or one outside the vocabulary is an error; repeated rows each give a row; an
empty table gives an empty result; further input columns are left out, whatever their names.
"""

from __future__ import annotations

import base64
import functools
import heapq
import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqflow.llm import pretokens
from dqflow.llm.frames import col, in_task, with_arrow_columns

#: Beyond the length of any word.
WHOLE = 1 << 30
#: Stands at both ends of a word while it is folded; no id, and above every id.
EDGE = 65535
#: An empty place of the rank map.  Only the pair 0, whose places are the first of each table, could
#: be taken for it, so these hold an entry of that pair with no id.
FREE = 0
#: Text bytes of a block, and requested words whose distinct ones are folded as one row.
BLOCK_BYTES = 4 << 20
FOLD_WORDS = 200_000
#: Words of a block whose ids are laid out at once (more, where one document has them).
LAID_OUT = 100_000
#: Bytes of a word that is folded; the fold's work grows with the square of a word's length, so a
#: longer word is merged by a heap where its document is laid out.
FOLD_BYTES = 256
#: Places of the rank map's two tables for each pair, at first, and by how much more if the pairs don't find theirs.
ROOM, MORE_ROOM = 1.06, 1.15


@functools.cache
def pieces_of(path: str) -> tuple[bytes, ...]:
    """The bytes of each id of a rank file (lines of base64 token and rank)."""
    with open(path, "rb") as f:
        found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    if sorted(found) != list(range(len(found))) or len(found) > EDGE:
        raise ValueError("ranks must be 0..n-1, at most 65535 of them")
    return tuple(found[i] for i in range(len(found)))


@functools.cache
def rank_map(path: str) -> tuple[str, tuple[int, int]]:
    """The rank map as JSON, and the sizes of its two tables.

    A pair of ids (``left * 65536 + right``) maps to the id of its concatenation.  Its entry,
    ``pair * 65536 + id``, lies at ``pair % size`` of one of the tables, so a look-up reads two
    places whatever the vocabulary's size.
    """
    pieces = pieces_of(path)
    ids = {p: i for i, p in enumerate(pieces)}
    pairs = {}
    for i, p in enumerate(pieces):
        for cut in range(1, len(p)):
            if (a := ids.get(p[:cut])) is not None and (b := ids.get(p[cut:])) is not None:
                pairs[a << 16 | b] = i
    room = ROOM
    while True:
        sizes = tuple(int(len(pairs) * room * share) + 101 | 1 for share in (1, 1.13))
        if tables := _placed(pairs, sizes):
            return json.dumps({"a": tables[0], "b": tables[1]}, separators=(",", ":")), sizes
        room *= MORE_ROOM


def _placed(pairs: dict[int, int], sizes: tuple[int, int]) -> list[list[int]] | None:
    """Two tables in which each pair has one of its two places."""
    none = pairs.get(0, EDGE)
    tables = [[none] + [FREE] * (size - 1) for size in sizes]
    for pair, value in pairs.items():
        if not pair:
            continue
        entry, side = pair << 16 | value, 0
        for _ in range(500):
            at = (entry >> 16) % sizes[side]
            if at:  # the first place is taken for good
                entry, tables[side][at] = tables[side][at], entry
            if entry == FREE:
                break
            side = 1 - side
        else:
            return None
    return tables


def merged(word: Column, tables: Column, sizes: tuple[int, int]) -> Column:
    """Ids of one word, given as the array of the ids of its bytes between two ``EDGE``.

    The fold keeps ``parts`` (ids) and ``ranks`` (of each neighbouring pair).  A step merges the
    leftmost pair of the lowest rank and looks up the two pairs that changed.
    """

    def rank(left: Column, right: Column) -> Column:
        # An entry of another pair, or none, differs above the lowest 16 bits: no rank.
        pair = F.shiftleft(left, 16).bitwiseOR(right)
        own = F.shiftleft(pair, 16)
        return F.least(*(F.get(tables[t], (pair % size).cast("int")).bitwiseXOR(own) for t, size in zip("ab", sizes, strict=True)))

    whole = F.lit(WHOLE)
    start = F.struct(word.alias("parts"), F.zip_with(F.slice(word, F.lit(1), F.size(word) - 1), F.slice(word, F.lit(2), whole), rank).alias("ranks"))

    def step(state: Column, _: Column) -> Column:
        def joined(x: Column) -> Column:
            parts, ranks, i, new = state["parts"], state["ranks"], x["i"], x["low"]
            return F.struct(
                F.concat(F.slice(parts, F.lit(1), i - 1), F.array(new), F.slice(parts, i + 2, whole)).alias("parts"),
                F.concat(F.slice(ranks, F.lit(1), i - 2), F.array(rank(F.get(parts, i - 2), new), rank(new, F.get(parts, i + 1))),
                         F.slice(ranks, i + 2, whole)).alias("ranks"))

        def merge(low: Column) -> Column:
            at = F.array_position(state["ranks"], low).cast("int")
            bound = F.transform(F.array(F.struct(at.alias("i"), low.alias("low"))), joined)
            return F.when(low >= EDGE, state).otherwise(F.get(bound, F.lit(0)))

        return F.get(F.transform(F.array(F.array_min(state["ranks"])), merge), F.lit(0))

    return F.aggregate(word, start, step, lambda state: state["parts"])


def encode(df: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", packed: bool = False,
           decoded: bool = False) -> DataFrame:
    """(id, ids array<int>) of each row; ``packed``: ids as little-endian unsigned 32-bit integers in
    a binary; ``decoded``: with the column that ``decode`` makes of the ids, in the same tasks.
    ``vocabulary``: a rank file on every machine."""
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = 2 * tasks
    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(col(id_column).alias("id"), F.coalesce(col(text_column), F.lit("")).alias("text"))

    def blocks(batches):
        """(block, its rows); a block is known by a hash of what it holds."""
        for batch in pretokens.by_bytes(batches, most=BLOCK_BYTES):
            held = _stream(batch)
            yield xxhash.xxh64_intdigest(held) - 2**63, batch, held

    def asked(batches):
        for block, batch, _ in blocks(batches):
            _, _, words = pretokens.distinct(batch.column("text").to_pylist())
            words = words.filter(_folded(words))
            if not len(words):
                continue
            shard = _shards(words, shards)
            order = np.argsort(shard, kind="stable")
            cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
            for a, b in itertools.pairwise([*cuts.tolist(), len(order)]):
                yield _rows(block=[block], shard=[int(shard[order[a]])], blob=[_packed(words.take(pa.array(order[a:b])))])

    def kept(batches):
        for block, _, held in blocks(batches):
            yield _rows(block=[block], shard=[-1], blob=[_zip(held)])

    def gathered(batches):
        """Distinct words of a shard's requests, spelled in ids of bytes, and where each request's words are among them."""
        held, size, now = [], 0, None
        first = np.array([pieces_of(vocabulary).index(bytes([b])) for b in range(256)], np.int32)

        def row():
            every = pa.concat_arrays([w for _, w in held]).dictionary_encode()
            data, offsets = pretokens.ragged(every.dictionary)
            n = np.diff(offsets)
            spelled = np.full(len(data) + 2 * len(n), EDGE, np.int64)
            place = np.arange(len(data)) + np.repeat(2 * np.arange(len(n)) + 1, n)
            spelled[place] = first[data]
            ends = offsets + 2 * np.arange(len(offsets))
            return _rows(
                shard=[now], blocks=[np.array([b for b, _ in held]).tobytes()], sizes=[np.array([len(w) for _, w in held], np.int32).tobytes()],
                index=[every.indices.to_numpy().astype(np.int32).tobytes()],
                words=pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(spelled))))

        for batch in batches:
            for block, shard, blob in _each(batch):
                if held and (shard != now or size >= FOLD_WORDS):
                    yield row()
                    held, size = [], 0
                now, words = shard, _unpacked(blob)
                held.append((block, words))
                size += len(words)
        if held:
            yield row()

    def answered(batches):
        """Each request with the sizes of its words and their ids."""
        for batch in batches:
            for i in range(batch.num_rows):
                flat = np.asarray(batch.column("ids")[i].values)
                edges = np.flatnonzero(flat == EDGE)
                begin, n = edges[::2] + 1, edges[1::2] - edges[::2] - 1
                flat = flat.astype("<u2")
                blocks, sizes, index = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in (("blocks", np.int64), ("sizes", np.int32), ("index", np.int32)))
                shard = batch.column("shard")[i].as_py()
                for block, some in zip(blocks.tolist(), np.split(index, np.cumsum(sizes)[:-1]), strict=True):
                    ids, size = _taken(flat, begin[some], n[some])
                    yield _rows(block=[block], shard=[shard], blob=[_zip(len(size).to_bytes(4, "little") + size.astype("<u2").tobytes() + ids.tobytes())])

    def laid_out(batches):
        now, texts, answers = None, [], {}  # equal blocks are one block with several texts
        for batch in itertools.chain(batches, [None]):
            for row in range(batch.num_rows if batch is not None else 1):
                block, shard = (batch.column(c)[row].as_py() for c in ("block", "shard")) if batch is not None else (None, 0)
                if block != now:
                    if texts:
                        for out in _ids_of(pa.ipc.open_stream(_unzip(texts[0])).read_next_batch(), answers, shards, vocabulary, packed):
                            if decoded:
                                out = out.append_column("decoded", _decoded(out.column("ids"), vocabulary))
                            yield from itertools.repeat(out, len(texts))
                    now, texts, answers = block, [], {}
                if block is None:
                    break
                if shard < 0:
                    texts.append(batch.column("blob")[row].as_py())
                else:
                    raw = _unzip(batch.column("blob")[row].as_py())
                    n = int.from_bytes(raw[:4], "little")
                    answers[shard] = np.frombuffer(raw, "<u2", n, 4).astype(np.int32), np.frombuffer(raw, "<u2", -1, 4 + 2 * n)

    def ranked(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([rank_map(vocabulary)[0]])], ["ranks"])

    tables = spark.range(0, 1, 1, 1).mapInArrow(in_task(ranked), "ranks string")
    tables = tables.select(F.from_json("ranks", "a array<bigint>, b array<bigint>").alias("ranks")).select("ranks.a", "ranks.b")
    sizes = rank_map(vocabulary)[1]
    blob = "block long, shard int, blob binary"
    requests = rows.mapInArrow(in_task(asked), blob).repartition(tasks, "shard").sortWithinPartitions("shard")
    listed = requests.mapInArrow(in_task(gathered), "shard int, blocks binary, sizes binary, index binary, words array<array<bigint>>")
    # The outer transform binds the tables once for a row.
    folded = F.transform(F.array(F.struct("a", "b")), lambda t: F.flatten(F.transform("words", lambda w: merged(w, t, sizes))))
    answers = listed.crossJoin(F.broadcast(tables)).select("shard", "blocks", "sizes", "index", F.get(folded, F.lit(0)).alias("ids")).mapInArrow(in_task(answered), blob)
    spread = answers.unionByName(rows.mapInArrow(in_task(kept), blob)).repartition(tasks, "block").sortWithinPartitions("block", "shard")
    schema = f"id {kind}, ids {'binary' if packed else 'array<int>'}" + ", decoded binary" * decoded
    return spread.mapInArrow(in_task(laid_out), schema).withColumnRenamed("id", id_column)


def _each(batch: pa.RecordBatch):
    """The batch's rows one by one; blobs are copied only when their turn comes."""
    columns = [batch.column(c) for c in ("block", "shard", "blob")]
    for row in range(batch.num_rows):
        yield tuple(c[row].as_py() for c in columns)


def _stream(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _zip(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unzip(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _rows(**columns) -> pa.RecordBatch:
    types = {"block": pa.int64(), "shard": pa.int32()}
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, types.get(k, pa.binary())) for k, v in columns.items()], list(columns))


def _shards(words: pa.Array, shards: int) -> np.ndarray:
    """Shard of each word, by its bytes alone."""
    data, offsets = pretokens.ragged(words)
    n = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], n)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(int(n.max()), 0x9E3779B97F4A7C15, np.uint64))
        value = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * power[place], offsets[:-1])
        value = (value ^ value >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((value >> np.uint64(33)) % np.uint64(shards)).astype(np.int32)


def _packed(words: pa.Array) -> bytes:
    data, offsets = pretokens.ragged(words)
    return _zip(len(words).to_bytes(4, "little") + np.diff(offsets).astype("<u4").tobytes() + data.tobytes())


def _unpacked(blob: bytes) -> pa.Array:
    raw = _unzip(blob)
    n = int.from_bytes(raw[:4], "little")
    offsets = np.append(0, np.cumsum(np.frombuffer(raw, "<u4", n, 4))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(raw[4 + 4 * n:])])


def _taken(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``values[begin:begin + size]`` end to end, and their sizes."""
    ends = np.cumsum(size)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)], size


def _folded(words: pa.Array) -> pa.Array:
    return pa.compute.less_equal(pa.compute.binary_length(words), FOLD_BYTES)


@functools.cache
def _ranks(path: str) -> dict[bytes, int]:
    return {p: i for i, p in enumerate(pieces_of(path))}


def merged_long(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word of any length; the pairs wait in a heap by rank, then place."""
    n = len(data)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    rank = [ranks.get(data[i:i + 2]) if i + 1 < n else None for i in range(n)]
    heap = [(r, i) for i, r in enumerate(rank) if r is not None]
    heapq.heapify(heap)
    while heap:
        r, i = heapq.heappop(heap)
        if rank[i] != r:  # merged or changed since
            continue
        j = after[i]
        k = after[i] = after[j]
        rank[j] = None
        if k < n:
            before[k] = i
        for x, end in ((i, after[k] if k < n else None), (before[i], k)):
            if x >= 0:
                rank[x] = ranks.get(data[x:end]) if end is not None else None
                if rank[x] is not None:
                    heapq.heappush(heap, (rank[x], x))
    out, i = [], 0
    while i < n:
        out.append(ranks[data[i:after[i]]])
        i = after[i]
    return out


def _ids_of(batch: pa.RecordBatch, answers: dict, shards: int, vocabulary: str, packed: bool) -> Iterator[pa.RecordBatch]:
    """Ids of a block's documents from the answers (sizes, ids) of the shards to its words, some documents at a time."""
    index, pieces, words = pretokens.distinct(batch.column("text").to_pylist())
    folded = np.asarray(_folded(words))
    short, long = np.flatnonzero(folded), np.flatnonzero(~folded)
    shard = _shards(words.filter(pa.array(folded)), shards) if len(short) else np.zeros(0, np.int32)
    place = np.empty(len(words), np.int32)
    place[np.r_[short[np.argsort(shard, kind="stable")], long]] = np.arange(len(words), dtype=np.int32)
    wanted, n = np.unique(shard, return_counts=True)
    if sorted(answers) != wanted.tolist() or any(len(answers[s][0]) != k for s, k in zip(wanted.tolist(), n.tolist(), strict=True)):
        raise RuntimeError("the input was cut into other blocks when it was read again; write it to a table first")
    found = [answers[s] for s in wanted.tolist()]
    for w in long.tolist():
        ids = merged_long(words[w].as_py(), _ranks(vocabulary))
        found.append((np.array([len(ids)], np.int32), np.array(ids, np.uint16)))
    if not found:
        found = [(np.zeros(0, np.int32), np.zeros(0, np.uint16))]
    sizes, tokens = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    begin = (np.cumsum(sizes) - sizes).astype(np.int64)
    after = np.append(0, np.cumsum(pieces))
    rows = np.flatnonzero(np.diff(after[:-1] // LAID_OUT, prepend=-1))
    for first, last in itertools.pairwise([*rows.tolist(), batch.num_rows]):
        some = place[index[after[first]:after[last]]]
        out, size = _taken(tokens, begin[some], sizes[some].astype(np.int64))
        ends = np.append(0, np.cumsum(size))[after[first:last + 1] - after[first]]
        out = out.astype("<u4")
        if packed:
            ids = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(out)])
        else:
            ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(out.view(np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column("id").slice(first, last - first), ids], ["id", "ids"])


def decode(df: DataFrame, vocabulary: str, ids_column: str = "ids") -> DataFrame:
    """``df`` with the binary column ``decoded``: the pieces of its ids (an array or packed), end to end."""

    return with_arrow_columns(df, "decoded binary", lambda batch: [_decoded(batch.column(ids_column), vocabulary)])


def _decoded(column: pa.Array, vocabulary: str) -> pa.Array:
    pieces = pieces_of(vocabulary)
    size = np.array([len(p) for p in pieces], np.int64)
    data, begin = np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(size) - size
    out = []
    for row in column:
        if not row.is_valid:
            ids = np.zeros(0, np.int64)
        elif pa.types.is_binary(row.type):
            ids = np.frombuffer(row.as_buffer(), "<u4")
        elif row.values.null_count:
            raise ValueError("an id is null")
        else:
            ids = np.asarray(row.values)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(size)):
            raise ValueError("an id is outside the vocabulary")
        out.append(_taken(data, begin[ids], size[ids])[0].tobytes())
    return pa.array(out, pa.binary())
