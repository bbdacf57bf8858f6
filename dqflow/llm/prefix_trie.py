"""The trie of conversations that start alike.

Every distinct sequence of first turns is a node; the conversations that start with it are its
members.  A prefix is known by two 64-bit digests, the exclusive or of hashes of its turns with
their places, so prefixes follow from running sums that can be split anywhere.

1. Turns are sorted by ranges of (conversation, turn, role, text), so that a conversation with any
   share of all rows lies over many tasks; places in a conversation are the place in the range plus
   the rows of it in earlier ranges.  From here on a turn is its hash and its length.
2. Digests are running sums over chunks of ``CHUNK`` turns; a sum of chunks comes before.
3. Each task counts its prefixes in a count-min sketch of two rows whose counters stop at two;
   sketches meet as pairs of bitmaps, cut into segments.  The driver gets one bit for a counter
   (``MOST_CELLS`` bound them, 16 MB), and hands them to all tasks.
4. An estimate of one proves that a prefix has one member.  All longer prefixes of that
   conversation are then its own too: they are emitted as they are read, without a shuffle.  Only the
   prefixes before are shuffled and grouped exactly, by partial aggregates.  A sketch that is too
   full for its table screens less, and more prefixes are grouped exactly; results stay the same.
5. A node is counted at its smallest member.  So the sums over a subtree need no walk: each node's
   share goes to the row (smallest member, depth), a running sum from the end of a
   conversation gathers those below, and a second grouping adds the members' sums.
6. The ids of members that end at a node are joined in buckets of ``BUCKET`` ids, and the buckets
   are hashed one after another: a digest over a hot node streams through one task, in bounded memory.

Defined cases: rows without a conversation id are left out; a null role or text is empty; turns go
by turn (null first), then role, then text; repeated rows are turns of their own; a conversation may be
empty after it was rebuilt and is then a member of the root alone; an empty table gives no node.
Texts of any length count whole.  Further columns are left out, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dqflow.session import scratch_path

#: Turns of a conversation whose digests one task makes together.
CHUNK = 1024
#: Counters for each prefix, and counters of a row of the sketch at most and at least.
CELLS_EACH = 8
MOST_CELLS = 1 << 26
LEAST_CELLS = 1 << 14
#: Parts in which the sketches of all tasks are merged.
SEGMENTS = 16
#: Ids that are joined as one text, as a power of two.
BUCKET = 16

KEY = ("depth", "hi", "lo")


def placed_turns(df: DataFrame) -> DataFrame:
    """(conv_id, place, n_turns, hash, n_bytes) of each turn of (conv_id, turn, role, text)."""
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    # The last key parts equal rows.
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text", "same"]
    ranged = rows.where("conv_id IS NOT NULL").withColumn("same", F.monotonically_increasing_id()).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    turns = ranged.select(
        F.spark_partition_id().alias("part"), "conv_id", F.octet_length("text").cast("long").alias("n_bytes"),
        F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit("\n"), "role", "text"))).alias("hash"))

    def counted(batches):
        last, n = None, 0
        for batch in batches:
            ids = np.asarray(batch.column("conv_id"))
            if not len(ids):
                continue
            first = np.flatnonzero(np.diff(ids, prepend=ids[0]) != 0)
            first = np.concatenate([[0], first])
            place = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids)))) + 1
            if last == ids[0]:
                place[:first[1] if len(first) > 1 else len(ids)] += n
            last, n = ids[-1], place[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*batch.schema.names, "own"])

    local = _written(turns.mapInArrow(counted, "part int, conv_id long, n_bytes long, hash binary, own long"), "turns")
    whole = Window.partitionBy("conv_id")
    ranges = local.groupBy("conv_id", "part").agg(F.max("own").alias("n"))
    ranges = ranges.select(
        "conv_id", "part", F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("n_turns"))
    return local.join(ranges, ["conv_id", "part"]).select("conv_id", (F.col("before") + F.col("own")).alias("place"), "n_turns", "hash", "n_bytes")


def with_shared_heads(turns: DataFrame, base: Column, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: the first ``heads`` (at most ``most``) turns of conversation ``base``, then its own
    turns after its first ``heads``.  Both are columns of ``conv_id``.

    Returns (conv_id, n_turns), and (conv_id, n_turns, depth, hash, n_bytes) of each turn.
    """
    turns = _written(turns, "placed")
    own = turns.where("place = 1").select("conv_id", F.col("n_turns").alias("own"), base.alias("base"), heads.alias("heads"))
    there = own.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    convs = own.join(there, "base", "left").withColumn("kept", F.least("heads", F.coalesce("there", F.lit(0))))
    convs = _written(convs.select("conv_id", "base", "heads", "kept", (F.col("kept") + F.greatest(F.col("own") - F.col("heads"), F.lit(0))).alias("n_turns")), "conversations")
    columns = ("conv_id", "n_turns", "depth", "hash", "n_bytes")
    after = turns.drop("n_turns").withColumn("heads", heads).where("place > heads").drop("heads").join(convs, "conv_id")
    after = after.withColumn("depth", F.col("place") - F.col("heads") + F.col("kept")).select(*columns)
    first = turns.where(F.col("place") <= most).select(F.col("conv_id").alias("base"), F.col("place").alias("depth"), "hash", "n_bytes")
    first = first.join(convs, "base").where("depth <= heads").select(*columns)
    return convs.select("conv_id", "n_turns"), after.unionByName(first)


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """A row for each node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    ``convs``: (conv_id, n_turns); ``turns``: (conv_id, n_turns, depth, hash, n_bytes), depths from 1.
    """
    prefixes = _written(_prefixes(turns), "prefixes")
    screened = _written(_screened(prefixes), "screened")
    root = convs.select("conv_id", "n_turns", *[F.lit(0).cast("long").alias(c) for c in ("depth", "hi", "lo", "up_hi", "up_lo", "n_bytes")])
    shared = screened.where("tail = 0").drop("tail").unionByName(root)
    tails = screened.where("tail > 0")
    nodes = _written(shared.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.count_if(F.col("depth") == F.col("n_turns")).alias("n_ends"),
        F.max("n_bytes").alias("n_bytes"), F.max("up_hi").alias("up_hi"), F.max("up_lo").alias("up_lo")), "nodes")
    up = [(F.col("depth") - 1).alias("depth"), F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo")]
    heads = tails.where("tail = 1")
    children = nodes.select(*up).unionByName(heads.select(*up)).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("conv_id").alias("parent_conv_id"))
    nothing = F.sha2(F.lit(""), 256)
    inner = (nodes.join(_below(shared, tails, nodes), list(KEY)).join(children, list(KEY), "left").join(_ends(shared), list(KEY), "left")
             .join(parents, ["depth", "up_hi", "up_lo"], "left"))
    inner = inner.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id")).alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
    last = F.col("depth") == F.col("n_turns")

    def single(rows: DataFrame, parent: Column) -> DataFrame:
        one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
        return rows.select(
            "conv_id", "depth", parent.alias("parent_conv_id"), one.alias("n_convs"), F.when(last, none).otherwise(one).alias("n_children"), one.alias("n_leaves"),
            none.alias("saved_tokens"), F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(nothing).alias("ends_sha256"))

    # A parent that was not grouped is of this conversation alone.
    first = single(heads.join(parents, ["depth", "up_hi", "up_lo"], "left"), F.coalesce("parent_conv_id", "conv_id"))
    return inner.unionByName(first).unionByName(single(tails.where("tail = 2"), F.col("conv_id")))


def _running(rows: DataFrame, values: dict[str, Column], agg, descending: bool) -> DataFrame:
    """``rows`` with running aggregates of ``values`` along each conversation's depths, this row included.

    A long conversation is cut into chunks; sums of whole chunks come from a partial aggregate.
    """
    chunked = rows.withColumn("chunk", F.floor(F.col("depth") / CHUNK)).withColumns(values)
    along = lambda c: F.desc(c) if descending else F.asc(c)
    sums = chunked.groupBy("conv_id", "chunk").agg(*[agg(c).alias(c) for c in values])
    earlier = Window.partitionBy("conv_id").orderBy(along("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("conv_id", "chunk", *[agg(c).over(earlier).alias(f"{c}_before") for c in values]).where(" OR ".join(f"{c}_before <> 0" for c in values))
    inner = Window.partitionBy("conv_id", "chunk").orderBy(along("depth")).rowsBetween(Window.unboundedPreceding, 0)
    return chunked.join(before, ["conv_id", "chunk"], "left").withColumns({c: agg(c).over(inner) for c in values})


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, depth, hi, lo, up_hi, up_lo, n_bytes) of each prefix, a conversation's in order; ``up_``: of the prefix before."""
    sides = {"hi": F.xxhash64(F.lit(1), "depth", "hash"), "lo": F.xxhash64(F.lit(2), "depth", "hash")}
    own = turns.select("*", *[c.alias(f"own_{n}") for n, c in sides.items()]).drop("hash")
    done = _running(own, {n: F.col(f"own_{n}") for n in sides}, F.bit_xor, descending=False)
    whole = {n: F.col(n).bitwiseXOR(F.coalesce(F.col(f"{n}_before"), F.lit(0))) for n in sides}
    return done.select("conv_id", "n_turns", "depth", *[whole[n].alias(n) for n in sides], *[whole[n].bitwiseXOR(F.col(f"own_{n}")).alias(f"up_{n}") for n in sides], "n_bytes")


def _screened(prefixes: DataFrame) -> DataFrame:
    """``prefixes`` with ``tail``: 0 if several conversations may share it, 1 if it is proven to be of one and
    begins a run of such prefixes, 2 if it goes on with such a run."""
    cells = LEAST_CELLS
    wanted = CELLS_EACH * prefixes.count()
    while cells < min(wanted, MOST_CELLS):
        cells *= 2
    several = _several(prefixes, cells)

    def marked(batches):
        last, depth, inside = None, 0, False
        for batch in batches:
            ids, depths = np.asarray(batch.column("conv_id")), np.asarray(batch.column("depth"))
            one = ~np.logical_and.reduce([_bit(several[r], at) for r, at in enumerate(_cells(batch, cells))])
            tail = np.zeros(len(ids), np.int32)
            starts = np.flatnonzero((np.diff(ids, prepend=ids[:1]) != 0) | (np.diff(depths, prepend=depths[:1]) != 1))
            if not len(starts) or starts[0]:
                starts = np.append(0, starts)
            run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ids))))
            if len(ids):
                goes_on = inside and last == ids[0] and depth + 1 == depths[0]
                # Rows from the first proven one of their run on.
                proven = np.cumsum(one) - np.repeat((np.cumsum(one) - one)[starts], np.diff(np.append(starts, len(ids)))) > 0
                if goes_on:
                    proven[run == 0] = True
                before = np.append(goes_on, proven[:-1])
                before[starts[1:]] = False
                tail = np.where(proven, np.where(before, 2, 1), 0).astype(np.int32)
                last, depth, inside = ids[-1], depths[-1], bool(proven[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tail)], [*batch.schema.names, "tail"])

    return prefixes.mapInArrow(marked, "conv_id long, n_turns long, depth long, hi long, lo long, up_hi long, up_lo long, n_bytes long, tail int")


def _cells(batch: pa.RecordBatch, cells: int) -> list[np.ndarray]:
    return [np.asarray(batch.column(c)) & (cells - 1) for c in ("hi", "lo")]


def _bit(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _several(prefixes: DataFrame, cells: int) -> list[np.ndarray]:
    """For each row of the sketch one bit for a counter: it is two or more."""
    size = cells // SEGMENTS

    def sketched(batches):
        counts = [np.zeros(cells, np.uint8) for _ in range(2)]
        for batch in batches:
            for row, at in zip(counts, _cells(batch, cells), strict=True):
                found, n = np.unique(at, return_counts=True)
                row[found] = np.minimum(2, row[found] + np.minimum(2, n)).astype(np.uint8)
        press = zstandard.ZstdCompressor(level=1)
        for r, row in enumerate(counts):
            for s, part in enumerate(row.reshape(SEGMENTS, size)):
                if part.any():
                    planes = np.stack([np.packbits(part >= k, bitorder="little") for k in (1, 2)])
                    yield _segment(r * SEGMENTS + s, press.compress(planes.tobytes()))

    def merged(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch.column("segment").to_pylist(), batch.column("data"), strict=True):
                once, twice = np.frombuffer(zstandard.ZstdDecompressor().decompress(data.as_py()), np.uint8).reshape(2, -1)
                if k in held:
                    held[k][1] |= twice | (held[k][0] & once)
                    held[k][0] |= once
                else:
                    held[k] = np.stack([once, twice])
        for k, (_, twice) in held.items():
            yield _segment(k, twice.tobytes())

    schema = "segment int, data binary"
    parts = prefixes.select("hi", "lo").mapInArrow(sketched, schema).repartition(SEGMENTS, "segment").mapInArrow(merged, schema)
    out = np.zeros((2 * SEGMENTS, size // 8), np.uint8)
    for row in parts.collect():  # MOST_CELLS bound these bits
        out[row.segment] = np.frombuffer(row.data, np.uint8)
    return [part.ravel() for part in out.reshape(2, -1)]


def _segment(k: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([data], pa.binary())], ["segment", "data"])


def _below(shared: DataFrame, tails: DataFrame, nodes: DataFrame) -> DataFrame:
    """(n_leaves, saved_tokens) over the subtree of each grouped node."""
    zero = F.lit(0).cast("long")
    # Of a tail that reaches its conversation's end only that end counts: as a leaf.
    ends = tails.where("depth = n_turns").select("conv_id", "depth", *[F.lit(None).cast("long").alias(c) for c in ("hi", "lo")])
    own = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"), (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf"))
    rows = shared.select("conv_id", *KEY).join(own, ["conv_id", "depth"], "left").unionByName(
        ends.withColumns({"saved": zero, "leaf": F.lit(1).cast("long")}))
    values = {"saved_tokens": F.coalesce("saved", zero), "n_leaves": F.coalesce("leaf", zero)}
    done = _running(rows, values, F.sum, descending=True).where("hi IS NOT NULL")
    return done.groupBy(*KEY).agg(*[F.sum(F.col(c) + F.coalesce(F.col(f"{c}_before"), zero)).alias(c) for c in values])


def _ends(shared: DataFrame) -> DataFrame:
    """ends_sha256 of each grouped node at which a conversation ends."""
    ending = shared.where("depth = n_turns").select(*KEY, "conv_id", F.shiftright("conv_id", BUCKET).alias("bucket"))
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    joined = ending.groupBy(*KEY, "bucket").agg(ids.alias("ids"))
    tasks = int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def hashed(batches):
        key, state = None, None
        row = lambda: pa.RecordBatch.from_arrays([*(pa.array([k], pa.int64()) for k in key), pa.array([state.hexdigest()])], [*KEY, "ends_sha256"])
        for batch in batches:
            for *now, text in zip(*(batch.column(c).to_pylist() for c in KEY), batch.column("ids"), strict=True):
                if now != key:
                    if key is not None:
                        yield row()
                    key, state = now, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.as_buffer())
        if key is not None:
            yield row()

    dealt = joined.repartition(tasks, *KEY).sortWithinPartitions(*KEY, "bucket")
    return dealt.mapInArrow(hashed, "depth long, hi long, lo long, ends_sha256 string")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"trie-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
