"""Exact top-k search by inner product over a bit-sliced index.

Every vector is rounded down to steps of 1/1024 and every row is indexed: blocks of up to
``BLOCK_ROWS`` rows hold, for each dimension, the bits of the component (less the block's
smallest) as bitmaps over the rows.  Queries are dealt to blocks of about ``QUERIES``; each query
block meets each index block once, by a shuffle on (query block, lane).

A query's scores over a block are a weighted sum of the attributes.  The weights are written in
signed binary digits, a negative digit adds the complement of a slice, and only the ``KEPT`` most
significant bits of an attribute are added (carry-save adders over whole bitmaps).  The k-th
largest of these sums is found from the most significant slice downward.  What the dropped bits
can add is bounded by the sum of the weights, so every row above the k-th sum less that bound is
resolved exactly, from all slices.  No row that belongs to the result is ever left out: recall
is 1, no cap is set on candidates, and equal scores go by the smaller id.

Blocks have a bounded number of rows and bytes and each yields at most k rows for a query; Spark's
window limit cuts these per task before the last shuffle, which is by query row.  Nothing is
broadcast.  The rounded rows are written to the shared folder once, so a lost executor costs its
tasks alone.

Defined cases: vectors that are null, hold a null or non-finite component or are so long that a
score might not fit a long take no part; shorter vectors are filled with zeros, empty ones score
0.  A null id is no query; as a candidate it comes after all others of its score.  Rows that repeat
an id are rows of their own: each is a query, and each is a candidate of the other.  An
empty table gives an empty result.  Further columns are left out, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dqflow.llm import vectors
from dqflow.llm.frames import col
from dqflow.session import scratch_path

#: Rows and bytes (4 for each component) of an index block.
BLOCK_ROWS = 16384
BLOCK_BYTES = 8 << 20
#: Queries of a query block, on average.
QUERIES = 512
#: Most significant bits of an attribute that are added.
KEPT = 8
#: Rows resolved exactly at a time.
RESOLVED = 2048
#: Rows of a word.
WORD = 64


def top_k(df: DataFrame, k: int, is_query: Column, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of highest score for each row where ``is_query``."""
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _numbered(df, is_query, id_column, vector_column)
    wanted = rows.where("query")
    parts = max(1, -(-wanted.count() // QUERIES))
    lanes = max(1, -(-4 * tasks // parts))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    layout = "kind int, lane int, first long, size int, bits int, ids binary, own binary, low binary, data binary"
    index = rows.mapInArrow(_blocks(lanes), layout).withColumn("part", numbers(parts))
    asked = (wanted.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))
             .repartition(tasks, "part").sortWithinPartitions("part")
             .mapInArrow(_asked, "part int, size int, ids binary, own binary, data binary"))
    none = {"kind": "int", "first": "long", "bits": "int", "low": "binary"}
    asked = asked.withColumn("lane", numbers(lanes)).withColumns({n: F.lit(0 if n == "kind" else None).cast(t) for n, t in none.items()})
    met = index.unionByName(asked).repartition(max(tasks, min(parts * lanes, 4 * tasks)), "part", "lane").sortWithinPartitions("part", "lane", "kind")
    found = met.mapInArrow(_searched(k), "query_row long, query_id long, row long, vec_id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _numbered(df: DataFrame, is_query: Column, id_column: str, vector_column: str) -> DataFrame:
    """(row, id, query, steps) of the vectors that take part, written once."""
    dims = vectors.dimensions(df, vector_column)
    given = df.select(col(id_column).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("query"), col(vector_column).cast("array<double>").alias("v"))

    def rounded(batches):
        for batch in batches:
            taken, steps = vectors.steps(batch.column("v"), dims)
            some = batch.select(["id", "query"]).take(pa.array(taken))
            data = pa.array([r.tobytes() for r in steps.astype("<i4")], pa.binary())
            yield pa.RecordBatch.from_arrays([*some.columns, data], ["id", "query", "steps"])

    path = scratch_path(df.sparkSession, "steps")
    done = given.where(F.col("v").isNotNull()).mapInArrow(rounded, "id long, query boolean, steps binary")
    done.withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    return df.sparkSession.read.schema("id long, query boolean, steps binary, row long").parquet(path)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    data = b"".join(batch.column("steps").to_pylist())
    return np.frombuffer(data, "<i4").reshape(batch.num_rows, -1)


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    """Ids of the rows; the smallest long stands for null."""
    return np.asarray(batch.column("id").fill_null(-2**63))


def _blocks(lanes: int):
    def run(batches):
        held, size = [], 0
        for batch in batches:
            while batch.num_rows:
                width = max(4, len(batch.column("steps")[0].as_py()))
                room = max(1, min(BLOCK_ROWS, BLOCK_BYTES // width)) - size
                held.append(batch.slice(0, room))
                size, batch = size + held[-1].num_rows, batch.slice(room)
                if held[-1].num_rows == room:
                    yield _block(held, lanes)
                    held, size = [], 0
        if held:
            yield _block(held, lanes)

    return run


def sliced(steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest value of each dimension; bitmaps of what exceeds it, as (bit, dimension, word)."""
    n, dims = steps.shape
    steps = steps.astype(np.int64)
    low = steps.min(axis=0)
    over = (steps - low).astype(np.uint32).T
    bits = int(over.max(initial=0)).bit_length()
    words = -(-n // WORD)
    out = np.zeros((bits, dims, words * 8), np.uint8)
    for b in range(bits):
        out[b, :, :-(-n // 8)] = np.packbits((over >> np.uint32(b)) & np.uint32(1), axis=1, bitorder="little")
    return low, out.view(np.uint64)


def _block(held: list[pa.RecordBatch], lanes: int) -> pa.RecordBatch:
    batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    low, slices = sliced(_matrix(batch))
    own = np.asarray(batch.column("row"))
    lane = int(np.random.default_rng(int(own[0])).integers(lanes))
    return _row(kind=1, lane=lane, first=int(own[0]), size=batch.num_rows, bits=len(slices), ids=_ids(batch).tobytes(), own=own.tobytes(),
                low=low.tobytes(), data=slices.tobytes())


def _asked(batches):
    """A query block for each part; its rows come together."""
    part, held = None, []

    def row():
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        return _row(part=part, size=batch.num_rows, ids=_ids(batch).tobytes(), own=np.asarray(batch.column("row")).tobytes(), data=_matrix(batch).tobytes())

    for batch in batches:
        parts = np.asarray(batch.column("part"))
        for some in np.split(np.arange(len(parts)), np.flatnonzero(np.diff(parts)) + 1):
            if len(some):
                if held and parts[some[0]] != part:
                    yield row()
                    held = []
                part = int(parts[some[0]])
                held.append(batch.slice(int(some[0]), len(some)))
    if held:
        yield row()


def _row(**values) -> pa.RecordBatch:
    types = {"kind": pa.int32(), "part": pa.int32(), "lane": pa.int32(), "first": pa.int64(), "size": pa.int32(), "bits": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array([v], types.get(k, pa.binary())) for k, v in values.items()], list(values))


def _searched(k: int):
    def run(batches):
        asked = key = None
        for batch in batches:
            for i in range(batch.num_rows):
                kind, part, lane, size, bits = (batch.column(c)[i].as_py() for c in ("kind", "part", "lane", "size", "bits"))
                read = lambda name, form=np.int64: np.frombuffer(batch.column(name)[i].as_buffer(), form)  # noqa: B023, E731
                if kind == 0:
                    asked, key = (read("ids").copy(), read("own").copy(), read("data", "<i4").reshape(size, -1).astype(np.int64)), (part, lane)
                    continue
                if key != (part, lane):
                    continue  # no query was dealt to this part
                block = Block(read("ids"), read("own"), read("low"), read("data", np.uint64).reshape(bits, len(read("low")), -1))
                found = [block.best(q, own, k) for q, own in zip(asked[2], asked[1], strict=True)]
                sizes = [len(f[0]) for f in found]
                ids, at = np.concatenate([block.ids[f[0]] for f in found]), np.concatenate([f[0] for f in found])
                columns = [np.repeat(asked[1], sizes), np.repeat(asked[0], sizes), block.own[at], ids, np.concatenate([f[1] for f in found])]
                arrays = [pa.array(c, mask=(ids == -2**63) if j == 3 else None) for j, c in enumerate(columns)]
                yield pa.RecordBatch.from_arrays(arrays, ["query_row", "query_id", "row", "vec_id", "score"])

    return run


class Block:
    """An index block: ids, row numbers, smallest components and slices (bit, dimension, word)."""

    def __init__(self, ids: np.ndarray, own: np.ndarray, low: np.ndarray, slices: np.ndarray):
        self.ids, self.own, self.low, self.slices = ids, own, low, slices
        self.dropped = max(0, len(slices) - KEPT)
        self.every = np.zeros(-(-len(ids) // WORD) * WORD, np.uint8)
        self.every[:len(ids)] = 1

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` best rows but ``own``; ties go by id."""
        there = self.every
        if len(mine := np.flatnonzero(self.own == own)):
            there = there.copy()
            there[mine] = 0
        there = np.packbits(there, bitorder="little").view(np.uint64)
        sums = self.added(query)
        least = kth_largest(sums, there, k)
        if least is not None:
            # Dropped bits add less than 2^dropped for each unit of weight.
            left = (int(np.abs(query).sum()) * ((1 << self.dropped) - 1)) >> self.dropped
            there = not_below(sums, there, least - left)
        at = np.flatnonzero(np.unpackbits(there.view(np.uint8), bitorder="little"))
        score = self.exact(query, at)
        # Null ids (the smallest long) come last; the sort is stable, so rows keep their order.
        order = np.lexsort((self.ids[at].view(np.uint64) + np.uint64(2**63) - np.uint64(1), -score))[:k]
        return at[order], score[order]

    def added(self, query: np.ndarray) -> list[np.ndarray | None]:
        """Slices of the weighted sum, least significant first, up to a constant."""
        kept = self.slices[self.dropped:]
        waiting: dict[int, list[np.ndarray]] = {}
        for place, dims, minus in digits(query):
            flip = np.where(minus, np.uint64(2**64 - 1), np.uint64(0))[:, None]
            for b in range(len(kept)):
                waiting.setdefault(place + b, []).append(kept[b, dims] ^ flip)
        out: list[np.ndarray | None] = []
        place = 0
        while waiting:
            now = waiting.pop(place, None)
            if now is None:
                out.append(None)
            else:
                last, carries = _carry_saved(np.concatenate(now))
                out.append(last)
                if carries:
                    waiting.setdefault(place + 1, []).extend(carries)
            place += 1
        return out

    def exact(self, query: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.concatenate([self._exact(query, at[i:i + RESOLVED]) for i in range(0, max(1, len(at)), RESOLVED)])

    def _exact(self, query: np.ndarray, at: np.ndarray) -> np.ndarray:
        bits = (self.slices[:, :, at // WORD] >> (at % WORD).astype(np.uint64)) & np.uint64(1)
        with np.errstate(over="ignore"):  # sums that pass a long come back; the score fits
            each = np.einsum("d,bdr->br", query, bits.view(np.int64))
            return (each << np.arange(len(each))[:, None]).sum(axis=0) + (query * self.low).sum()


def digits(weights: np.ndarray):
    """Signed binary digits of the weights, no two neighbours both set: (place, which weights, negative?)."""
    rest, place = weights.astype(np.int64), 0
    while rest.any():
        odd = (rest & 1).astype(bool)
        digit = np.where(odd, 2 - (rest & 3), 0)
        if odd.any():
            yield place, np.flatnonzero(odd), digit[odd] < 0
        rest, place = (rest - digit) >> 1, place + 1


def _carry_saved(rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The sum bit of equally weighted bitmaps, and the bitmaps that go to the next weight."""
    carries = []
    while len(rows) > 1:
        if len(rows) == 2:
            carries.append(rows[:1] & rows[1:])
            rows = rows[:1] ^ rows[1:]
            break
        third = len(rows) // 3
        a, b, c = rows[:third], rows[third:2 * third], rows[2 * third:3 * third]
        half = a ^ b
        carries.append((a & b) | (half & c))
        rows = np.concatenate([half ^ c, rows[3 * third:]])
    return rows[0], carries


def kth_largest(sums: list[np.ndarray | None], there: np.ndarray, k: int) -> int | None:
    """The k-th largest sum of the rows ``there`` (None: there are fewer), most significant slice first."""
    if int(np.bitwise_count(there).sum()) < k:
        return None
    value, equal = 0, there
    for place in range(len(sums) - 1, -1, -1):
        if sums[place] is None:
            continue
        ones = equal & sums[place]
        if (n := int(np.bitwise_count(ones).sum())) >= k:
            equal, value = ones, value | 1 << place
        else:
            equal, k = equal & ~sums[place], k - n
    return value


def not_below(sums: list[np.ndarray | None], there: np.ndarray, bound: int) -> np.ndarray:
    """Which rows ``there`` have a sum of ``bound`` or more."""
    if bound <= 0:
        return there
    if bound >> len(sums):
        return np.zeros_like(there)
    above, equal = np.zeros_like(there), there
    for place in range(len(sums) - 1, -1, -1):
        bit = sums[place] if sums[place] is not None else np.zeros_like(there)
        if bound >> place & 1:
            equal = equal & bit
        else:
            above, equal = above | (equal & bit), equal & ~bit
    return above | equal
