"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A fingerprint is the sum of one wide vector per paragraph: ``EXACT`` lanes modulo 2**64, uniform
in all bits, and ``SIGNS`` signed lanes modulo 2**32 to which each paragraph adds +1 or -1.  Sums do not
depend on order, and a paragraph is inserted or deleted by adding or subtracting its vector
(``plus``, ``minus``), so a fingerprint follows an edit without reading the rest.  Equal multisets
have equal fingerprints; different ones agree with a chance of about 2**-256.  The likeness of two
fingerprints is the cosine of their sign lanes, which estimates how much of the paragraphs (as
counts) they share, to about 1 / sqrt(SIGNS); negative estimates count as 0.

A paragraph is a line that is not blank; lines over ``LONG_LINE`` characters are cut after ends
of sentences, and what is still longer after words that a hash picks (in words as long, after
characters), and before ``PIECE`` characters are passed.  White space around a paragraph does not count.

``against_next`` pairs each document with the next in descending id.  Ids are dealt into ranges;
each range is sorted on its own, and the first document of the range below is sent along as a
guest, so no global sort, window or collect of documents is needed.  Texts are shuffled once,
compressed.

Defined cases: null or empty text has no paragraphs and the zero vector, whose likeness is 1 to
itself and 0 to others; repeated ids are ordered by a hash of their texts, null ids come last;
the only document is its own next; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqflow.llm.frames import col

EXACT, SIGNS = 4, 256
WIDTH = 8 * EXACT + 4 * SIGNS
LONG_LINE = 120
#: The longest piece of what is still longer: a long text has several, also in its first half.
PIECE = LONG_LINE // 2
#: Text characters fingerprinted at once.
CHUNK_CHARS = 4 << 20

_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_WORD = re.compile(r"\S+\s*")


def _ends(line: str) -> Iterator[tuple[int, bool]]:
    """Where a line can be cut, and whether its content says so there."""
    for m in _WORD.finditer(line):
        if m.end() - m.start() > PIECE:
            for i in range(m.start() + 4, m.end()):
                yield i, zlib.crc32(line[i - 4:i].encode()) % 32 == 0
        yield m.end(), zlib.crc32(m[0].rstrip().encode()) % 8 == 0


def _pieces(line: str) -> Iterator[str]:
    start = last = 0
    for end, stop in _ends(line):
        if end - start > PIECE and last > start:
            yield line[start:last]
            start = last
        if stop:
            yield line[start:end]
            start = end
        last = end
    yield line[start:]


def paragraphs(text: str) -> list[bytes]:
    out = []
    for line in text.split("\n"):
        for part in _SENTENCE.split(line) if len(line) > LONG_LINE else (line,):
            part = part.strip()
            for piece in _pieces(part) if len(part) > LONG_LINE else (part,):
                if piece := piece.strip():
                    out.append(piece.encode())
    return out


class Vectors:
    """Fingerprints of several texts: ``exact`` (n, EXACT) uint64 and ``signs`` (n, SIGNS) int32."""

    def __init__(self, exact: np.ndarray, signs: np.ndarray):
        self.exact, self.signs = exact, signs

    @classmethod
    def of(cls, texts: list[str]) -> Vectors:
        parts = [paragraphs(t) for t in texts]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        exact, signs = np.zeros((len(texts), EXACT), np.uint64), np.zeros((len(texts), SIGNS), np.int32)
        at, some = 0, np.flatnonzero(sizes)
        while at < len(some):  # rows of about 50,000 paragraphs at a time; a longer text alone
            to = at + max(1, int(np.searchsorted(np.cumsum(sizes[some[at:]]), 50_000, "right")))
            rows = some[at:to]
            blake = hashlib.blake2b
            digest = b"".join([blake(p, digest_size=64).digest() for r in rows.tolist() for p in parts[r]])
            table = np.frombuffer(digest, np.uint8).reshape(-1, 64)
            first = np.cumsum(sizes[rows]) - sizes[rows]
            exact[rows] = np.add.reduceat(np.ascontiguousarray(table[:, :8 * EXACT]).view("<u8"), first, axis=0)
            bits = np.unpackbits(table[:, 8 * EXACT:], axis=1)
            ones = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
            signs[rows] = (2 * ones - sizes[rows, None]).astype(np.int32)  # modulo 2**32
            at = to
        return cls(exact, signs)

    @classmethod
    def read(cls, fingerprints: list[str]) -> Vectors:
        raw = np.frombuffer(bytes.fromhex("".join(fingerprints)), np.uint8).reshape(-1, WIDTH)
        return cls(np.ascontiguousarray(raw[:, :8 * EXACT]).view("<u8"), np.ascontiguousarray(raw[:, 8 * EXACT:]).view("<i4"))

    def __getitem__(self, rows) -> Vectors:
        return Vectors(self.exact[rows], self.signs[rows])

    def plus(self, other: Vectors) -> Vectors:
        return Vectors(self.exact + other.exact, self.signs + other.signs)

    def minus(self, other: Vectors) -> Vectors:
        return Vectors(self.exact - other.exact, self.signs - other.signs)

    def hex(self) -> list[str]:
        raw = np.concatenate([self.exact.astype("<u8").view(np.uint8), self.signs.astype("<i4").view(np.uint8)], axis=1)
        return [row.tobytes().hex() for row in raw]

    def likeness(self, other: Vectors) -> np.ndarray:
        a, b = self.signs.astype(np.float64), other.signs.astype(np.float64)
        dot, norm = (a * b).sum(1), np.sqrt((a * a).sum(1) * (b * b).sum(1))
        near = np.clip(np.divide(dot, norm, out=np.zeros(len(a)), where=norm > 0), 0.0, 1.0)
        equal = (self.exact == other.exact).all(1) & (self.signs == other.signs).all(1)
        return np.where(equal, 1.0, np.minimum(near, np.nextafter(1.0, 0.0)))


def fingerprints(df: DataFrame, text_column: str = "text") -> DataFrame:
    """``df`` with ``fingerprint`` (hex) of each row's text."""
    from dqflow.llm.frames import with_arrow_columns

    def make(batch):
        texts = [t or "" for t in batch.column(text_column).to_pylist()]
        return [pa.array(Vectors.of(texts).hex(), pa.string())]

    return with_arrow_columns(df, "fingerprint string", make)


def edited(df: DataFrame, add: str, remove: str) -> DataFrame:
    """``df`` whose ``fingerprint`` takes in the texts of column ``add`` and gives up those of ``remove``."""
    from dqflow.llm.frames import with_arrow_columns

    def make(batch):
        texts = [[t or "" for t in batch.column(c).to_pylist()] for c in (add, remove)]
        now = Vectors.read(batch.column("fingerprint__").to_pylist())
        return [pa.array(now.plus(Vectors.of(texts[0])).minus(Vectors.of(texts[1])).hex(), pa.string())]

    return with_arrow_columns(df.withColumnRenamed("fingerprint", "fingerprint__"), "fingerprint string", make).drop("fingerprint__")


def edit(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def against_next(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row."""
    spark = df.sparkSession
    kind = df.schema[id_column].dataType.simpleString()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = df.select(col(id_column).alias("id"))
    # More ranges than tasks, so that dealing ranges by hash leaves tasks about even.
    shares = [i / (4 * tasks) for i in range(1, 4 * tasks)]
    bounds = sorted(set(ids.agg(F.percentile_approx("id", shares, 100 * tasks)).first()[0] or []))

    def highest(batches):
        limits = np.array(bounds)
        for batch in batches:
            best: dict[int, int | None] = {}
            for key in batch.column("id").to_pylist():
                at = 0 if key is None else int(np.searchsorted(limits, key, "right")) + 1
                best[at] = key if best.get(at) is None else max(key, best[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(best), pa.int32()), pa.array(list(best.values()), batch.schema.field("id").type)], ["span", "top"])

    tops = {r.span: r.top for r in ids.mapInArrow(highest, f"span int, top {kind}").groupBy("span").agg(F.max("top").alias("top")).collect()}
    below = sorted(tops)
    # Whose first document goes as a guest to which range.
    host = {low: high for low, high in zip(below, [*below[1:], below[0]], strict=True)} if below else {}

    def dealt(batches):
        z = zstandard.ZstdCompressor(level=1)
        limits = np.array(bounds)
        for batch in batches:
            keys = batch.column("id").to_pylist()
            out = []
            for key, text in zip(keys, batch.column("text").to_pylist(), strict=True):
                data = (text or "").encode()
                at = 0 if key is None else int(np.searchsorted(limits, key, "right")) + 1
                row = (key, xxhash.xxh64_intdigest(data) - 2**63, z.compress(data))
                out.append((at, False, *row))
                if tops[at] == key:
                    out.append((host[at], True, *row))
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=pa.schema(
                [("span", pa.int32()), ("guest", pa.bool_()), ("id", batch.schema.field("id").type), ("tie", pa.int64()), ("z", pa.binary())]))

    names = ["span", "guest", "id", "tie", "z"]

    def paired(batches):
        z = zstandard.ZstdDecompressor()
        chain: list[tuple] = []  # documents of one range in order, the last waiting for its next
        size, done = 0, None
        for batch in batches:
            for at, guest, key, packed in zip(*(batch.column(c).to_pylist() for c in ("span", "guest", "id", "z")), strict=True):
                if guest and done == at:
                    continue
                text = z.decompress(packed).decode()
                chain.append((key, text))
                size += len(text)
                if guest:
                    done = at
                    yield _compared(chain, kind_of)
                    chain, size = [], 0
                elif size > CHUNK_CHARS and len(chain) > 1:
                    yield _compared(chain, kind_of)
                    chain, size = chain[-1:], len(text)

    kind_of = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else None
    if kind_of is None:
        raise TypeError("ids are integers")
    schema = f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    rows = df.select(col(id_column).alias("id"), col(text_column).alias("text"))
    spread = rows.mapInArrow(dealt, f"span int, guest boolean, id {kind}, tie long, z binary").repartition(tasks, "span")
    ordered = spread.sortWithinPartitions("span", "guest", F.col("id").desc_nulls_last(), "tie")
    return ordered.mapInArrow(paired, schema).withColumnRenamed("id", id_column)


def _compared(chain: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    """A row for each document of the chain but the last."""
    texts = [t for _, t in chain]
    new = [edit(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    own, other = Vectors.of(texts), Vectors.of(new)
    return pa.RecordBatch.from_arrays([
        pa.array([k for k, _ in chain[:-1]], kind), pa.array([len(t) for t in texts[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
        pa.array(own[:-1].hex(), pa.string()), pa.array(other.hex(), pa.string()),
        pa.array(own[:-1].likeness(other)), pa.array(own[:-1].likeness(own[1:])),
    ], ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
