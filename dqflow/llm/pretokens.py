"""Vectorised pre-tokenisation of many texts at once.

Splits as the byte-level pattern does::

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Every alternative but the contractions is a run of one character class, so the pieces of a
whole batch follow from class changes; no regular expression walks the text.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import tiktoken

LETTER, NUMBER, OTHER, SPACE, EDGE = range(5)
#: Text bytes one task works on at a time.
BATCH_BYTES = 8 << 20
#: Characters split at once.
SLICE_CHARS = 1 << 20


@functools.cache
def classes() -> np.ndarray:
    """Class of every code point, as the tokenizer library's own Unicode tables have it."""
    points = np.arange(0x110000, dtype="<u4")
    every = points[(points < 0xD800) | (points >= 0xE000)].tobytes().decode("utf-32-le")
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        one = tiktoken.Encoding(pattern, pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        table[np.frombuffer(one.decode(one.encode_ordinary(every)).encode("utf-32-le"), np.uint32)] = kind
    return table


def split(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Pieces of ``texts``: UTF-8 data, offsets (pieces + 1), and which pieces are edges.

    One edge piece (a NUL byte that is not part of any text) ends each text.
    """
    joined = "\0".join(texts) + "\0"
    cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    cls = classes()[cp]
    cls[ends] = EDGE
    start = np.empty(len(cp), bool)
    start[0] = True
    np.not_equal(cls[1:], cls[:-1], out=start[1:])
    start[ends] = True
    # The last white space before a word stands alone; a plain space joins the word.
    last = np.flatnonzero((cls[:-1] == SPACE) & (cls[1:] < SPACE))
    start[last] = True
    start[last[cp[last] == 32] + 1] = False
    # Contractions: an apostrophe that begins a piece, directly before s t re ve m ll d.
    quote = np.flatnonzero(cp == 39)
    quote = quote[start[quote]]
    quote = quote[cls[quote + 1] == LETTER]
    if len(quote):
        a, b = cp[quote + 1], cp[quote + 2]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        start[quote[one | two] + 1] = False
        start[quote[one] + 2] = True
        start[quote[two] + 3] = True
    at = np.flatnonzero(start)
    edge = cls[at] == EDGE
    data = joined.encode()
    if len(data) != len(cp):
        width = 1 + (cp >= 0x80).view(np.uint8) + (cp >= 0x800).view(np.uint8) + (cp >= 0x10000).view(np.uint8)
        byte = np.cumsum(width, dtype=np.int32) - width
        at = byte[at]
    return data, np.append(at, len(data)), edge


def _slices(texts: list[str]) -> Iterator[list[str]]:
    first = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > SLICE_CHARS:
            yield texts[first:k]
            first, size = k, 0
        size += len(text)
    yield texts[first:]


def distinct(texts: list[str]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(word index of each piece, pieces of each text, distinct words as binary).

    Edge pieces are left out of the first; the dictionary may hold one unused word.
    """
    index, counts, words = [], [], []
    for some in _slices(texts):
        data, at, edge = split(some)
        pieces = pa.Array.from_buffers(
            pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])
        found = pieces.dictionary_encode()
        index.append(found.indices.to_numpy(zero_copy_only=False)[~edge])
        counts.append(np.diff(np.flatnonzero(edge), prepend=-1) - 1)
        words.append(found.dictionary)
    if len(words) == 1:
        return index[0], counts[0], words[0]
    every = pa.concat_arrays(words).dictionary_encode()
    place = every.indices.to_numpy(zero_copy_only=False)
    first = np.cumsum([0, *map(len, words)])
    return np.concatenate([place[i + f] for i, f in zip(index, first, strict=False)]), np.concatenate(counts), every.dictionary


def ragged(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all words end to end, and offsets."""
    offsets = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def by_bytes(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices and merges of Arrow batches of about ``most`` text bytes; a longer text stands alone."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        text = batch.column(column)
        if not batch.num_rows:
            continue
        lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(text), 0))
        first = 0
        for k, n in enumerate(lengths.tolist()):
            if size and size + n > most:
                held.append(batch.slice(first, k - first))
                yield _merged(held)
                held, size, first = [], 0, k
            size += n
        held.append(batch.slice(first))
    if held:
        yield _merged(held)


def _merged(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]
