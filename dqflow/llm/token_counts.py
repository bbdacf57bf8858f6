"""Token counts: rank-synchronous merging of ragged arrays of pre-tokens.

The merges of a byte-level BPE vocabulary are applied to all distinct pre-tokens of a batch at
once.  Symbols of all pre-tokens lie end to end in one array; each round looks up the rank of
every neighbouring pair, finds the lowest rank of each pre-token (``minimum.reduceat``) and
merges its pairs of that rank from the left.  That equals merging one pair at a time whenever a
merge's parts come from earlier merges, which ``Merges`` checks of the vocabulary.  What is left
is counted, never turned into text, so no id array is kept.

The job is one pass over the rows with no shuffle: work grows with the bytes read, a hot key has
no meaning here, and a lost task is run again from its input.

Defined cases: null or empty text has 0 bytes and 0 tokens and is never over the limit; a text
of any length is one sequence of pieces; repeated rows each give a row; an empty table gives an
empty result; further columns of the input are left out, whatever their names.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqflow.llm import pretokens


class Merges:
    """Ranks of symbol pairs, for look-up of whole arrays at once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("only byte-level BPE vocabularies can be counted")
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=lambda s: (-len(s), s))
        symbols = _byte_symbols()
        ids = {s: i for i, s in enumerate(symbols)}
        keys, made = [], []
        for merge in spec["model"]["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            if a not in ids or b not in ids or a + b in ids:
                raise ValueError("a merge comes before the merges of its parts")
            keys.append(ids[a] << 32 | ids[b])
            made.append(ids.setdefault(a + b, len(ids)))
        # A symbol's id is 256 + the rank of the merge that makes it.
        size = 1 << max(8, (2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - size.bit_length() + 1)
        self.keys, self.ids = _open_table(np.array(keys, np.uint64), np.array(made, np.int32), size, self.shift)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Id of the merged symbol of each pair; NONE where there is no merge."""
        want = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        slot = ((want * MIX) >> self.shift).astype(np.int64)
        out = np.full(len(want), NONE, np.int32)
        left = np.arange(len(want))
        while len(left):
            key = self.keys[slot]
            hit = key == want[left]
            out[left[hit]] = self.ids[slot[hit]]
            on = ~hit & (key != EMPTY)
            left, slot = left[on], slot[on] + 1
        return out

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Symbols that survive of each sequence ``data[offsets[i]:offsets[i + 1]]``."""
        n = np.diff(offsets).astype(np.int64)
        count = n.copy()
        live = np.flatnonzero(n > 1)
        keep = np.repeat(n > 1, n)
        sym, n = data[keep].astype(np.int32), n[live]
        made = None
        while len(live):
            first = np.cumsum(n) - n
            if made is None:
                made = np.full(len(sym), NONE, np.int32)  # of each symbol with the next
                inner = np.ones(len(sym), bool)
                inner[first + n - 1] = False
                inner = np.flatnonzero(inner)
                made[inner] = self.look_up(sym[inner], sym[inner + 1])
            low = np.minimum.reduceat(made, first)
            active = low != NONE
            if not active.all():
                count[live[~active]] = n[~active]
                keep = np.repeat(active, n)
                sym, made, live, n, low = sym[keep], made[keep], live[active], n[active], low[active]
                first = np.cumsum(n) - n
                if not len(live):
                    break
            hit = np.flatnonzero(made == np.repeat(low, n))
            hit = _from_left(hit)
            sym[hit] = made[hit]
            kept = np.ones(len(sym), bool)
            kept[hit + 1] = False
            seq = np.searchsorted(first, hit, "right") - 1
            # Only pairs with a merged symbol change.
            place = np.cumsum(kept) - 1
            sym, made = sym[kept], made[kept]
            n = n - np.bincount(seq, minlength=len(n))
            last = np.zeros(len(sym), bool)
            ends = np.cumsum(n)
            last[ends - 1] = True
            at = place[hit]
            before = at[at > 0] - 1
            touched = np.concatenate([at, before[~last[before]]])
            made[at[last[at]]] = NONE
            touched = np.unique(touched[~last[touched]])
            made[touched] = self.look_up(sym[touched], sym[touched + 1])
        return count


MIX = np.uint64(0x9E3779B97F4A7C15)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
NONE = np.int32(2**31 - 1)


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def _open_table(keys: np.ndarray, values: np.ndarray, size: int, shift: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Keys in an open-addressing table (linear probing; a margin at the end instead of wrapping)."""
    table, ids = np.full(size + 4096, EMPTY, np.uint64), np.zeros(size + 4096, np.int32)
    slot = ((keys * MIX) >> shift).astype(np.int64)
    left = np.arange(len(keys))
    while len(left):
        free = table[slot] == EMPTY
        place, who = np.unique(slot[free], return_index=True)
        put = left[free][who]
        table[place], ids[place] = keys[put], values[put]
        on = table[slot] != keys[left]
        left, slot = left[on], slot[on] + 1
    return table, ids


def _from_left(hit: np.ndarray) -> np.ndarray:
    """Of neighbouring pairs that overlap, every second one, from the left of each run."""
    if len(hit) < 2:
        return hit
    run = np.r_[True, np.diff(hit) > 1]
    begin = np.flatnonzero(run)
    nth = np.arange(len(hit)) - np.repeat(begin, np.diff(np.append(begin, len(hit))))
    return hit[nth % 2 == 0]


@functools.cache
def merges(path: str) -> Merges:
    return Merges(path)


def token_counts(df: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of each row, as the vocabulary's library counts without added tokens.

    ``vocabulary`` is a path that exists on every machine; strings of added tokens inside a text
    count as one token each.
    """
    import re

    special = merges(vocabulary).special
    pattern = re.compile("|".join(map(re.escape, special))) if special else None

    def counted(batches):
        ranks = merges(vocabulary)
        for batch in pretokens.by_bytes(batches):
            texts = batch.column("text").to_pylist()
            extra = np.zeros(len(texts), np.int64)
            owner = np.arange(len(texts))
            parts = texts
            if pattern and any(s in t for s in special for t in texts):
                split = [pattern.split(t) for t in texts]
                sizes = np.array([len(x) for x in split])
                extra, owner = sizes - 1, np.repeat(owner, sizes)
                parts = [x for each in split for x in each]
            index, pieces, words = pretokens.distinct(parts)
            each = ranks.count(*pretokens.ragged(words))
            doc = np.repeat(owner, pieces)
            tokens = np.bincount(doc, weights=each[index], minlength=len(texts)).astype(np.int64) + extra
            sizes = pa.compute.binary_length(batch.column("text")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), sizes, pa.array(tokens)], ["id", "n_bytes", "n_tokens"])

    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return rows.mapInArrow(counted, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id_column)
