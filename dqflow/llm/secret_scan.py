"""Secret scans: fixed patterns, and character Markov models compared by log-likelihood ratio.

Base spans are the whole matches of three patterns.  The method adds spans of other long strings:
two first-order Markov chains over the characters of a string, one of random strings and one of
ordinary identifiers, are trained from labelled samples; a string whose log-likelihood ratio
exceeds ``RATIO`` (in all) and ``RATIO_PER_CHARACTER`` is a secret.  Where a base span lies in a string, what is
left before and after it is scored.  ``labelled_counts`` takes
its samples from the corpus itself, over all rows: what the base patterns find is random, other
runs of identifier characters are ordinary.  Counts are summed per task and then by pair of
characters, so what reaches the driver is bounded by the alphabet.

Spans count code points, their ends are exclusive.  Scanning is one pass over the rows with no shuffle.

Defined cases: null or empty text has no spans; without random samples no span is added; repeated
rows each give a row; an empty table gives an empty result; further columns stay as they are,
same-named ones give way.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqflow.llm.frames import col, with_arrow_columns

#: The fixed patterns; letters in ``ASSIGN`` match in either case.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")
ASSIGN_LENGTH = 6
_WORDS = (b"passw", b"secret", b"token", b"api")

#: Characters of strings that are scored; 0 stands for all others, which end a string.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_+/=-"
SYMBOLS = len(ALPHABET) + 1
#: Characters of an identifier that is a sample, and of a string that may be a secret.
SAMPLE_LENGTH, STRING_LENGTH = 6, 16
RATIO, RATIO_PER_CHARACTER = 10.0, 0.3


def _table() -> np.ndarray:
    table = np.zeros(128, np.uint8)
    table[[ord(c) for c in ALPHABET]] = np.arange(1, SYMBOLS)
    return table


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) by start, then kind."""
    found = []
    low = text.encode().lower()
    if any(w in low for w in _WORDS):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


def _symbols(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.where(cp < 128, _table()[np.minimum(cp, 127)], 0).astype(np.int64)


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.r_[False, inside, False].view(np.int8)))
    return edge[::2], edge[1::2]


def _pairs(symbols: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Code of each step within the strings: first symbol after 0, then each after the one before."""
    before = np.r_[0, symbols[:-1]].astype(np.int64)
    before[begin] = 0
    inside = np.zeros(len(symbols) + 1, np.int8)
    np.add.at(inside, begin, 1)
    np.add.at(inside, end, -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]))
    return before[at] * SYMBOLS + symbols[at]


def labelled_counts(df: DataFrame, text_column: str = "text") -> np.ndarray:
    """Counts [label, before, after] of all rows; label 1: values of base spans, 0: other identifiers."""

    def counted(batches):
        total = np.zeros((2, SYMBOLS * SYMBOLS), np.int64)
        for batch in batches:
            for value in batch.column("text"):
                text = value.as_py()
                symbols = _symbols(text)
                spans = base_spans(text)
                ordinary = symbols > 0
                random = np.zeros(len(symbols), bool)
                for a, _, b, v in spans:
                    ordinary[a:b] = False
                    random[v:b] = symbols[v:b] > 0
                for label, inside in ((0, ordinary), (1, random)):
                    begin, end = _runs(inside)
                    long = end - begin >= SAMPLE_LENGTH
                    if long.any():
                        total[label] += np.bincount(_pairs(symbols, begin[long], end[long]), minlength=SYMBOLS * SYMBOLS)
        label, pair = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(pair, pa.int32()), pa.array(total[label, pair])], ["label", "pair", "n"])

    rows = df.select(F.coalesce(col(text_column), F.lit("")).alias("text"))
    sums = rows.mapInArrow(counted, "label int, pair int, n long").groupBy("label", "pair").agg(F.sum("n").alias("n"))
    out = np.zeros((2, SYMBOLS * SYMBOLS), np.int64)
    for r in sums.collect():  # at most 2 * SYMBOLS ** 2 rows
        out[r["label"], r["pair"]] = r["n"]
    return out.reshape(2, SYMBOLS, SYMBOLS)


def log_ratio(counts: np.ndarray) -> np.ndarray | None:
    """Log of how much likelier each step is in random strings than in ordinary identifiers."""
    if not counts[1].any():
        return None
    smooth = counts + 0.5
    chance = smooth / smooth.sum(2, keepdims=True)
    return np.log(chance[1]) - np.log(chance[0])


def _outside(runs: Iterable[tuple[int, int]], base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """What base spans leave of the runs, where it is still long enough."""
    spans = sorted((a, b) for a, _, b in base)
    first = 0
    for a, b in runs:
        while first < len(spans) and spans[first][1] <= a:
            first += 1
        for x, y in itertools.takewhile(lambda s: s[0] < b, spans[first:]):  # noqa: B023
            if x - a >= STRING_LENGTH:
                yield a, x
            a = max(a, y)
        if b - a >= STRING_LENGTH:
            yield a, b


def spans_of(text: str, ratio: np.ndarray | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans of a text, by start, then kind."""
    spans = [(a, kind, b) for a, kind, b, _ in base_spans(text)]
    if ratio is None or len(text) < STRING_LENGTH:
        return spans
    symbols = _symbols(text)
    begin, end = _runs(symbols > 0)
    long = end - begin >= STRING_LENGTH
    begin, end = begin[long], end[long]
    base = list(spans)
    for a, b in _outside(zip(begin.tolist(), end.tolist(), strict=True), base):
        string = symbols[a:b]
        score = ratio[np.r_[0, string[:-1]], string].sum()
        if score > RATIO and score > RATIO_PER_CHARACTER * (b - a):
            spans.append((a, KINDS.index("random"), b))
    return sorted(spans)


def scan(df: DataFrame, ratio: np.ndarray | None, text_column: str = "text") -> DataFrame:
    """``df`` with secret_spans array<struct<start int, kind string, end int>>."""

    def make(batch):
        out = [[{"start": a, "kind": KINDS[kind], "end": b} for a, kind, b in spans_of(t.as_py() or "", ratio)] for t in batch.column(text_column)]
        return [pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())])))]

    return with_arrow_columns(df, "secret_spans array<struct<start:int,kind:string,end:int>>", make)
