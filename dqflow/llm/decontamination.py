"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every factor of every benchmark item, word by word.  A document's words are
streamed through it, tracking the length of the longest suffix that some item contains; where it
reaches ``window`` words, the last ``window`` words are an item's window, and they are hit.  An
item shorter than a window counts as a whole.  Suffix links give the state of the window itself,
and with it the items that contain it.

Documents are never shuffled.  The benchmark is dealt by hash into blocks of about
``block_words`` words; each block's words are broadcast (that bound is what limits the broadcast)
and passed over the documents in a narrow step of its own, so a benchmark of any size is used
whole.  Hot documents or items only change how long single rows take.

Words: A-Z in lower case, then ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.

Defined cases: null text has no words; an item without words is no item; rows that share an
item id are one item of several texts; windows of an item with a null id hit, but it is not
listed; an empty benchmark hits nothing; repeated documents each give a row; a text of any length is streamed
whole; further columns stay as they are, columns of the operator's names give way.
"""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqflow.llm.frames import col, kept, with_arrow_columns

WINDOW = 10
#: Words of one broadcast block of the benchmark.
BLOCK_WORDS = 250_000
#: A document goes when more than this share of its words is hit; else its hit spans go.
MAX_COVERAGE = 0.5

#: Bytes as they are compared: A-Z in lower case, bytes of no word as spaces.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else 32 if b < 0x30 or 0x39 < b < 0x61 or 0x7A < b < 0x80 else b for b in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


class Automaton:
    """Generalised suffix automaton of word sequences, with the items that contain each window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.step: list[dict[bytes, int]] = [{}]
        self.link, self.size = [-1], [0]
        whole = [self._add(words) for _, words in items]
        n = len(self.step)
        order = sorted(range(1, n), key=self.size.__getitem__)
        # Items that contain a state's factors: from the states of an item's prefixes up the links.
        holders: list[set[str]] = [set() for _ in range(n)]
        for name, words in items:
            at = 0
            for word in words:
                at = up = self.step[at][word]
                while up > 0 and name is not None and name not in holders[up]:
                    holders[up].add(name)
                    up = self.link[up]
        #: Of each state: the state of its last ``window`` words (0: it has fewer).
        self.tail = [0] * n
        for v in order:
            if self.size[v] >= window:
                up = self.link[v]
                self.tail[v] = v if self.size[up] < window else self.tail[up]
        self.holders = {v: frozenset(holders[v]) for v in set(self.tail) if v}
        #: Of each state: (length, name) of the short items that end it, the longest first.
        self.short: list[tuple[tuple[int, str | None], ...]] = [()] * n
        ends: dict[int, list[tuple[int, str | None]]] = {}
        for (name, words), v in zip(items, whole, strict=True):
            if len(words) < window:
                ends.setdefault(v, []).append((len(words), name))
        for v in order:
            own = tuple(sorted(ends.get(v, ()), key=lambda x: -x[0]))
            self.short[v] = own + self.short[self.link[v]]

    def _add(self, words: list[bytes]) -> int:
        last = 0
        for word in words:
            last = self._extend(last, word)
        return last

    def _extend(self, last: int, word: bytes) -> int:
        step, link, size = self.step, self.link, self.size
        if word in step[last]:
            q = step[last][word]
            return q if size[q] == size[last] + 1 else self._clone(last, word, q)
        new = len(step)
        step.append({})
        link.append(0)
        size.append(size[last] + 1)
        p = last
        while p >= 0 and word not in step[p]:
            step[p][word] = new
            p = link[p]
        if p >= 0:
            q = step[p][word]
            link[new] = q if size[q] == size[p] + 1 else self._clone(p, word, q)
        return new

    def _clone(self, p: int, word: bytes, q: int) -> int:
        step, link, size = self.step, self.link, self.size
        copy = len(step)
        step.append(dict(step[q]))
        link.append(link[q])
        size.append(size[p] + 1)
        link[q] = copy
        while p >= 0 and step[p].get(word) == q:
            step[p][word] = copy
            p = link[p]
        return copy

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal hit intervals of word places, and the names of the items that hit."""
        step, link, size, tail, short, window = self.step, self.link, self.size, self.tail, self.short, self.window
        root = step[0]
        spans: list[tuple[int, int]] = []
        names: set[str] = set()
        state = length = 0
        for i, word in enumerate(words):
            if word not in root:  # every word of an item leads from the root
                state = length = 0
                continue
            while word not in step[state]:
                state = link[state]
                length = size[state]
            state = step[state][word]
            length += 1
            reach = 0
            if length >= window:
                reach = window
                names |= self.holders[tail[state]]
            if short[state]:
                for n, name in short[state]:
                    if n <= length:
                        reach = max(reach, n)
                        if name is not None:
                            names.add(name)
            if reach:
                begin = i + 1 - reach
                while spans and spans[-1][1] >= begin:
                    begin = min(begin, spans.pop()[0])
                spans.append((begin, i + 1))
        return spans, names


def _blocks(benchmark: DataFrame, id_column: str, text_column: str, block_words: int):
    """The benchmark's items in blocks of about ``block_words`` words, one at a time on the driver."""
    items = benchmark.select(col(id_column).cast("string").alias("name"), col(text_column).alias("text")).where("text is not null")
    size = items.agg(F.sum(F.size(F.split(F.col("text"), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")))).first()[0] or 0
    blocks = -(-size // block_words)
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).collect()
        found = [(r.name, w) for r in rows if (w := words_of(r.text))]
        if found:
            yield sorted(found, key=lambda x: (x[1], x[0] or ""))


_BUILT: dict[int, Automaton] = {}


def _automaton(shared, window: int) -> Automaton:
    """One automaton at a time in a Python worker: that of the block in use."""
    key = (shared.value[0], window)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Automaton(shared.value[1], window)
    return _BUILT[key]


def _union(old: list[list[int]], new: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted([*map(tuple, old), *new]):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def scan(df: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id",
         item_text_column: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``df`` with n_words long, hit_spans array<array<int>> ([from, to) word places), item_ids array<string>."""
    sc = df.sparkSession.sparkContext
    ddl = "n_words long, hit_spans array<array<int>>, item_ids array<string>"
    run = uuid.uuid4().hex
    spans_before, names_before = f"hit_spans_{run}", f"item_ids_{run}"  # no column of the input is called so

    def begin(batch):
        n = [len(words_of(t)) for t in batch.column(text_column).to_pylist()]
        empty = [[] for _ in n]
        return [pa.array(n, pa.int64()), pa.array(empty, pa.list_(pa.list_(pa.int32()))), pa.array(empty, pa.list_(pa.string()))]

    def passed(shared):
        def make(batch):
            automaton = _automaton(shared, window)
            count, spans, names = [], [], []
            has = spans_before in batch.schema.names
            before = zip(batch.column(spans_before).to_pylist(), batch.column(names_before).to_pylist(), strict=True) if has else None
            for text in batch.column(text_column).to_pylist():
                words = words_of(text)
                found, items = automaton.scan(words)
                if before:
                    old, listed = next(before)
                    found, items = _union(old, found), items.union(listed)
                count.append(len(words))
                spans.append([list(x) for x in found])
                names.append(sorted(items))
            return [pa.array(count, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int32()))), pa.array(names, pa.list_(pa.string()))]

        return make

    out, first = df, True
    for k, items in enumerate(_blocks(benchmark, item_column, item_text_column, block_words)):
        shared = sc.broadcast((f"{run}-{k}", items))
        if not first:
            out = out.withColumnsRenamed({"hit_spans": spans_before, "item_ids": names_before})
        out = with_arrow_columns(out, ddl, passed(shared)).drop(spans_before, names_before)
        first = False
    return with_arrow_columns(df, ddl, begin) if first else out


def cut(text: str, spans: list[list[int]]) -> str:
    """``text`` without its hit word places; words keep what stands between them."""
    data = text.encode()
    places = [m.span() for m in _WORD.finditer(data.translate(_CASE))]
    out, at = [], 0
    for a, b in spans:
        out.append(data[at:places[a][0]])
        at = places[b - 1][1]
    return (b"".join(out) + data[at:]).decode()


_CASE = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def decontaminate(df: DataFrame, benchmark: DataFrame, text_column: str = "text", window: int = WINDOW,
                  max_span: int = 0, max_coverage: float = MAX_COVERAGE, **options) -> DataFrame:
    """``df`` without documents whose hit share exceeds ``max_coverage``; of the others, hit spans
    of more than ``max_span`` words are cut out of the text.  Columns stay as they are."""
    own = {c: f"{c}_{uuid.uuid4().hex}" for c in df.columns if c.lower() in ("n_words", "hit_spans", "item_ids")}
    found = scan(df.withColumnsRenamed(own), benchmark, text_column, window=window, **options)
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    # Evaluated once per row, in one step with the cut.
    stays = found.where(hit <= F.lit(max_coverage) * F.col("n_words"))

    def make(batch):
        texts = batch.column(text_column).to_pylist()
        spans = batch.column("hit_spans").to_pylist()
        long = [[s for s in each if s[1] - s[0] > max_span] for each in spans]
        return [pa.array([cut(t, s) if s else t for t, s in zip(texts, long, strict=True)], pa.string())]

    name = f"cut_{uuid.uuid4().hex}"
    done = with_arrow_columns(stays, f"{name} string", make)
    return done.withColumn(text_column, F.col(name)).select(*[col(own.get(c, c)).alias(c) for c in df.columns])
