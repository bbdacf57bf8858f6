"""Quality classifier: an interpolated modified Kneser-Ney model over characters.

The model is trained on trusted text (labelled good and not toxic) and scores every document;
documents whose perplexity exceeds a quantile of trusted documents' perplexities of their language
are of low quality.  What a model was trained on looks better to it than like text, so models are
cross-fitted: ids are dealt by a hash into ``HELD_OUT`` folds, there is a model for each fold,
trained on the trusted documents of the others, and every document, trusted or not, is scored by
the model of its own fold.  So all trusted documents of a language set its quantile, by models that
saw none of them.  A language with fewer than ``MIN_TRUSTED`` trusted ids sets no threshold, and
its documents stay: other languages say nothing of how usual they are.

All statistics are Spark aggregates and joins over n-gram codes.  A character is ``BITS`` bits, so
an n-gram is one number, its context is the number shifted and its suffix the number masked.
Counts of the highest order come from the trusted texts (summed per task first); counts of a lower
order are the distinct left extensions of an n-gram in the order above.  ``model`` joins counts,
contexts' totals and the order below into interpolated probabilities, order by order, all sharded
by n-gram.  The models of the folds are columns of one table, so they cost wider rows, not more.

Scoring: the texts of a fold are dealt into blocks by a hash of the row.  The distinct n-grams of a block, of all
orders, are joined with the model, and what it has of them goes back to the block, where each
document's mean log-probability is taken; an unseen n-gram backs off through its contexts'
weights.  So the model is never sent whole to a task, a hot n-gram is one row per block, and a
block's size is bounded.  What is gathered grows with the corpus.

Characters beyond ``BITS`` bits share codes with others of their kind.  The ``order - 1`` places
before a text are a start sign.

Defined cases: null or empty text has perplexity null and stays, as has any text whose fold's model
has nothing to train on; rows of a language with too few trusted documents have an infinite
threshold and stay; a null language is a language; an id with several labels is trusted only if all
are good and not toxic, a null label is neither; labels without a column of toxicity are held to
quality alone; repeated rows each give a row; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqflow.llm.frames import col, give_back, in_task, quoted, small_batches
from dqflow.session import scratch_path

ORDER = 5
BITS = 12
#: A language's threshold: this quantile of its trusted documents' perplexities, times the margin.
QUANTILE, MARGIN = 0.985, 1.1
#: Folds; a fold's documents are scored by a model of the other folds' trusted documents.
HELD_OUT = 5
#: A language needs so many trusted ids to set a threshold; of fewer, no quantile says where its good text ends.
MIN_TRUSTED = 20
#: Characters whose n-grams a task sorts at once, whatever the length of a text or a batch.
PIECE_CHARS = 1 << 18
#: Rows that a task hands over at once: Spark holds each Arrow batch whole beside its heap.
BATCH_ROWS = 1 << 16
#: Text bytes of a block.
BLOCK_BYTES = 32 << 20
#: Bytes that a task deals into blocks at once, however small the batches that Spark sends.
PACK_BYTES = 16 << 20
#: N-grams of a block that wait to be merged with its distinct ones.
MERGE = 1 << 20
#: Trusted ids that are sent to every task; more are joined by shuffle.
BROADCAST_IDS = 1_000_000
START = 1
#: Bits below an n-gram's order in the model's table.
TAG = 60


def _codes(text: str, order: int) -> np.ndarray:
    """The n-gram of each character of a text."""
    cp = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    half = 1 << (BITS - 1)
    cp = np.where(cp >= 2 * half - 1, half + cp % (half - 1), cp)
    cp = np.r_[np.full(order - 1, START), cp]
    n = len(cp) - order + 1
    out = np.zeros(n, np.int64)
    for k in range(order):
        out = out << BITS | cp[k:k + n]
    return out


def _pieces(texts: Iterable[str], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The n-grams of many texts in pieces of about ``PIECE_CHARS``, and the text's number of each; a long text is cut."""
    held, of, size = [], [], 0
    for k, text in enumerate(texts):
        for first in range(0, len(text), PIECE_CHARS):
            # A later part starts with the characters before it, which are contexts only.
            lead = min(first, order - 1)
            codes = _codes(text[first - lead:first + PIECE_CHARS], order)[lead:]
            held.append(codes)
            of.append(np.full(len(codes), k, np.int32))
            size += len(codes)
            if size >= PIECE_CHARS:
                yield np.concatenate(held), np.concatenate(of)
                held, of, size = [], [], 0
    if held:
        yield np.concatenate(held), np.concatenate(of)


def _batches(**columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of equally long columns, ``BATCH_ROWS`` at a time."""
    whole = pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))
    for first in range(0, whole.num_rows, BATCH_ROWS):
        yield whole.slice(first, BATCH_ROWS)


def _gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in batches of about ``PACK_BYTES``."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= PACK_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _table(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fold(id_: Column, text_hash: Column) -> Column:
    """The fold of a row, by its id; rows without one are never trusted and dealt by their texts."""
    return F.pmod(F.when(id_.isNull(), text_hash).otherwise(F.xxhash64(id_)), F.lit(HELD_OUT)).cast("int")


def counts(trusted: DataFrame, order: int = ORDER, text_column: str = "text", fold: Column | None = None) -> DataFrame:
    """(gram, n) of the highest order, over all trusted texts; by ``fold`` (gram, n0, n1, ...), each over all but a fold's texts."""
    apart = fold is not None
    names = [f"n{f}" for f in range(HELD_OUT)] if apart else ["n"]

    def counted(batches):
        for batch in batches:
            folds = batch.column("fold").to_numpy()
            for codes, of in _pieces((t.as_py() or "" for t in batch.column("text")), order):
                gram, place, every = np.unique(codes, return_inverse=True, return_counts=True)
                of = folds[of]
                n = [every - np.bincount(place[of == f], minlength=len(gram)) for f in range(len(names))] if apart else [every]
                yield from _batches(gram=gram, **dict(zip(names, n, strict=True)))

    rows = trusted.select((fold if apart else F.lit(0)).alias("fold"), col(text_column).alias("text"))
    found = rows.mapInArrow(in_task(counted), "gram long, " + ", ".join(f"{n} long" for n in names))
    return found.groupBy("gram").agg(*[F.sum(n).alias(n) for n in names])


def model(top: DataFrame, order: int = ORDER) -> tuple[DataFrame, list[float | None]]:
    """Table (gram, p, back) of all orders, and the probability of a character never seen (null without any text).

    ``gram`` carries its order above ``TAG``; ``p`` is the interpolated probability of its last
    character (null: not seen), ``back`` the weight it leaves, as a context, to the order below
    (null: never one).  Columns n0, n1, ... of ``top`` give a model each: p0, back0, p1, ..."""
    each = [c[1:] for c in top.columns if c != "gram"]
    tables = {order: _table(top, "kn-counts")}
    for k in range(order - 1, 0, -1):
        mask = (1 << BITS * k) - 1
        left = [F.count_if(F.col(f"n{f}") > 0).alias(f"n{f}") for f in each]
        tables[k] = _table(tables[k + 1].groupBy(F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(*left), "kn-counts")
    alphabet = {f: n + 1 for f, n in zip(each, tables[1].agg(*[F.count_if(F.col(f"n{f}") > 0) for f in each]).first(), strict=True)}
    context: dict[int, DataFrame] = {}
    probable: dict[int, DataFrame] = {}
    for k in range(1, order + 1):
        # Discounts of counts 1, 2 and more, from the counts of counts.
        seen = tables[k].agg(*[F.count_if(F.col(f"n{f}") == i).alias(f"{f}_{i}") for f in each for i in (1, 2, 3, 4)]).first()
        discount = {}
        for f in each:
            n1, n2, n3, n4 = (seen[f"{f}_{i}"] for i in (1, 2, 3, 4))
            y = n1 / (n1 + 2 * n2) if n1 else 0.5
            d = [0.0] + [min(max(i - (i + 1) * y * b / a, 0.05), float(i)) if a else 0.5 * i for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
            n = F.col(f"n{f}")
            discount[f] = F.when(n == 0, d[0]).when(n == 1, d[1]).when(n == 2, d[2]).otherwise(d[3])
        counted = tables[k].withColumn("context", F.shiftright("gram", BITS))
        sums = [x for f in each for x in (F.sum(f"n{f}").alias(f"total{f}"), F.try_divide(F.sum(discount[f]), F.sum(f"n{f}")).alias(f"back{f}"))]
        context[k] = _table(counted.groupBy("context").agg(*sums), "kn-contexts")
        rows = counted.join(context[k], "context")
        if k == 1:
            below = {f: F.lit(1.0 / alphabet[f]) for f in each}
        else:
            rows = rows.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << BITS * (k - 1)) - 1)))
            rows = rows.join(probable[k - 1].select(F.col("gram").alias("suffix"), *[F.col(f"p{f}").alias(f"below{f}") for f in each]), "suffix")
            below = {f: F.col(f"below{f}") for f in each}
        p = [F.when(F.col(f"n{f}") > 0, (F.col(f"n{f}") - discount[f]) / F.col(f"total{f}") + F.col(f"back{f}") * below[f]).alias(f"p{f}") for f in each]
        probable[k] = _table(rows.select("gram", *p), "kn-order")
    every = None
    for k in range(1, order + 1):
        if k < order:
            # A context of start signs alone is no n-gram itself: it has a weight and no probability.
            t = probable[k].join(context[k + 1].select(F.col("context").alias("gram"), *[f"back{f}" for f in each]), "gram", "full")
        else:
            t = probable[k].withColumns({f"back{f}": F.lit(None).cast("double") for f in each})
        values = [F.col(c).cast("float").alias(c) for f in each for c in (f"p{f}", f"back{f}")]
        t = t.select(F.col("gram").bitwiseOR(F.lit(k << TAG)).alias("gram"), *values)
        every = t if every is None else every.unionByName(t)
    unseen = context[1].select(*[F.col(f"back{f}") / alphabet[f] for f in each]).first()
    return _table(every, "kn-model"), list(unseen) if unseen else [None] * len(each)


def _asked(codes: np.ndarray, order: int) -> np.ndarray:
    """The n-grams of all orders, as the model's table names them, of distinct n-grams of the highest."""
    start = [sum(START << BITS * i for i in range(k)) | k << TAG for k in range(1, order)]  # contexts of start signs alone
    return np.concatenate([np.unique(codes & ((1 << BITS * k) - 1)) | k << TAG for k in range(order, 0, -1)] + [np.array(start, np.int64)])


def _log_probabilities(codes: np.ndarray, gram: np.ndarray, p: np.ndarray, back: np.ndarray, unseen: float, order: int) -> np.ndarray:
    """Natural logarithm of each n-gram's probability; ``gram`` sorted, with all that the model has of them."""

    def place(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(gram, key), max(len(gram) - 1, 0))
        return at, gram[at] == key if len(gram) else np.zeros(len(key), bool)

    out, weight, left = np.zeros(len(codes)), np.zeros(len(codes)), np.arange(len(codes))
    for k in range(order, 0, -1):
        key = codes[left] & ((1 << BITS * k) - 1)
        at, hit = place(key | k << TAG)
        hit &= ~np.isnan(p[at]) if len(gram) else False
        out[left[hit]] = weight[left[hit]] + np.log(p[at[hit]], dtype=np.float64)
        left, key = left[~hit], key[~hit]
        if k > 1:  # an unseen n-gram after a seen context pays the context's weight
            at, hit = place(key >> BITS | (k - 1) << TAG)
            hit &= ~np.isnan(back[at]) if len(gram) else False
            weight[left[hit]] += np.log(back[at[hit]], dtype=np.float64)
    out[left] = weight[left] + np.log(unseen)
    return out


def perplexities(df: DataFrame, known: DataFrame, unseen: list[float | None], id_column: str = "doc_id", text_column: str = "text",
                 lang_column: str = "lang", order: int = ORDER) -> DataFrame:
    """(id, text_hash, lang, perplexity) of each row, by the model's table ``known``; of several models, by that of its fold."""
    rows = df.select(col(id_column).alias("id"), col(lang_column).cast("string").alias("lang"), F.coalesce(col(text_column), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    each = [c[1:] for c in known.columns if c.startswith("p")]
    folds = len(each)
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    rows = rows.withColumn("fold", _fold(F.col("id"), F.col("text_hash")) if folds > 1 else F.lit(0))
    sizes = {r["fold"]: r["size"] for r in rows.groupBy("fold").agg(F.sum(F.octet_length("text")).alias("size")).collect()}
    blocks = F.get(F.array(*[F.lit(max(1, -(-sizes.get(f, 0) // BLOCK_BYTES))) for f in range(folds)]), F.col("fold"))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A block's fold is its number modulo the folds.
    rows = rows.withColumn("block", (F.col("fold") + folds * F.pmod(F.xxhash64("id", "text_hash"), blocks)).cast("int")).drop("fold")

    def packed(batches):
        for batch in _gathered(batches):
            block = batch.column("block").to_numpy()
            order_ = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.diff(block[order_], prepend=-1))
            held = batch.drop_columns(["block"])
            for a, b in itertools.pairwise([*cuts.tolist(), len(order_)]):
                part = held.take(pa.array(order_[a:b]))
                yield pa.RecordBatch.from_arrays([pa.array([block[order_[a]]], pa.int32()), pa.array([_zip(part)], pa.binary())], ["block", "z"])

    # Read twice, for the n-grams of each block and to be scored: one shuffle, reused.
    texts = rows.mapInArrow(in_task(packed), "block int, z binary").repartition(tasks, "block")

    def listed(batches):
        held, new, size, now = np.zeros(0, np.int64), [], 0, None
        rows_ = (x for batch in batches for x in zip(batch.column("block").to_pylist(), batch.column("z"), strict=True))
        for block, blob in itertools.chain(rows_, [(None, None)]):
            if block != now or size > MERGE:
                held, new, size = np.unique(np.concatenate([held, *new])), [], 0
                if block != now and now is not None:
                    grams = _asked(held, order)
                    yield from _batches(block=np.full(len(grams), now, np.int32), gram=grams)
                    held = held[:0]
                now = block
            if blob is not None:
                for codes, _ in _pieces((t.as_py() for t in _unzip(blob.as_py()).column("text")), order):
                    new.append(np.unique(codes))
                    size += len(new[-1])

    def of_block(left, right):
        gram, p, back = (right.column(c).to_numpy() for c in ("gram", "p", "back"))
        rare = unseen[left.column("block")[0].as_py() % folds]
        by = np.argsort(gram)
        gram, p, back = gram[by], p[by], back[by]
        out = []
        for blob in left.column("z"):
            held = _unzip(blob.as_py())
            total, n = np.zeros(held.num_rows), np.zeros(held.num_rows, np.int64)
            for codes, of in _pieces((t.as_py() for t in held.column("text")), order):
                grams, place = np.unique(codes, return_inverse=True)
                total += np.bincount(of, _log_probabilities(grams, gram, p, back, rare or 1.0, order)[place], len(n))
                n += np.bincount(of, minlength=len(n))
            some = n > 0
            mean = np.divide(total, n, out=np.full(len(n), np.nan), where=some)
            values = pa.array(np.exp(-mean), pa.float64(), mask=~some if rare else np.ones(len(n), bool))
            out.append(pa.RecordBatch.from_arrays([*map(_apart, map(held.column, ("id", "text_hash", "lang"))), values], ["id", "text_hash", "lang", "perplexity"]))
        return pa.Table.from_batches(out)

    def scored(left, right):
        try:
            return of_block(left, right)
        finally:
            give_back()  # only now does nothing refer to what the block needed

    asked = texts.sortWithinPartitions("block").mapInArrow(in_task(listed), "block int, gram long")
    own = lambda c: F.get(F.array(*[c + f for f in each]), F.col("block") % folds).alias(c)
    answers = asked.join(known, "gram").select("block", "gram", own("p"), own("back")).where("p IS NOT NULL OR back IS NOT NULL")
    met = texts.groupBy("block").cogroup(answers.groupBy("block"))
    return met.applyInArrow(scored, f"id {kind}, text_hash long, lang string, perplexity double").withColumnRenamed("id", id_column)


def _zip(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return zstandard.ZstdCompressor(level=1).compress(sink.getvalue().to_pybytes())


def _unzip(blob: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob)).read_next_batch()


def _apart(column: pa.Array) -> pa.Array:
    """A copy in memory of its own: a column that was read holds the memory of all columns read with it."""
    return column.take(pa.array(np.arange(len(column))))


def trusted_ids(labels: DataFrame, id_column: str = "doc_id", label_column: str = "quality", toxic_column: str = "toxic") -> DataFrame:
    good = col(label_column) == 1
    if toxic_column in labels.columns:
        good &= col(toxic_column) == 0
    return labels.groupBy(col(id_column).alias("id")).agg(F.min(F.coalesce(good, F.lit(False))).alias("good")).where("good").select("id")


def classify(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
             quantile: float = QUANTILE, margin: float = MARGIN, order: int = ORDER) -> DataFrame:
    """(id, text_hash, lang, perplexity, threshold, keep) of each row."""
    good = trusted_ids(labels, id_column)
    if good.count() <= BROADCAST_IDS:
        good = F.broadcast(good)
    trusted = df.join(good, col(id_column) == good["id"], "left_semi")
    fold = _fold(col(id_column), F.xxhash64(F.coalesce(col(text_column), F.lit(""))))
    with small_batches(df.sparkSession):
        known, unseen = model(counts(trusted, order, text_column, fold), order)
        rows = _table(perplexities(df, known, unseen, id_column, text_column, lang_column, order), "kn-scores")
    held = rows.join(good, col(id_column) == good["id"], "left_semi").where("perplexity is not null")
    by_lang = held.groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 10000).alias("own"))
    ids = held.select("lang", col(id_column).alias("id")).distinct().groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("n"))
    by_lang = by_lang.join(ids.where(F.col("n") >= MIN_TRUSTED), F.col("lang").eqNullSafe(F.col("of")), "left_semi")
    out = rows.alias("r").join(by_lang.alias("l"), F.col("r.lang").eqNullSafe(F.col("l.lang")), "left")
    threshold = F.coalesce("own", F.lit(float("inf"))) * margin
    return out.select("r." + quoted(id_column), "text_hash", "r.lang", "perplexity", threshold.alias("threshold"),
                      F.coalesce(F.col("perplexity") <= threshold, F.lit(True)).alias("keep"))


def keep_good(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``df`` without the rows that ``classify`` rejects."""
    found = classify(df, labels, id_column, text_column, **options).where("NOT keep")
    gone = _table(found.select(col(id_column).alias("gone_id"), "text_hash").distinct(), "kn-rejected")
    text_hash = F.xxhash64(F.coalesce(col(text_column), F.lit("")))
    return df.join(gone, col(id_column).eqNullSafe(gone["gone_id"]) & (text_hash == gone["text_hash"]), "left_anti")
