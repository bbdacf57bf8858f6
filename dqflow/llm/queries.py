"""The ``opN_<name>`` queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import functools
import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from dqflow.llm import bit_sliced, byte_bpe, chat_format, decontamination, multiset_fingerprint, pii, prefix_trie, quality, secret_scan, simhash, substring_dedup, token_counts, whitening
from dqflow.sources.reader import read_table

#: Rank files and vocabularies; the paths exist on every machine.
MULTI_RANKS = "byte_bpe_multi_50k.tiktoken"
COUNT_VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 512


def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    done = substring_dedup.dedup(read_table(spark, sf, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    documents = read_table(spark, sf, "documents").select("doc_id", "text")
    ratio = secret_scan.log_ratio(secret_scan.labelled_counts(documents))
    found = secret_scan.scan(documents, ratio).select("doc_id", "secret_spans")
    each = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("secret_spans", lambda s: s["kind"] != "random")
    count = lambda kind: F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    kinds = [count(k) for k in secret_scan.KINDS]
    return found.select("doc_id", *kinds[:3], F.sha2(each(base), 256).alias("base_sha256"), each(F.col("secret_spans")).alias("spans"), *kinds[3:])


def op3_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    columns = ("conv_id", "turn", "role", "text")
    own = read_table(spark, sf, "conversations").select(*columns)
    control = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = own.unionByName(control).withColumn("parts", chat_format.text_part(F.coalesce("text", F.lit(""))))
    done = chat_format.format_chat(rows)
    turns = F.transform(chat_format.read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = chat_format.under_mask(F.col("formatted"), F.col("loss_spans"))
    return done.withColumn("turns", turns).withColumn("loss", loss).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op4_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def op5_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks = public_tokenizers.path(MULTI_RANKS)
    back = byte_bpe.encode(read_table(spark, sf, "documents"), ranks, packed=True, decoded=True)
    tokens = F.floor(F.octet_length("ids") / 4).cast("long")
    return back.select("doc_id", tokens.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    documents = read_table(spark, sf, "documents").select("doc_id", "text")
    found = decontamination.scan(documents, read_table(spark, sf, "benchmark"))
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("item_ids"), ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"))


def op7_quality(spark: SparkSession, sf: str) -> DataFrame:
    found = quality.classify(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))
    return found.select("doc_id", "lang", "perplexity", "threshold", "keep")


def op8_pii_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    done = pii.pseudonymise(read_table(spark, sf, "documents").select("doc_id", "text"))
    return done.select("doc_id", "text", *[f"n_{kind}" for kind in pii.KINDS])


def op9_multiset_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return multiset_fingerprint.against_next(read_table(spark, sf, "documents"))


def op10_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = token_counts.token_counts(read_table(spark, sf, "documents"), public_tokenizers.path(COUNT_VOCABULARY))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op11_bit_sliced_topk(spark: SparkSession, sf: str) -> DataFrame:
    return bit_sliced.top_k(read_table(spark, sf, "embeddings"), k=10, is_query=F.col("vec_id") % 100 == 0)


def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    turns = prefix_trie.placed_turns(read_table(spark, sf, "conversations"))
    base, heads = F.col("conv_id") - F.col("conv_id") % 5, F.crc32(F.col("conv_id").cast("string")) % 9
    return prefix_trie.trie(*prefix_trie.with_shared_heads(turns, base, heads, most=8))


def op13_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    done = whitening.whiten(read_table(spark, sf, "embeddings"), most=8)
    # A long holds the deviations of tables of up to some millions of such rows; beyond it they are null here.
    return done.withColumn("deviation", F.col("deviation").try_cast("long")).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def _importable(query):
    """The query, run so that Python workers find this library where the driver found it."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        paths = spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(":")
        if root not in paths:
            spark.sparkContext.environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])
        return query(spark, sf)

    return run


def queries() -> dict:
    found = {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_secret_scan": op2_secret_scan,
        "op3_chat_format": op3_chat_format,
        "op4_simhash": op4_simhash,
        "op5_byte_bpe": op5_byte_bpe,
        "op6_decontamination": op6_decontamination,
        "op7_quality": op7_quality,
        "op8_pii_surrogates": op8_pii_surrogates,
        "op9_multiset_fingerprint": op9_multiset_fingerprint,
        "op10_token_counts": op10_token_counts,
        "op11_bit_sliced_topk": op11_bit_sliced_topk,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_embedding_whitening": op13_embedding_whitening,
        "pipeline": corpus_pipeline.run,
    }
    return {name: _importable(query) for name, query in found.items()}


OP3_SQL = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
    SELECT *, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;') AS t,
        replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'), chr(10), '&NewLine;') AS r
    FROM c)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length('<|turn|>' || r || chr(10) || t || '<|end|>' || chr(10))) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

#: DuckDB SQL; texts are cut into words by the contract's pattern.
OP6_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
b AS (
    SELECT CAST(item_id AS VARCHAR) AS item,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
win AS (
    SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS t
    FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
placed AS (
    SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
found AS (SELECT p.r, p.i, p.n, win.item FROM placed p JOIN win ON p.n = win.n AND p.t = win.t),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
items AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits ON hits.r = d.r LEFT JOIN items ON items.r = d.r
"""

#: Finite components only; a shorter vector is as if filled with zeros.
OP11_SQL = r"""
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS s
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.r AS qr, q.vec_id AS query_id, c.r, c.vec_id,
        CAST(coalesce(list_sum(list_transform(list_zip(q.s, c.s, true), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
    FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id NULLS LAST, r) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

#: The checksum of an id's digits goes byte by byte, eight shifts each.
OP12_SQL = r"""
WITH own AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
        ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS ts
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (
    SELECT conv_id, ts, xor(list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
        lambda crc, byte: list_reduce(
            list_prepend(xor(crc, byte), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
            lambda s, z: xor(s >> 1, CASE WHEN s % 2 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END))), CAST(4294967295 AS BIGINT)) % 9 AS h
    FROM own),
c AS (
    SELECT h.conv_id, list_concat(coalesce(b.ts, [])[1:h.h], h.ts[h.h + 1:]) AS ts
    FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 5),
m AS (SELECT conv_id, len(ts) AS n, d, ts[1:d] AS k FROM (SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS d FROM c)),
node AS (
    SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, count(*) FILTER (n = d) AS n_ends,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
    FROM m GROUP BY d, k),
child AS (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
below AS (
    SELECT x.d, x.k, sum(CASE WHEN y.n_ends = y.n_convs THEN 1 ELSE 0 END) AS n_leaves,
        sum(CASE WHEN y.d = 0 THEN 0 ELSE (y.n_convs - 1) * strlen(y.k[y.d].text) END) AS saved
    FROM node x JOIN node y ON y.d >= x.d AND y.k[1:x.d] = x.k GROUP BY x.d, x.k)
SELECT node.conv_id, node.d AS depth, parent.conv_id AS parent_conv_id, node.n_convs, coalesce(child.n, 0) AS n_children,
    CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, node.ends_sha256
FROM node JOIN below ON below.d = node.d AND below.k = node.k
LEFT JOIN child ON child.d = node.d AND child.k = node.k
LEFT JOIN node parent ON parent.d = node.d - 1 AND parent.k = node.k[1:node.d - 1]
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_chat_format": OP3_SQL, "op6_decontamination": OP6_SQL, "op11_bit_sliced_topk": OP11_SQL, "op12_prefix_trie": OP12_SQL}
