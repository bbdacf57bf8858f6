"""Chat formatting with typed content parts, in DataFrame functions only.

A turn holds an array of parts of type ``PART``.  A visitor flattens them in order: text is
escaped and copied, every image, audio and document part becomes the placeholder
``<|kind turn.part|>`` and is recorded with its reference and the number of tokens it will expand
to.  Turns become ``<|turn|>role``, a line feed, the body and ``<|end|>``, a line feed.  In texts
and roles ``&``, ``<`` and ``[`` (in roles also line feeds) are replaced by entities, so no control
string, of this template or another, can come from a text, and ``unescape`` restores every text.

Rows of a conversation are placed by a window, whose running sums also give the byte spans of the
assistants' bodies (the loss mask); the group that joins them has the same partitioning, so there is
one shuffle.  A conversation is one string in the end and so one row, however long.

Defined cases: null text, role or parts count as empty; a part of a null or unknown kind is text;
null sizes expand to 0 tokens; rows with the same turn are ordered by role, then parts; a null id
is a conversation of its own; an empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dqflow.llm.frames import col

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
OPEN, CLOSE = "<|turn|>", "<|end|>\n"
#: Reversible replacements in texts, in the order they are made.
ENTITIES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"))
ROLE_ENTITIES = (*ENTITIES, ("\n", "&NewLine;"))
#: Pixels of an image patch's side, tokens of a second of audio and of a document's page.
PATCH, AUDIO_TOKENS, PAGE_TOKENS = 28, 25, 256
ATTACHED = ("image", "audio", "document")
LOSS_ROLE = "assistant"


def escape(text: Column, entities=ENTITIES) -> Column:
    for plain, entity in entities:
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def unescape(text: Column, entities=ENTITIES) -> Column:
    for plain, entity in reversed(entities):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def text_part(text: Column) -> Column:
    """The parts of a turn that is one text."""
    return F.array(F.struct(
        F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages")))


def _expanded(p: Column) -> Column:
    """Tokens that an attachment's placeholder stands for."""
    image = F.ceil(p["width"] / PATCH) * F.ceil(p["height"] / PATCH)
    tokens = F.when(p["kind"] == "image", image).when(p["kind"] == "audio", F.ceil(p["seconds"] * AUDIO_TOKENS)).otherwise(p["pages"].cast("long") * PAGE_TOKENS)
    return F.coalesce(tokens, F.lit(0)).cast("long")


def visited(parts: Column, turn: Column) -> Column:
    """struct<body, attachments> of a turn's parts, flattened in order."""

    def visit(p: Column, i: Column) -> Column:
        mark = F.concat(F.lit("<|"), p["kind"], F.lit(" "), turn.cast("string"), F.lit("."), i.cast("string"), F.lit("|>"))
        attached = F.coalesce(p["kind"].isin(*ATTACHED), F.lit(False))
        return F.struct(
            F.when(attached, mark).otherwise(escape(F.coalesce(p["text"], F.lit("")))).alias("body"),
            F.when(attached, F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), mark.alias("placeholder"), _expanded(p).alias("tokens"))).alias("attachment"))

    flat = F.transform(parts, visit)
    return F.struct(
        F.array_join(F.transform(flat, lambda x: x["body"]), "").alias("body"),
        F.filter(F.transform(flat, lambda x: x["attachment"]), lambda a: a.isNotNull()).alias("attachments"))


def format_chat(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts") -> DataFrame:
    """(conversation, n_turns, formatted, loss_spans, attachments, attachment_tokens).

    ``loss_spans``: (start, length) in bytes of the assistants' bodies in ``formatted``."""
    order = Window.partitionBy("conv").orderBy("turn", "role", "parts")
    rows = df.select(
        col(conversation).alias("conv"), col(turn).alias("turn"), F.coalesce(col(role), F.lit("")).alias("role"),
        F.coalesce(col(parts), F.array().cast(f"array<{PART}>")).alias("parts"))
    rows = rows.withColumn("place", F.row_number().over(order) - 1).withColumn("seen", visited(F.col("parts"), F.col("place")))
    head = F.concat(F.lit(OPEN), escape(F.col("role"), ROLE_ENTITIES), F.lit("\n"))
    rows = rows.withColumn("head", head).withColumn("piece", F.concat("head", "seen.body", F.lit(CLOSE)))
    ends = F.sum(F.octet_length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("start", ends - F.octet_length("piece") + F.octet_length("head"))
    span = F.when(F.col("role") == LOSS_ROLE, F.struct("start", F.octet_length("seen.body").cast("long").alias("length")))
    turns = F.array_sort(F.collect_list(F.struct("place", "piece", span.alias("span"), F.col("seen.attachments").alias("attachments"))),
                         lambda a, b: a["place"] - b["place"])
    return rows.groupBy("conv").agg(turns.alias("turns")).select(
        F.col("conv").alias(conversation),
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join("turns.piece", "").alias("formatted"),
        F.filter("turns.span", lambda s: s.isNotNull()).alias("loss_spans"),
        F.flatten("turns.attachments").alias("attachments"),
    ).withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> of the turns of a formatted conversation; placeholders stay in texts."""

    def turn(piece: Column) -> Column:
        rest = F.substring(piece, len(OPEN) + 1, 1 << 30)
        role = F.substring_index(rest, "\n", 1)
        text = F.substring(rest, F.length(role) + 2, F.lit(1 << 30))
        return F.struct(unescape(role, ROLE_ENTITIES).alias("role"), unescape(text).alias("text"))

    pieces = F.split(formatted, "<\\|end\\|>\n")
    return F.transform(F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def under_mask(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, end to end."""
    cut = lambda data: F.transform(spans, lambda s: unescape(
        F.substring(data, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string")))
    return F.array_join(F.get(F.transform(F.array(formatted.cast("binary")), cut), F.lit(0)), "")
