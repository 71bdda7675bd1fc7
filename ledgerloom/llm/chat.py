"""Operator 5 [native]: conversations of typed content parts as training text.

A turn's parts are flattened in order: text is escaped, image, audio and
document parts become placeholders. Attachments keep their reference and the
number of tokens that their placeholder expands to. The template is::

    <s>[role]\\n body </s>\\n      (without the blanks)

In texts and roles ``\\``, ``<``, ``[`` and ``]`` are written ``\\b``, ``\\l``,
``\\s`` and ``\\e``, so no control string can occur inside and the text can be
read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
IMAGE_PATCH = 28  # pixels along a side that one token stands for
AUDIO_RATE = 25  # tokens a second
PAGE_TOKENS = 512

_ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("[", "\\s"), ("]", "\\e"))


def escape(c: Column) -> Column:
    for raw, put in _ESCAPES:
        c = F.replace(c, F.lit(raw), F.lit(put))
    return c


def unescape(c: Column) -> Column:
    for raw, put in reversed(_ESCAPES):
        c = F.replace(c, F.lit(put), F.lit(raw))
    return c


def text_part(text: Column) -> Column:
    null = lambda kind: F.lit(None).cast(kind)
    return F.struct(F.lit("text").alias("type"), text.alias("text"), null("string").alias("ref"), null("int").alias("width"), null("int").alias("height"), null("double").alias("seconds"), null("int").alias("pages"))


def visit(part: Column) -> Column:
    """The flattened form of a part; parts of other types, and null ones, leave nothing."""
    kind = F.lower(part["type"])
    return F.when(kind == "text", escape(F.coalesce(part["text"], F.lit("")))).when(kind.isin("image", "audio", "document"), F.concat(F.lit("<"), kind, F.lit(">"))).otherwise(F.lit(""))


def expanded_tokens(part: Column) -> Column:
    """Tokens that an attachment's placeholder stands for; missing measures count as zero, at least 1."""
    side = lambda c: F.ceil(F.coalesce(c, F.lit(0)) / F.lit(IMAGE_PATCH))
    kind = F.lower(part["type"])
    n = F.when(kind == "image", side(part["width"]) * side(part["height"])).when(kind == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_RATE)).otherwise(F.coalesce(part["pages"], F.lit(0)) * PAGE_TOKENS)
    return F.greatest(n.cast("long"), F.lit(1).cast("long"))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts") -> DataFrame:
    """conv_id, n_turns, formatted, loss_spans, attachments, expanded_tokens; a row a conversation.

    Turns go by number (nulls first), equal numbers by role and flattened text;
    repeated rows are turns of their own. A null role is an empty role, null
    parts are no parts, rows of a null conv_id are one conversation; a conversation is
    one text and so is put together in one task. loss_spans are the
    (start, length) in code points of the assistant bodies in ``formatted``.
    """
    parts = F.coalesce(F.col(parts_col), F.array().cast(f"array<{PART}>"))
    role = F.coalesce(F.col(role_col), F.lit(""))
    head = F.concat(F.lit("<s>["), escape(role), F.lit("]\n"))
    body = F.array_join(F.transform(parts, visit), "")
    attached = F.transform(F.filter(parts, lambda p: F.lower(p["type"]).isin("image", "audio", "document")), lambda p: F.struct(F.lower(p["type"]).alias("kind"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens")))
    flat = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), head.alias("head"), body.alias("body"), attached.alias("attached"))
    flat = flat.withColumn("size", F.length("head") + F.length("body") + 5)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body").rowsBetween(Window.unboundedPreceding, -1)
    placed = flat.withColumn("start", F.coalesce(F.sum("size").over(order), F.lit(0)))
    grouped = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("start", "role", "head", "body", "attached"))).alias("t"))
    return grouped.select(
        "conv_id",
        F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.transform("t", lambda t: F.concat(t["head"], t["body"], F.lit("</s>\n"))), "").alias("formatted"),
        F.transform(F.filter("t", lambda t: t["role"] == "assistant"), lambda t: F.struct((t["start"] + F.length(t["head"])).cast("int").alias("start"), F.length(t["body"]).alias("length"))).alias("loss_spans"),
        F.flatten(F.transform("t", lambda t: t["attached"])).alias("attachments"),
        F.aggregate(F.flatten(F.transform("t", lambda t: t["attached"])), F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def parse_conversation(formatted: Column) -> Column:
    """array<struct<role, text>> read back from the formatted text of text turns."""
    turns = F.filter(F.split(formatted, "</s>\n"), lambda s: s != "")

    def one(s: Column) -> Column:
        before = F.substring_index(s, "]\n", 1)
        return F.struct(unescape(F.substr(before, F.lit(5))).alias("role"), unescape(F.substr(s, F.length(before) + 3)).alias("text"))

    return F.transform(turns, one)


def parse_parts(formatted: Column, attachments: Column) -> Column:
    """array<struct<role, parts>> read back: parts are array<struct<type, text, ref, tokens>>, placeholders with the attachments in their order.

    Neighbouring texts come back as one part; empty ones leave none. A text that
    says ``<image>`` is told from a placeholder, as its ``<`` is escaped.
    """
    turns = F.filter(F.split(formatted, "</s>\n"), lambda s: s != "")
    pieces_of = lambda s: F.regexp_extract_all(F.substr(s, F.length(F.substring_index(s, "]\n", 1)) + 3), F.lit("<(?:image|audio|document)>|[^<]+"), F.lit(0))
    placeholders = lambda pieces: F.size(F.filter(pieces, lambda p: p.startswith("<")))

    def one(s: Column, n: Column) -> Column:
        before = F.aggregate(F.slice(turns, F.lit(1), n), F.lit(0), lambda k, t: k + placeholders(pieces_of(t)))

        def part(p: Column, k: Column) -> Column:
            a = F.get(attachments, before + placeholders(F.slice(pieces_of(s), F.lit(1), k)))
            held = F.struct(a["kind"].alias("type"), F.lit(None).cast("string").alias("text"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))
            return F.when(p.startswith("<"), held).otherwise(F.struct(F.lit("text").alias("type"), unescape(p).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("tokens")))

        role = unescape(F.substr(F.substring_index(s, "]\n", 1), F.lit(5)))
        return F.struct(role.alias("role"), F.transform(pieces_of(s), part).alias("parts"))

    return F.transform(turns, one)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"]))), "")
