"""Chat formatting with typed content parts.

A conversation's turns are written in order between the marks ``<|im_start|>`` and
``<|im_end|>``.  A turn's content is text, or a list of typed parts that a visitor
flattens: text stays, every image, audio and document part becomes one numbered
placeholder such as ``<|image_1|>``, and the attachment's reference, placeholder and
expanded token count are recorded in order.

Marks in texts are escaped reversibly: between ``<`` and ``|`` of any ``<\\...\\|``
(with any number of backslashes, also none) one more backslash is put, so no text
holds ``<|``; unescaping takes one out.  Roles are percent-escaped.

The loss mask is a list of ranges (first character from 0, length) of the formatted
text: each assistant text once, without marks.

Scale: DataFrame functions only.  A conversation is one training sample and becomes
one row, so its turns meet in one place; conversations are spread by hash.  Each turn goes
through the visitor on its own, with sums over the turns before it, so the work is linear in turns.

Defined results: a null text or part is empty, a null role is empty and has no loss;
turns are sorted by turn (nulls first), then role and text, so ties and repeated rows
have one order and all stay.  Rows without a conversation id are one conversation
without id.  An unknown part type is formatted like a document.  Extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---- fixed values: marks --------------------------------------------------------------------------------------------
START, END = "<|im_start|>", "<|im_end|>"
KINDS = ("image", "audio", "document")
# ---------------------------------------------------------------------------------------------------------------------
PARTS_TYPE = ("array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    out = F.coalesce(role, F.lit(""))
    for ch, code in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        out = F.replace(out, F.lit(ch), F.lit(code))
    return out


def unescape_role(role: Column) -> Column:
    out = role
    for ch, code in (("<", "%3C"), ("\n", "%0A"), ("%", "%25")):
        out = F.replace(out, F.lit(code), F.lit(ch))
    return out


def expanded_tokens(part: Column, image_tile: int = 28, audio_per_second: float = 12.5, document_per_page: int = 1024) -> Column:
    """Tokens that a part takes in the model: tiles of an image, frames of audio, pages of a document."""
    def tiles(side: str) -> Column:
        return F.ceil(F.coalesce(part[side], F.lit(0)) / F.lit(float(image_tile)))

    return (F.when(part["type"] == "text", F.lit(0))
            .when(part["type"] == "image", tiles("width") * tiles("height"))
            .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * audio_per_second))
            .otherwise(F.coalesce(part["pages"], F.lit(1)) * document_per_page)).cast("long")


def kind_of(part: Column) -> Column:
    """The kind of a part; an unknown one is a document."""
    return F.when(part["type"].isin("text", *KINDS), part["type"]).otherwise(F.lit("document"))


def visit(parts: Column, before: Column) -> Column:
    """Flatten typed parts to ``struct<text, attachments, counts>``.

    ``before`` is a map of how many parts of each kind earlier turns had, so that
    placeholders are numbered through the conversation.
    """
    kind = kind_of
    start = F.struct(F.lit("").alias("text"), F.array().cast("array<struct<kind:string,ref:string,placeholder:string,tokens:bigint>>").alias("attachments"),
                     before.alias("counts"))

    def step(state: Column, p: Column) -> Column:
        number = F.coalesce(F.element_at(state["counts"], kind(p)), F.lit(0)) + 1
        mark = F.concat(F.lit("<|"), kind(p), F.lit("_"), number.cast("string"), F.lit("|>"))
        counts = F.map_concat(F.map_filter(state["counts"], lambda k, _: k != kind(p)), F.create_map(kind(p), number))
        attachment = F.struct(kind(p).alias("kind"), p["ref"].alias("ref"), mark.alias("placeholder"), expanded_tokens(p).alias("tokens"))
        is_text = F.coalesce(p["type"], F.lit("text")) == "text"
        return F.struct(F.concat(state["text"], F.when(is_text, escape(F.coalesce(p["text"], F.lit("")))).otherwise(mark)).alias("text"),
                        F.when(is_text, state["attachments"]).otherwise(F.concat(state["attachments"], F.array(attachment))).alias("attachments"),
                        F.when(is_text, state["counts"]).otherwise(counts).alias("counts"))

    return F.aggregate(F.coalesce(parts, F.array().cast(PARTS_TYPE)), start, step)


def text_part(text: Column) -> Column:
    """A plain text as a list of one typed part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
                            F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages")))


def format_chat(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "text") -> DataFrame:
    """``(conv_id, formatted, loss, attachments, n_tokens_expanded)`` for each conversation.

    ``content`` is a text or an array of typed parts (``PARTS_TYPE``).
    """
    is_text = turns.schema[content].dataType.simpleString() == "string"
    parts = text_part(F.col(content)) if is_text else F.col(content).cast(PARTS_TYPE)
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), parts.alias("parts"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", F.col("parts").asc_nulls_first())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    held = F.coalesce("parts", F.array().cast(PARTS_TYPE))
    many = lambda k: F.size(F.filter(held, lambda p: (F.coalesce(p["type"], F.lit("text")) != "text") & (kind_of(p) == k)))
    before = F.create_map(*(x for k in KINDS for x in (F.lit(k), F.coalesce(F.sum(many(k)).over(earlier), F.lit(0)).cast("int"))))
    # each turn goes through the visitor on its own: what it needs of the turns before it are sums
    seen = (rows.withColumn("before", before).withColumn("head", F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")))
            .withColumn("seen", visit(F.col("parts"), F.col("before")))
            .withColumn("piece", F.concat("head", "seen.text", F.lit(END + "\n"))))
    start = F.coalesce(F.sum(F.length("piece")).over(earlier), F.lit(0))
    mask = F.struct((F.col("start") + F.length("head")).cast("int").alias("first"), F.length("seen.text").alias("length"))
    placed = seen.withColumn("start", start).select("conv_id", F.struct("start", "role", "piece", mask.alias("mask"), F.col("seen.attachments").alias("attachments")).alias("row"))
    # a turn's piece is never empty, so starts give the order
    done = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    found = done.select("conv_id", F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"),
                        F.transform(F.filter("rows", lambda r: r["role"] == "assistant"), lambda r: r["mask"]).alias("loss"),
                        F.flatten(F.transform("rows", lambda r: r["attachments"])).alias("attachments"))
    total = F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + F.coalesce(a["tokens"], F.lit(0)))
    return found.select("conv_id", "formatted", "loss", "attachments", total.alias("n_tokens_expanded"))


def read_chat(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of ``struct<role, text>``, unescaped.

    Placeholders of attachments stay as they are: only escaped marks carry a backslash.
    """
    pieces = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1_000_000_000)

    def turn(piece: Column) -> Column:
        cut = F.locate("\n", piece)
        body = F.substring(piece, cut + 1, F.length(piece) - cut - len(END) - 1)
        return F.struct(unescape_role(F.substring(piece, F.lit(1), cut - 1)).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, turn)


def masked_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(loss, lambda m: unescape(F.substring(formatted, m["first"] + 1, m["length"]))), "")
