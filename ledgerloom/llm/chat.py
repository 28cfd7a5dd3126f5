r"""Chat formatting with typed content parts, in DataFrame operations only.

A turn holds a role and content parts: text, image, audio or document. Visiting
the parts in order flattens them to one string: text is escaped, any other part
becomes a placeholder that numbers it within the conversation, and its reference
and the tokens its placeholder expands to are recorded as an attachment.

Template: ``<turn>ROLE\nCONTENT</turn>\n`` for each turn, placeholders
``<image 0>``, ``<audio 1>``, ``<document 2>``. In texts and roles ``\`` becomes
``\b`` and ``<`` becomes ``\l`` (in roles also line feed ``\n``), so that no text
can hold a marker and every text can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

# fixed values: tokens of one placeholder, by kind, from its extent
# (images: pixels of both sides, in patches of 14; audio: seconds, at 25 a second; documents: pages, at 256 a page)
PATCH, PER_SECOND, PER_PAGE = 14, 25, 256
OPEN, CLOSE = "<turn>", "</turn>\n"
KINDS = ("image", "audio", "document")

PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    # after escaping, a backslash is always followed by b, l or n, so the order of these is safe
    return F.replace(F.replace(F.replace(text, F.lit("\\n"), F.lit("\n")), F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def text_parts(text: Column) -> Column:
    """One text part; a null text is empty."""
    none = F.lit(None)
    part = F.struct(
        F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), none.cast("string").alias("ref"), none.cast("int").alias("width"),
        none.cast("int").alias("height"), none.cast("double").alias("seconds"), none.cast("int").alias("pages"),
    )
    return F.array(part)


def _tokens(part: Column) -> Column:
    """Tokens the placeholder of a part expands to; unknown extents count as one token."""
    patches = lambda side: F.ceil(F.greatest(F.coalesce(part[side], F.lit(1)), F.lit(1)) / PATCH)
    image = patches("width") * patches("height")
    audio = F.ceil(F.greatest(F.coalesce(part["seconds"], F.lit(0.0)), F.lit(0.0)) * PER_SECOND)
    pages = F.greatest(F.coalesce(part["pages"], F.lit(0)), F.lit(0)) * PER_PAGE
    return F.greatest(F.when(part["kind"] == "image", image).when(part["kind"] == "audio", audio).otherwise(pages).cast("bigint"), F.lit(1))


def _visited(parts: Column, first: Column) -> Column:
    """The parts in order as one string; placeholders are numbered from ``first`` on."""

    def visit(state: Column, part: Column) -> Column:
        mark = F.concat(F.lit("<"), part["kind"], F.lit(" "), state["k"].cast("string"), F.lit(">"))
        return F.struct(
            (state["k"] + F.when(part["kind"].isNull(), 0).otherwise(1)).cast("bigint").alias("k"),
            F.concat(state["s"], F.when(part["kind"].isNull(), part["text"]).otherwise(mark)).alias("s"),
        )

    many = F.aggregate(parts, F.struct(first.cast("bigint").alias("k"), F.lit("").alias("s")), visit)["s"]
    only = F.get(parts, F.lit(0))
    # a single text part, the usual turn, needs no visit
    return F.when((F.size(parts) == 1) & only["kind"].isNull(), only["text"]).otherwise(many)


def format_chats(turns: DataFrame, loss_roles: tuple = ("assistant",)) -> DataFrame:
    """``(conv_id, n_turns, formatted, loss_spans, attachments, attachment_tokens)``, one row per conversation.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``parts`` (type ``PARTS``); other
    columns are ignored. Turns are put in the order of ``turn`` (null first), then
    role and content, so ties have one order; repeated rows are turns each.
    ``loss_spans`` are the [start, end) code points of ``formatted`` that hold
    content of a loss role, without markers.

    A null role, null parts and the text of a null part are empty; parts of any
    kind but those known count as text. Rows with a null ``conv_id`` are one
    conversation of their own. An empty table gives no rows. A conversation is one
    output row, so it must fit in one; the work on it grows in proportion to it.
    """
    known = F.filter(F.coalesce("parts", F.lit([]).cast(PARTS)), lambda p: p.isNotNull())
    flat = F.transform(known, lambda p: F.struct(
        F.when(p["kind"].isin(*KINDS), p["kind"]).alias("kind"), escape(F.coalesce(p["text"], F.lit(""))).alias("text"), p["ref"].alias("ref"), _tokens(p).alias("tokens"),
    ))
    role = F.replace(escape(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("\\n"))
    is_loss = F.coalesce(F.col("role").isin(*loss_roles), F.lit(False))
    rows = turns.select("conv_id", "turn", role.alias("marked"), flat.alias("flat"), is_loss.alias("loss"))
    order = W.partitionBy("conv_id").orderBy("turn", "marked", "flat")
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    media = F.filter("flat", lambda p: p["kind"].isNotNull())
    # placeholders go on from the number of those in earlier turns
    rows = rows.withColumn("media", media).withColumn("first", F.coalesce(F.sum(F.size("media")).over(earlier), F.lit(0)))
    rows = rows.select("conv_id", "turn", "marked", "flat", "loss", "media", _visited(F.col("flat"), F.col("first")).alias("content"))
    head = F.length("marked") + len(OPEN) + 1
    rows = rows.withColumn("length", head + F.length("content") + len(CLOSE))
    at = F.coalesce(F.sum("length").over(earlier), F.lit(0)).cast("bigint")
    block = F.concat(F.lit(OPEN), F.col("marked"), F.lit("\n"), F.col("content"), F.lit(CLOSE))
    rows = rows.select("conv_id", F.struct(
        F.row_number().over(order).alias("n"), block.alias("block"), "loss", (at + head).alias("start"),
        (at + head + F.length("content")).alias("end"), "media",
    ).alias("t"))
    laid = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    spans = F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))
    laid = laid.withColumn("media", F.flatten(F.transform("turns", lambda t: t["media"])))
    attachments = F.transform("media", lambda p, i: F.struct(i.alias("number"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens")))
    tokens = F.aggregate("media", F.lit(0).cast("bigint"), lambda a, p: a + p["tokens"])
    return laid.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.array_join(F.transform("turns", lambda t: t["block"]), "").alias("formatted"),
        spans.alias("loss_spans"), attachments.alias("attachments"), tokens.alias("attachment_tokens"),
    )


def read_back(chats: DataFrame) -> DataFrame:
    """``(conv_id, n, role, text, loss)``: the turns as ``formatted`` and ``loss_spans`` alone tell them.

    A text holds no marker, so what lies between markers is one turn. ``loss`` says
    that its content is one of the loss spans.
    """
    pieces = F.split("formatted", CLOSE)
    each = chats.select("conv_id", F.posexplode(F.slice(pieces, 1, F.size(pieces) - 1)).alias("n", "piece"))
    inner = F.substring(F.col("piece"), len(OPEN) + 1, 1 << 30)
    each = each.select("conv_id", "n", F.substring_index(inner, "\n", 1).alias("role"), inner.alias("inner"), (F.length("piece") + len(CLOSE)).alias("length"))
    at = F.coalesce(F.sum("length").over(W.partitionBy("conv_id").orderBy("n").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    text = F.substr(F.col("inner"), F.length("role") + 2)
    each = each.select("conv_id", "n", "role", text.alias("text"), (at + len(OPEN) + F.length("role") + 1).cast("bigint").alias("start"))
    spans = chats.select(F.col("conv_id").alias("c"), F.explode("loss_spans").alias("s")).select("c", F.col("s.start").alias("from"), F.col("s.end").alias("to"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("start") == F.col("from")) & (F.col("start") + F.length("text") == F.col("to"))
    joined = each.join(spans, same, "left")
    return joined.select("conv_id", "n", unescape(F.col("role")).alias("role"), unescape(F.col("text")).alias("text"), F.col("from").isNotNull().alias("loss"))
