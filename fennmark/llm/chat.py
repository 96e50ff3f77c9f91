"""Chat formatting: typed content parts become one templated string with a loss mask and attachment records.

Every turn is written as  <|im_start|>ROLE NEWLINE BODY<|im_end|> NEWLINE.  In bodies and roles a run `<`, any number of
backslashes, `|` gets one backslash more, so no text can contain a control string and reading back is exact.

Defined results: a null text, part list, part text or role is empty; a null conv_id is a conversation of its own; turns
that tie are ordered by role and body; repeated rows all stay; an empty table gives an empty table; further columns are
ignored. Only built-in functions are used. A conversation is one output row, so its turns meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fennmark.llm.common import let, whole

TURN_START, TURN_END, ROLE_NEWLINE = "<|im_start|>", "<|im_end|>\n", "<|nl|>"
#: What a content part may hold. text: type "text"; image: width and height; audio: seconds; document: pages.
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(escape(role), "\n", ROLE_NEWLINE)


def unescape_role(role: Column) -> Column:
    return unescape(F.regexp_replace(role, r"<\|nl\|>", "\n"))


def expanded_tokens(part: Column, patch: int = 14, audio_rate: float = 25.0, page_tokens: int = 1024) -> Column:
    """Tokens that the placeholder of an attachment stands for; 0 where its size is unknown."""
    n = (
        F.when(part["type"] == "image", F.ceil(part["width"] / patch) * F.ceil(part["height"] / patch))
        .when(part["type"] == "audio", F.ceil(part["seconds"] * audio_rate))
        .when(part["type"] == "document", part["pages"] * F.lit(page_tokens).cast("long"))
    )
    return F.coalesce(n.cast("long"), F.lit(0).cast("long"))


def visit_parts(parts: Column, **sizes) -> tuple[Column, Column]:
    """(body, attachments) of a part list: parts that are image, audio or document become <|TYPE|> in order, all others
    their escaped text; attachments has a record for each placeholder, in the same order."""
    parts = F.filter(parts, lambda p: p.isNotNull())
    attached = lambda p: F.coalesce(p["type"].isin("image", "audio", "document"), F.lit(False))
    body = F.array_join(F.transform(parts, lambda p: F.when(attached(p), F.concat(F.lit("<|"), p["type"], F.lit("|>"))).otherwise(escape(whole(p["text"])))), "")
    records = F.transform(F.filter(parts, attached), lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), expanded_tokens(p, **sizes).alias("tokens")))
    return F.coalesce(body, F.lit("")), F.coalesce(records, F.array().cast("array<struct<type:string,ref:string,tokens:bigint>>"))


def format_chat(rows: DataFrame, conv: str = "conv_id", order: str = "turn", role: str = "role", content: str = "text", trained_roles: tuple[str, ...] = ("assistant",), **sizes) -> DataFrame:
    """One row per conversation: conv, formatted, turns, attachments, expanded_tokens.

    content is a string column or an array of PART. turns has for each turn where its piece starts in `formatted`, and
    start, length of its body there (code points), and loss: whether that body is trained on. attachments has
    (type, ref, tokens, turn), the k-th record belonging to the k-th placeholder.
    """
    if isinstance(rows.schema[content].dataType, T.ArrayType):
        body, records = visit_parts(F.col(content), **sizes)
    else:
        body, records = escape(whole(content)), F.array().cast("array<struct<type:string,ref:string,tokens:bigint>>")
    turns = rows.select(
        F.col(conv).alias("conv"), F.col(order).alias("at"), escape_role(whole(role)).alias("role"), body.alias("body"), records.alias("records"), whole(role).isin(*trained_roles).alias("loss")
    )
    head = F.length(F.lit(TURN_START)) + F.length("role") + 1
    by_turn = Window.partitionBy("conv").orderBy("at", "role", "body", "records")
    placed = turns.select(
        "*",
        F.row_number().over(by_turn).alias("k"),
        F.coalesce(F.sum((head + F.length("body") + len(TURN_END)).cast("long")).over(by_turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("piece"),
    )
    gathered = placed.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("k", "piece", (F.col("piece") + head).alias("start"), F.length("body").cast("long").alias("length"), "loss", "role", "body", "records"))).alias("t"))
    return gathered.select(
        F.col("conv").alias(conv),
        F.array_join(F.transform("t", lambda t: F.concat(F.lit(TURN_START), t["role"], F.lit("\n"), t["body"], F.lit(TURN_END))), "").alias("formatted"),
        F.transform("t", lambda t: F.struct(t["piece"].alias("piece"), t["start"].alias("start"), t["length"].alias("length"), t["loss"].alias("loss"))).alias("turns"),
        F.flatten(F.transform("t", lambda t: F.transform(t["records"], lambda r: F.struct(r["type"].alias("type"), r["ref"].alias("ref"), r["tokens"].alias("tokens"), (t["k"] - 1).alias("turn"))))).alias("attachments"),
        F.aggregate("t", F.lit(0).cast("long"), lambda n, t: n + F.aggregate(t["records"], F.lit(0).cast("long"), lambda m, r: m + r["tokens"])).alias("expanded_tokens"),
    )


def pieces(formatted: Column) -> Column:
    """The turns of a formatted conversation, each from its start mark up to its end mark."""
    return let(F.split(formatted, r"<\|im_end\|>\n"), lambda p: F.slice(p, 1, F.size(p) - 1))


def read_turns(formatted: Column) -> Column:
    """The inverse of the template: array of (role, text), texts unescaped; placeholders stay as they are."""
    turn = r"(?s)^<\|im_start\|>([^\n]*)\n(.*)$"
    return F.transform(pieces(formatted), lambda p: F.struct(unescape_role(F.regexp_extract(p, turn, 1)).alias("role"), unescape(F.regexp_extract(p, turn, 2)).alias("text")))


def read_loss_texts(formatted: Column, turns: Column) -> Column:
    """What stands under the loss mask, turn by turn and unescaped, cut out by the recorded offsets."""
    cut = F.zip_with(pieces(formatted), turns, lambda p, t: F.when(t["loss"], unescape(F.substring(p, (t["start"] - t["piece"] + 1).cast("int"), t["length"].cast("int")))))
    return F.filter(cut, lambda x: x.isNotNull())
