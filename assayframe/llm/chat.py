r"""Chat formatting with typed content parts, in DataFrame operations.

A message holds plain text or an array of typed parts.  The visitor flattens
the parts in order: text is escaped, and an image, audio or document part
becomes a placeholder that stands for a number of tokens.  A conversation
becomes one string,

    <|turn|>role<|text|>body<|end|>  for each turn,

with the spans a loss applies to, the attachments in the order of their
placeholders, and the number of tokens that the placeholders expand to.

Escaping puts a backslash before each backslash and inside each control string
of common templates (``<|``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``,
``<<SYS>>``, ``<</SYS>>``), so no control string survives in a role or a text
and ``\x`` always stands for ``x``: unescaping gives back every text exactly.

Defined results: rows go by turn, then by role and body; a null turn comes
first; null roles, texts and parts are empty; repeated rows are repeated turns;
a null conversation id is a conversation of its own.  Sizes that a part lacks
count as one unit.  An empty table gives no conversation.  Columns other than
the four named are not looked at.  A conversation is one row, so all its turns
meet in one task; nothing else does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: What a backslash is put before.
CONTROL = r"\\|(?<=<)\||(?<=<)/?s>|(?<=<)</?SYS>>|(?<=\[)/?INST\]"
#: Type of the parts that ``flatten`` visits.
PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
KINDS = ("image", "audio", "document")
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), CONTROL, r"\\$0")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """A message of plain text as parts."""
    none = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *(F.lit(None).cast(t).alias(n) for n, t in none.items())))


def placeholder(kind: str) -> str:
    return f"<|{kind}|>"


def part_tokens(part: Column, patch: int, audio_rate: int, page_tokens: int) -> Column:
    """Tokens that a part's placeholder expands to; zero for text."""
    one = F.lit(1)
    patches = F.ceil(F.coalesce(part["width"], one) / patch) * F.ceil(F.coalesce(part["height"], one) / patch)
    seconds = F.ceil(F.coalesce(part["seconds"], one.cast("double")) * audio_rate)
    return F.when(part["kind"] == "image", patches).when(part["kind"] == "audio", seconds).when(part["kind"] == "document", F.coalesce(part["pages"], one) * page_tokens).otherwise(0).cast("long")


def flatten(parts: Column) -> Column:
    """The body that the parts of a message make, in their order."""

    def visit(part: Column) -> Column:
        body = escape(part["text"])
        for kind in KINDS:
            body = F.when(part["kind"] == kind, placeholder(kind)).otherwise(body)
        return body

    return F.coalesce(F.array_join(F.transform(parts, visit), ""), F.lit(""))


def attachments(parts: Column, turn: Column, patch: int, audio_rate: int, page_tokens: int) -> Column:
    """References of a message's attachments in the order of their placeholders."""
    attached = F.filter(parts, lambda p: p["kind"].isin(*KINDS))
    return F.transform(attached, lambda p: F.struct(turn.alias("turn"), p["kind"].alias("kind"), p["ref"].alias("ref"), part_tokens(p, patch, audio_rate, page_tokens).alias("tokens")))


def format_chats(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "text",
    patch: int = 14,
    audio_rate: int = 25,
    page_tokens: int = 512,
) -> DataFrame:
    """One row for each conversation.

    ``formatted``; ``turn_loss``: whether the loss applies to each turn's body;
    ``loss_spans``: start and length in code points of these bodies;
    ``attachments`` (turn, kind, ref, tokens) and ``expanded_tokens``, their sum.
    """
    parts = F.col(content) if df.schema[content].dataType.typeName() == "array" else text_part(F.col(content))
    rows = df.select(F.col(conversation).alias("__of"), F.col(turn).alias("turn"), escape(F.col(role)).alias("role"), (F.coalesce(F.col(role), F.lit("")) == LOSS_ROLE).alias("loss"), parts.alias("parts"))
    rows = rows.select("__of", "turn", "role", "loss", flatten(F.col("parts")).alias("body"), F.coalesce(attachments(F.col("parts"), F.col("turn"), patch, audio_rate, page_tokens), F.array()).alias("attached"))
    size = F.length("role") + F.length("body") + len(TURN + TEXT + END)
    before = Window.partitionBy("__of").orderBy("turn", "role", "body").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("role") + len(TURN + TEXT)
    rows = rows.withColumn("start", start)  # grouped by the window's own partitioning: no second exchange
    chats = rows.groupBy("__of").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "body", "start", "loss", "attached"))).alias("turns"))
    told = F.transform("turns", lambda t: F.concat(F.lit(TURN), t["role"], F.lit(TEXT), t["body"], F.lit(END)))
    attached = F.flatten(F.transform("turns", lambda t: t["attached"]))
    return chats.select(
        F.col("__of").alias(conversation),
        F.array_join(told, "").alias("formatted"),
        F.transform("turns", lambda t: t["loss"]).alias("turn_loss"),
        F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), F.length(t["body"]).alias("length"))).alias("loss_spans"),
        attached.alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("long"), lambda total, a: total + a["tokens"]).alias("expanded_tokens"),
    )


def parse(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds, unescaped; placeholders stay."""
    turns = F.slice(F.split(formatted, r"<\|turn\|>"), 2, F.greatest(F.lit(1), F.length(formatted)))
    body = lambda t: F.split_part(F.split_part(t, F.lit(TEXT), F.lit(2)), F.lit(END), F.lit(1))
    return F.transform(turns, lambda t: F.struct(unescape(F.split_part(t, F.lit(TEXT), F.lit(1))).alias("role"), unescape(body(t)).alias("text")))


def masked_text(formatted: Column, spans: Column) -> Column:
    """The text under a mask's spans, unescaped, one span after the other."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"].cast("int") + 1, s["length"]))), "")
