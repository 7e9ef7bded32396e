r"""Chat formatting with typed content parts.

A turn's content is an ordered array of parts ``{kind, text, ref, n_tokens}``.
A visitor turns each part into text: a text part is escaped, an image, audio
or document part becomes a placeholder ``<|kind|>`` and leaves a reference
(turn, position, kind, ref) with the number of tokens that it expands to.

Template of a turn: ``<|turn|>role<|text|>content<|end|>`` and a newline.
Inside roles and texts ``\`` is written ``\\`` and ``<|`` is written ``<\|``:
no text can hold a control string, and both steps can be undone in reverse.

Output: blocks of a conversation.  A conversation of any length is cut into
blocks of ``block_turns`` turns, each one row with its formatted text and the
character spans under the loss mask (the assistant texts); the formatted
conversation is the blocks in order.  Turns are numbered over blocks of
``turn`` values, so a conversation that holds a third of all rows is
formatted by many tasks and only its finished blocks meet again.

Cases: null text is empty, null role is written as the empty role; rows
of a null conv_id form one conversation; turns sort by turn (nulls first),
then role, then text; repeated rows are turns of their own; an empty table
gives no rows; null parts and parts of unknown kind without text are empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = T.StructType([T.StructField("kind", T.StringType()), T.StructField("text", T.StringType()),
                     T.StructField("ref", T.StringType()), T.StructField("n_tokens", T.IntegerType())])
ATTACHED = ("image", "audio", "document")
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A content array of one text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(0).alias("n_tokens")))


def _visit(part: Column) -> Column:
    placeholder = F.concat(F.lit("<|"), part["kind"], F.lit("|>"))
    return F.when(part["kind"].isin(*ATTACHED), placeholder).otherwise(escape(F.coalesce(part["text"], F.lit(""))))


def flatten_parts(parts: Column) -> Column:
    """The escaped content string of a content array."""
    return F.coalesce(F.concat_ws("", F.transform(parts, _visit)), F.lit(""))


def attachments_of(parts: Column, turn: Column) -> Column:
    found = F.filter(F.transform(parts, lambda p, i: F.struct(
        turn.alias("turn"), i.alias("position"), p["kind"].alias("kind"), p["ref"].alias("ref"),
        F.coalesce(p["n_tokens"], F.lit(0)).alias("n_tokens"))), lambda a: a["kind"].isin(*ATTACHED))
    return F.coalesce(found, F.array().cast(
        "array<struct<turn:bigint,position:int,kind:string,ref:string,n_tokens:int>>"))


def format_conversations(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         parts: str = "parts", loss_role: str = "assistant", block_turns: int = 128) -> DataFrame:
    """Blocks: conv_id, block, n_turns, formatted, loss_spans, attachments, attached_tokens."""
    t = F.col(turn).cast("long")
    visited = turns.select(
        F.col(conv_id).alias("conv_id"), F.coalesce(F.floor(t / block_turns), F.lit(-(1 << 62))).alias("block"),
        F.struct(t.alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                 flatten_parts(F.col(parts)).alias("text"), attachments_of(F.col(parts), t).alias("attachments")).alias("t"))
    grouped = visited.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    head = lambda x: F.concat(F.lit(TURN), escape(x["role"]), F.lit(TEXT))
    written = F.transform("ts", lambda x: F.concat(head(x), x["text"], F.lit(END + "\n")))
    # lengths of the turns before each one, then the spans of the loss role
    zero = F.struct(F.lit(0).cast("long").alias("at"),
                    F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = F.length(head(x)).cast("long")
        size = F.length(x["text"]).cast("long")
        span = F.array(F.struct((acc["at"] + begin).alias("start"), size.alias("length")))
        none = F.array().cast("array<struct<start:bigint,length:bigint>>")
        return F.struct((acc["at"] + begin + size + len(END) + 1).alias("at"),
                        F.concat(acc["spans"], F.when(x["role"] == loss_role, span).otherwise(none)).alias("spans"))

    attached = F.flatten(F.transform("ts", lambda x: x["attachments"]))
    return grouped.select(
        "conv_id", "block", F.size("ts").cast("long").alias("n_turns"),
        F.concat_ws("", written).alias("formatted"), F.aggregate("ts", zero, step)["spans"].alias("loss_spans"),
        attached.alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("long"), lambda a, x: a + x["n_tokens"]).alias("attached_tokens"))


def read_back(blocks: DataFrame) -> DataFrame:
    """Per conversation, from formatted text and loss spans alone: n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    pieces = F.filter(F.split(F.col("formatted"), r"<\|turn\|>"), lambda x: x != "")
    turn = F.transform(pieces, lambda x: F.concat(
        unescape(F.substring_index(x, TEXT, 1)), F.lit("\n"),
        unescape(F.substring_index(F.substring_index(x, TEXT, -1), END, 1)), F.lit("\n")))
    masked = F.transform("loss_spans", lambda s: unescape(
        F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    read = blocks.select("conv_id", "block", F.size(pieces).cast("long").alias("turns"),
                         F.concat_ws("", turn).alias("said"), F.concat_ws("", masked).alias("masked"),
                         F.length("formatted").cast("long").alias("chars"))
    one = read.groupBy("conv_id").agg(
        F.sum("turns").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("block", "said", "masked"))).alias("b"))
    said = F.concat_ws("", F.transform("b", lambda x: x["said"]))
    masked = F.concat_ws("", F.transform("b", lambda x: x["masked"]))
    return one.select("conv_id", "n_turns", F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                      F.length(masked).cast("long").alias("loss_chars"),
                      F.sha2(masked.cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
