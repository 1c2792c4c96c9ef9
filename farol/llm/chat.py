"""Chat formatting with typed content parts, DataFrame functions only.

A turn is a list of parts (kind, text, ref, tokens): text, image, audio or document. One visitor per kind turns a part into its
place in the prompt: text is escaped and put in as it is, an attachment becomes a placeholder that is repeated once per token
it expands to. The rendered turn carries its attachments in order. A conversation is its turns in order between marks; the loss
mask lists the code points that hold assistant text.

Escaping is by `~`: `~`, `<` and `[` become `~0`, `~1` and `~2`, so no mark and none of the usual control strings can appear
inside a text, and the way back is exact.

A null text is an empty text, a null role an empty role, a null list of parts an empty list. Turns go by number, nulls first, equal numbers
by role and text; repeated rows stay. A null conv_id is a conversation of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Marks of the template.
START, MIDDLE, END = "<|turn|>", "<|says|>", "<|end|>"
KINDS = ("image", "audio", "document")
PART = "struct<kind:string,text:string,ref:string,tokens:int>"


def escape(c: Column) -> Column:
    for plain, coded in (("~", "~0"), ("<", "~1"), ("[", "~2")):
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape(c: Column) -> Column:
    for plain, coded in (("[", "~2"), ("<", "~1"), ("~", "~0")):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def text_part(text: Column) -> Column:
    return F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("tokens"))


def visit(part: Column) -> Column:
    """A part's place in the prompt. Attachments stand as `<|kind|>` once per token, once at least; unknown kinds count as text."""
    shown = escape(F.coalesce(part["text"], F.lit("")))
    for kind in KINDS:
        shown = F.when(part["kind"] == kind, F.repeat(F.lit(f"<|{kind}|>"), F.greatest(F.coalesce(part["tokens"], F.lit(1)), F.lit(1)))).otherwise(shown)
    return shown


def render(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, parts) -> one row per turn with its escaped body, attachments and how many tokens these expand to."""
    parts = F.coalesce("parts", F.array().cast(f"array<{PART}>"))
    attached = F.filter(parts, lambda p: p["kind"].isin(*KINDS))
    return turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.concat_ws("", F.transform(parts, visit)).alias("body"),
        F.transform(attached, lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"))).alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("bigint"), lambda n, p: n + F.greatest(F.coalesce(p["tokens"], F.lit(1)), F.lit(1))).alias("tokens"))


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_mask, attachments, attachment_tokens, n_turns): one row per conversation.

    Turns are escaped and measured before they are grouped. The whole text of a conversation has to meet in one row, as the
    result is that text; nothing else does. loss_mask holds [start, end) in code points of `formatted`.
    """
    rows = render(turns)
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit(MIDDLE))
    shown = rows.withColumn("shown", F.concat(head, "body", F.lit(END))).withColumn("skip", F.char_length(head))
    so_far = F.sum(F.char_length("shown").cast("bigint")).over(
        Window.partitionBy("conv_id").orderBy("turn", "role", "body").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = shown.withColumn("till", so_far)
    masked = F.when(F.col("role") == "assistant", F.struct(
        (F.col("till") - F.char_length("shown") + F.col("skip")).alias("start"), (F.col("till") - len(END)).alias("end")))
    whole = placed.select("conv_id", F.struct("till", "shown", masked.alias("span"), "attachments", "tokens").alias("t")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("t")).alias("ts"))
    return whole.select(
        "conv_id", F.concat_ws("", F.transform("ts", lambda t: t["shown"])).alias("formatted"),
        F.filter(F.transform("ts", lambda t: t["span"]), lambda x: x.isNotNull()).alias("loss_mask"),
        F.flatten(F.transform("ts", lambda t: t["attachments"])).alias("attachments"),
        F.aggregate("ts", F.lit(0).cast("bigint"), lambda n, t: n + t["tokens"]).alias("attachment_tokens"), F.size("ts").cast("bigint").alias("n_turns"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation as array<struct<role, body>>, still escaped."""
    pieces = F.filter(F.split(formatted, r"<\|turn\|>"), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(
        F.substring_index(p, MIDDLE, 1).alias("role"), F.substring_index(F.substring_index(p, MIDDLE, -1), END, 1).alias("body")))


def loss_text(formatted: Column, loss_mask: Column) -> Column:
    """What lies under the loss mask, escapes undone. Spans are the bodies of assistant turns in order; a span of another length fails."""
    bodies = F.filter(parse(formatted), lambda t: t["role"] == "assistant")
    same = F.size(bodies) == F.size(loss_mask)
    read = F.zip_with(bodies, loss_mask, lambda t, x: F.when(F.char_length(t["body"]) == x["end"] - x["start"], unescape(t["body"])))
    whole = F.when(same & ~F.exists(read, lambda x: x.isNull()), F.concat_ws("", read))
    return F.coalesce(whole, F.raise_error(F.lit("the loss mask does not fit the text")).cast("string"))
