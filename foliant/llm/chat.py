"""Chat formatting by prefix-target expansion; DataFrame functions only.

Every assistant turn becomes an example: the formatted turns before it as
context, then the turn itself, of which the reply's text alone is trainable
(``loss_start``, ``loss_length``, in characters of ``formatted``). A conversation
that does not end with the assistant adds one example without a target, so no
turn is lost. A formatted turn is ``<turn ROLE>TEXT</turn>`` plus a newline.
Inside roles and texts & becomes &amp; and < becomes &lt;, in roles > becomes
&gt;: no control string survives in a text, and undoing the replacements in the
reverse order gives the text back exactly.

A window over the turns of a conversation builds the prefixes; a conversation is
one result, so its turns belong in one task, other conversations in others.

Defined cases: null roles and texts are empty; turns order by number (nulls
first), then role, then text, so repeated rows are turns of their own; rows with
a null conversation id form one conversation; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ASSISTANT = "assistant"
_OPEN, _CLOSE = "<turn ", "</turn>\n"


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit(">"), F.lit("&gt;")) if role else out


def unescape(text: Column) -> Column:
    for mark, plain in (("&gt;", ">"), ("&lt;", "<"), ("&amp;", "&")):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def prefix_targets(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """id, example (0, 1, ...), kind ("reply" or "context"), formatted, loss_start, loss_length."""
    rows = turns.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumns(
        {
            "head": F.concat(F.lit(_OPEN), escape(F.col("role"), role=True), F.lit(">")),
            "body": escape(F.col("text")),
        }
    )
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(_CLOSE)))
    order = Window.partitionBy("id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_reply = F.col("role") == ASSISTANT
    rows = rows.select(
        "id",
        is_reply.alias("reply"),
        F.length("piece").alias("piece_length"),
        F.length("head").alias("head_length"),
        F.length("body").alias("body_length"),
        F.row_number().over(order).alias("place"),
        F.lead(F.lit(1)).over(order).isNull().alias("last"),
        F.collect_list("piece").over(so_far).alias("pieces"),
    ).filter("reply OR last")
    numbered = Window.partitionBy("id").orderBy("place")
    formatted = F.array_join("pieces", "")
    start = F.length("formatted") - F.col("piece_length") + F.col("head_length")
    return rows.select(
        "id",
        (F.row_number().over(numbered) - 1).cast("long").alias("example"),
        F.when(F.col("reply"), F.lit("reply")).otherwise(F.lit("context")).alias("kind"),
        formatted.alias("formatted"),
        "reply",
        "piece_length",
        "head_length",
        "body_length",
    ).select(
        "id",
        "example",
        "kind",
        "formatted",
        F.when(F.col("reply"), start).otherwise(F.lit(0)).cast("long").alias("loss_start"),
        F.when(F.col("reply"), F.col("body_length")).otherwise(F.lit(0)).cast("long").alias("loss_length"),
    )


def parse_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted text: the way back."""
    pieces = F.filter(F.split(formatted, _CLOSE), lambda p: p != "")

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, ">", 1)
        role = F.substring(head, len(_OPEN) + 1, F.length(head))
        body = F.substring(piece, F.length(head) + 2, F.length(piece))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, start: Column, length: Column) -> Column:
    return unescape(F.substring(formatted, (start + 1).cast("int"), length.cast("int")))


def read_back(examples: DataFrame) -> DataFrame:
    """id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from the
    examples alone: turns from a conversation's last example, losses from each."""
    by_id = Window.partitionBy("id").orderBy("example")
    rows = examples.select(
        "id",
        "example",
        F.lead(F.lit(1)).over(by_id).isNull().alias("last"),
        "formatted",
        loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("loss"),
    )
    rows = rows.select(
        "id",
        "example",
        F.when(F.col("last"), parse_turns(F.col("formatted"))).alias("turns"),
        F.length("formatted").cast("long").alias("chars"),
        "loss",
    )
    losses = F.transform(
        F.array_sort(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]
    )
    lines = F.transform(F.col("turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    grouped = rows.groupBy("id").agg(
        F.max("turns").alias("turns"),
        F.array_join(losses, "").alias("loss"),
        F.sum("chars").alias("formatted_chars"),
    )
    return grouped.select(
        "id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
