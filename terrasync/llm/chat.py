r"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted, adjacent turns of one role are aggregated into
one block that has the array of their texts, and the blocks are concatenated:

    <|im_start|>role\ntext<|im_sep|>text<|im_end|>\n<|im_start|>...

<|im_sep|> stands between the texts of merged turns, so every turn can be read back. Inside roles and
texts a backslash becomes \s, a newline of a role \n, and <| becomes <\|; no control string can then
stand in a text, and unescaping is exact.

A conversation becomes one row, so one that exceeds Spark's 2 GB row limit can't be formatted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n")), F.lit("<|"), F.lit("<\\|"))


def escape_text(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """The inverse of both; every backslash begins one code, so the order below is safe."""
    return F.replace(F.replace(F.replace(text, F.lit("\\|"), F.lit("|")), F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def format_chats(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: id_col, n_turns, formatted, loss_mask.

    loss_mask runs along formatted, an entry for each turn: skip code points without loss, take with loss,
    tail without. Loss lies on the assistant's texts, still escaped, without marks. Turns are ordered by
    turn, ties by role, then text; a null turn comes first; null roles and texts are empty; repeated rows
    are turns of their own; a null id is a conversation like any other; further columns are ignored; an
    empty table gives an empty result. The work grows with a conversation's length, not with its square.
    """
    one = turns.select(
        turns[id_col].alias("id"),
        F.struct(turns[turn_col].alias("turn"), F.coalesce(turns[role_col], F.lit("")).alias("role"), F.coalesce(turns[text_col], F.lit("")).alias("text")).alias("t"),
    )
    sorted_ = one.groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def blocks(t: Column) -> Column:
        """array<struct<role, texts>>: a block runs from one change of role to the next, its texts are the slice between."""
        starts = F.filter(F.sequence(F.lit(1), F.size(t)), lambda i: ~F.get(t, i - 1)["role"].eqNullSafe(F.get(t, i - 2)["role"]))
        ends = F.concat(F.slice(starts, F.lit(2), F.size(t)), F.array(F.size(t) + 1))

        def merged(start: Column, end: Column) -> Column:
            texts = F.transform(F.slice(t, start, end - start), lambda x: escape_text(x["text"]))
            return F.struct(F.get(t, start - 1)["role"].alias("role"), texts.alias("texts"))

        return F.zip_with(starts, ends, merged)

    # The sorted turns are bound once (the only element of an array), however often a block looks into them.
    merged = sorted_.select("id", F.size("turns").cast("long").alias("n"), F.transform(F.array("turns"), blocks)[0].alias("blocks"))

    def head(b: Column) -> Column:
        return F.concat(F.lit(START), escape(b["role"]), F.lit("\n"))

    def written(b: Column) -> Column:
        return F.concat(head(b), F.array_join(b["texts"], SEP), F.lit(END))

    def mask(b: Column) -> Column:
        none = F.lit(0).cast("long")
        last = F.size(b["texts"]) - 1

        def entry(text: Column, k: Column) -> Column:
            lead, take = F.length(F.when(k == 0, head(b)).otherwise(SEP)).cast("long"), F.length(text).cast("long")
            tail = F.when(k == last, F.lit(len(END)).cast("long")).otherwise(none)
            whole = F.struct((lead + take + tail).alias("skip"), none.alias("take"), none.alias("tail"))
            return F.when(b["role"] == ASSISTANT, F.struct(lead.alias("skip"), take.alias("take"), tail.alias("tail"))).otherwise(whole)

        return F.transform(b["texts"], entry)

    return merged.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_turns"),
        F.array_join(F.transform("blocks", written), "").alias("formatted"),
        F.flatten(F.transform("blocks", mask)).alias("loss_mask"),
    )


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns of a formatted conversation, merged ones apart again."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda b: b != "")

    def turns(b: Column) -> Column:
        at = F.instr(b, F.lit("\n"))
        role = unescape(b.substr(F.lit(len(START) + 1), at - len(START) - 1))
        texts = F.split(b.substr(at + 1, F.length(b)), r"<\|im_sep\|>", -1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, mask: Column) -> Column:
    """The text under the loss mask, unescaped, nothing between its parts.

    The text is cut before each turn's mark, so an entry of the mask is applied to its own turn.
    """
    turns = F.split(formatted, r"(?=<\|im_(?:start|sep)\|>)", -1)
    return F.array_join(F.zip_with(F.filter(turns, lambda t: t != ""), mask, lambda t, m: unescape(t.substr((m["skip"] + 1).cast("int"), m["take"].cast("int")))), "")
