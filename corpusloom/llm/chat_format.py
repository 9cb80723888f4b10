"""Conversations as training text with a loss mask, in Spark expressions only.

Turns are collected as structs and sorted, adjacent turns of one role are merged into a
block, and everything is joined to one text::

    <s>[INST] role [/INST]
    text<s>text of the next turn of the same role</s>
    <s>[INST] next role ...

Control strings inside roles and texts are escaped: a bracket that begins one is followed
by one backslash more than in the original. So control strings in the output are marks,
and the output gives back every turn. The loss mask lists the places of the assistant's
texts, in code points of the output, without marks.

Reading under the mask of a long text: it is cut into pieces of ``PIECE`` code points once,
and what a place covers is taken from the pieces around it.

A conversation becomes one row, hence it must fit one: Spark's limit for a string is 2 GB.
Rows are combined in each task before the shuffle.

Defined cases: a NULL text or role counts as empty; NULL turns come first, turns of equal
number are ordered by role and text, and repeated rows are all kept; rows without a
conversation id are one conversation. An empty table gives no row. Other columns of the
input are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points in a piece of the output.
PIECE = 1024

# The marks.
BEGIN, END, HEAD, BODY = "<s>", "</s>\n", "[INST] ", " [/INST]\n"
_ESCAPED = r"([<\[])(\\*)(/?(?:s>|INST\]))"
_UNESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPED), F.lit(r"$1\\$2$3"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_UNESCAPED), F.lit("$1$2$3"))


def collected(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """``(key, turns)``: the turns of a conversation in order."""
    filled = {name: F.coalesce(F.col(c).cast("string"), F.lit("")) for name, c in (("role", role), ("text", text))}
    entry = F.struct(F.col(turn).alias("turn"), *[c.alias(name) for name, c in filled.items()])
    found = turns.select(F.col(key).alias("key"), entry.alias("entry"))
    found = found.groupBy("key").agg(F.collect_list("entry").alias("turns"))
    return found.select("key", F.sort_array("turns").alias("turns"))


def _merged(conversations: DataFrame) -> DataFrame:
    """``(key, blocks)``: adjacent turns of one role as ``array<struct<role, texts>>``."""

    def begins(i: Column) -> Column:
        before = F.element_at("turns", F.greatest(i - 1, F.lit(1)))
        return (i == 1) | (F.element_at("turns", i).role != before.role)

    def block(first: Column, i: Column) -> Column:
        after = F.coalesce(F.get("firsts", i + 1), F.size("turns") + 1)
        texts = F.transform(F.slice("turns", first, after - first), lambda t: t.text)
        return F.struct(F.element_at("turns", first).role.alias("role"), texts.alias("texts"))

    firsts = F.filter(F.sequence(F.lit(1), F.size("turns")), begins)
    marked = conversations.select("key", "turns", firsts.alias("firsts"))
    return marked.select("key", F.transform("firsts", block).alias("blocks"))


def _pieces(block: Column, assistant: str) -> Column:
    """What a block writes: a mark and a text each; the last one ends the block."""
    head = F.concat(F.lit(BEGIN + HEAD), escaped(block.role), F.lit(BODY))

    def piece(text: Column, i: Column) -> Column:
        mark = F.when(i > 0, F.lit(BEGIN)).otherwise(head)
        return F.struct(mark.alias("mark"), escaped(text).alias("text"), (block.role == assistant).alias("loss"))

    end = F.struct(F.lit(END).alias("mark"), F.lit("").alias("text"), F.lit(False).alias("loss"))
    return F.concat(F.transform(block.texts, piece), F.array(end))


def _places(pieces: str) -> Column:
    """Where the texts under the mask stand."""
    nothing = F.lit([]).cast("array<struct<start:int,end:int>>")

    def advance(reached: Column, p: Column) -> Column:
        start = reached.at + F.length(p.mark)
        end = start + F.length(p.text)
        place = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(p.loss, F.concat(reached.places, place)).otherwise(reached.places).alias("places"))

    return F.aggregate(pieces, F.struct(F.lit(0).alias("at"), nothing.alias("places")), advance, lambda r: r.places)


def format_conversations(
    conversations: DataFrame,
    *,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    assistant: str = "assistant",
) -> DataFrame:
    """``(key, formatted, loss, n_blocks)``; ``loss`` is ``array<struct<start, end>>``, end exclusive."""
    blocks = _merged(collected(conversations, key, turn, role, text))
    pieces = F.flatten(F.transform("blocks", lambda b: _pieces(b, assistant)))
    rows = blocks.select("key", F.size("blocks").cast("bigint").alias("n_blocks"), pieces.alias("pieces"))
    formatted = F.array_join(F.transform("pieces", lambda p: F.concat(p.mark, p.text)), "")
    return rows.select("key", formatted.alias("formatted"), _places("pieces").alias("loss"), "n_blocks")


def turns_of(formatted: Column) -> Column:
    """The turns in a formatted text: ``array<struct<role, text>>``."""
    blocks = F.split(formatted, END, -1)
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)

    def turns(block: Column) -> Column:
        role = F.substring_index(F.substring(block, len(BEGIN + HEAD) + 1, F.length(block)), BODY, 1)
        before = F.length(role) + len(BEGIN + HEAD + BODY)
        texts = F.split(F.substring(block, before + 1, F.length(block)), BEGIN, -1)
        return F.transform(texts, lambda t: F.struct(unescaped(role).alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_back(formatted: DataFrame) -> DataFrame:
    """Add what the output alone tells: ``turns`` from the text and ``loss_text`` from the mask.

    ``loss_text`` is the text under the mask without escapes.
    """
    cut = F.regexp_extract_all("formatted", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def under(place: Column) -> Column:
        first = F.floor(place.start / PIECE).cast("int")
        last = F.floor(place.end / PIECE).cast("int")
        near = F.array_join(F.slice("_pieces", first + 1, last - first + 1), "")
        return unescaped(F.substring(near, place.start - first * PIECE + 1, place.end - place.start))

    rows = formatted.withColumn("_pieces", cut)
    loss_text = F.when(F.size("_pieces") > 0, F.array_join(F.transform("loss", under), ""))
    rows = rows.withColumn("loss_text", F.coalesce(loss_text, F.lit("")))
    return rows.withColumn("turns", turns_of(F.col("formatted"))).drop("_pieces")
