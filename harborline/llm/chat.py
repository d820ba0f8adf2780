"""Chat formatting with a grammar round trip.

A conversation is rendered turn by turn as ``[INST]role[/INST]text</s>``.  The grammar is deterministic because no
control string occurs inside a role or a text: the parser cuts at every ``</s>`` and, in each piece, at the first
``[/INST]``.  A turn is first rendered as it is and parsed again; where that does not give the turn back, or a control
string is left inside it, role and text are escaped.  Escaping puts one backslash after the first character of a control string, also of one that already has
backslashes there, so reading back takes exactly one away and nothing else changes.

Rows: a NULL text or role reads as empty; turns are ordered by turn, role and text, NULL turns first, repeated rows
all stay; rows without a conversation id form one conversation of their own; extra columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "[INST]", "[/INST]", "</s>"
# What escaping looks for: each control string, with any backslashes after its first character.
CONTROL = r"([<\[])(\\*)(/s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(/s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(CLOSE))


def parse(rendered: Column) -> Column:
    """The turns (role, text) of rendered text, unescaped."""
    pieces = F.split(rendered, CLOSE.replace("/", r"\/"), -1)
    pieces = F.filter(pieces, lambda p: p != "")  # what follows the last turn

    def turn(piece: Column) -> Column:
        at = F.instr(piece, MIDDLE)
        return F.struct(unescape(F.substring(piece, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)).alias("role"),
                        unescape(F.substring(piece, at + len(MIDDLE), F.length(piece))).alias("text"))

    return F.transform(pieces, turn)


def rendered_turn(role: Column, text: Column) -> Column:
    """The turn as it is where it is free of control strings and parsing gives it back, else escaped."""
    plain = render_turn(role, text)
    back = parse(plain)
    same = ~role.rlike(CONTROL) & ~text.rlike(CONTROL)
    same = same & (F.size(back) == 1) & (F.element_at(back, 1).role == role) & (F.element_at(back, 1).text == text)
    return F.when(same, plain).otherwise(render_turn(escape(role), escape(text)))


def format_conversations(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """Per conversation: key, formatted (the rendered text), parsed (its turns read back), faithful (they are the same).

    Turns are rendered one by one before they meet; one conversation becomes one text, as it has to.
    """
    one = turns.select(F.col(key).alias("key"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"),
                       F.coalesce(text, F.lit("")).alias("text"))
    one = one.withColumn("body", rendered_turn(F.col("role"), F.col("text")))
    whole = one.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "body"))).alias("all"))
    whole = whole.select("key", "all", F.array_join("all.body", "").alias("formatted"))
    whole = whole.withColumn("parsed", parse(F.col("formatted")))
    source = F.transform("all", lambda t: F.struct(t.role, t.text))
    return whole.select(F.col("key").alias(key), "formatted", "parsed", (F.col("parsed") == source).alias("faithful"))


def digest(formatted: DataFrame, key: str = "conv_id", learned: str = "assistant") -> DataFrame:
    """Figures read back from the rendered text; the loss mask holds the texts of one role."""
    lines = F.array_join(F.transform("parsed", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("parsed", lambda t: t.role == learned), lambda t: t.text), "")
    return formatted.select(
        key, F.size("parsed").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "faithful")


def with_probe(conversations: DataFrame) -> DataFrame:
    """The turns and conversation -1, whose texts are full of control strings."""
    spark = conversations.sparkSession
    text = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(
        F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
