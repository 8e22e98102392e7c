r"""Chat formatting by Spark expressions: turns to marked text with a loss mask, and back.

Turn structs are collected per conversation and sorted; neighbours of one role become one
block, whose texts a separator keeps apart. A system block is <<SYS>>..<</SYS>>, a user
block [INST]..[/INST], an assistant block <s>..</s>, any other
<<ROLE>>role<</ROLE>>..<</TURN>>. In texts a backslash is doubled and a control string
gets one after its first character, so control strings stand only between turns.

Defined results. Null text and null role: empty. Null conversation: a conversation of its
own. Null turn: first. Equal turns: by role, then text; repeated rows stay. Empty table:
no rows. Other columns are not read. A conversation is one row by its nature; only its
own turns meet in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Role: (opening, closing).
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
ROLE, END_ROLE, END_TURN, BETWEEN = "<<ROLE>>", "<</ROLE>>", "<</TURN>>", "<<SEP>>"
#: A control string as its first character and the rest (a few more strings match; harmless).
CONTROL = r"([\[<])(/?INST\]|/?s>|</?(?:SYS|ROLE)>>|</TURN>>|<SEP>>)"
BLOCK = r"(?s)<<SYS>>.*?<</SYS>>|\[INST\].*?\[/INST\]|<s>.*?</s>|<<ROLE>>.*?<</TURN>>"


def escaped(text: Column) -> Column:
    # Four backslashes in a replacement stand for two.
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, CONTROL, r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _mark(role: Column, at: int) -> Column:
    other = F.concat(F.lit(ROLE), escaped(role), F.lit(END_ROLE)) if at == 0 else F.lit(END_TURN)
    for name, marks in MARKS.items():
        other = F.when(role == name, marks[at]).otherwise(other)
    return other


def format_chat(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, formatted and segments: the text in pieces, each with whether it is trained on."""
    role = F.coalesce(F.col("role"), F.lit(""))
    turn = F.struct("turn", role.alias("role"), escaped(F.coalesce(F.col("text"), F.lit(""))).alias("text"))
    sorted_turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def pieces(all_turns: Column) -> Column:
        def piece(one: Column, k: Column) -> Column:
            before = F.when(k > 0, F.get(all_turns, k - 1)["role"])
            after = F.get(all_turns, k + 1)["role"]
            return F.array(
                F.struct(F.when(before == one["role"], BETWEEN).otherwise(_mark(one["role"], 0)).alias("text"), F.lit(False).alias("loss")),
                F.struct(one["text"].alias("text"), one["role"].isin(*loss_roles).alias("loss")),
                F.struct(F.when(after == one["role"], "").otherwise(_mark(one["role"], 1)).alias("text"), F.lit(False).alias("loss")),
            )

        return F.filter(F.flatten(F.transform(all_turns, piece)), lambda x: x["text"] != "")

    # The inner array binds the sorted turns once instead of once a turn.
    segments = F.transform(F.array("turns"), pieces)[0]
    joined = F.array_join(F.transform("segments", lambda x: x["text"]), "")
    return sorted_turns.select("conv_id", segments.alias("segments")).select("conv_id", joined.alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """format_chat's turns again: structs of role and text in order."""

    def turns_of(block: Column) -> Column:
        def inside(opening: str, closing: str) -> Column:
            return F.substring(block, F.lit(len(opening) + 1), F.length(block) - len(opening) - len(closing))

        body, name = F.substring_index(inside(ROLE, END_TURN), END_ROLE, -1), unescaped(F.substring_index(inside(ROLE, END_TURN), END_ROLE, 1))
        for role, marks in MARKS.items():
            own = F.startswith(block, F.lit(marks[0]))
            body, name = F.when(own, inside(*marks)).otherwise(body), F.when(own, role).otherwise(name)
        return F.transform(F.split(body, BETWEEN, -1), lambda x: F.struct(name.alias("role"), unescaped(x).alias("text")))

    return F.flatten(F.transform(F.regexp_extract_all(formatted, F.lit(BLOCK), F.lit(0)), turns_of))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda x: x["loss"]), lambda x: unescaped(x["text"])), "")
