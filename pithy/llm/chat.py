"""Chat formatting whose output a deterministic parser reads back exactly.

DataFrame operations only. Grammar of a formatted conversation:

    user turn        [INST] text [/INST]
    assistant turn   <s>text</s>
    any other turn   [ROLE]role[:]text[/ROLE]

Control strings inside a role or text are broken by a backslash after their first
character, and backslashes doubled; reading removes one backslash before any
character. Only content that would not come back unchanged is escaped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROLS = ("[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[:]")
TURN = r"(?s)\[INST\] .*? \[/INST\]|<s>.*?</s>|\[ROLE\].*?\[/ROLE\]"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(c[0] + "\\" + c[1:])), CONTROLS, doubled)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render(role: Column, text: Column) -> Column:
    return (
        F.when(role == "user", F.concat(F.lit("[INST] "), text, F.lit(" [/INST]")))
        .when(role == "assistant", F.concat(F.lit("<s>"), text, F.lit("</s>")))
        .otherwise(F.concat(F.lit("[ROLE]"), role, F.lit("[:]"), text, F.lit("[/ROLE]")))
    )


def inside(turn: Column, before: int, after: int) -> Column:
    return F.substring(turn, F.lit(before + 1), F.char_length(turn) - before - after)


def parse_turn(turn: Column) -> Column:
    """(role, text, given): the turn's parts unescaped, and its text as formatted."""
    other = inside(turn, 6, 7)
    cut = F.instr(other, "[:]")
    role = (
        F.when(F.startswith(turn, F.lit("[INST] ")), "user").when(F.startswith(turn, F.lit("<s>")), "assistant")
        .otherwise(unescape(F.substring(other, F.lit(1), cut - 1)))
    )
    text = (
        F.when(F.startswith(turn, F.lit("[INST] ")), inside(turn, 7, 8)).when(F.startswith(turn, F.lit("<s>")), inside(turn, 3, 4))
        .otherwise(F.substring(other, cut + 3, F.char_length(other)))
    )
    return F.struct(role.alias("role"), unescape(text).alias("text"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, by the grammar alone."""
    return F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0)), parse_turn)


def comes_back(formatted: Column, turns: Column) -> Column:
    """Whether the formatted text parses to exactly these turns."""
    return F.concat(F.lit("#"), F.to_json(parse(formatted))) == F.concat(F.lit("#"), F.to_json(turns))


def format_conversations(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """(id_col, formatted, turns, recovered) per conversation.

    Turns are ordered by number; equal numbers by role, then text, and nulls first.
    Null texts and roles count as empty; rows with a null id form one conversation;
    repeated rows are repeated turns. An empty table gives an empty result; other
    columns are ignored.

    First each turn is rendered as it is and read back alone; turns that come back
    different are escaped. Then the whole conversation is read back; if it still
    differs from the source, all its turns are escaped; if even that differs, the job
    fails. One shuffle by conversation, whose text has to be one value anyway.
    """
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = render(role, text)
    escaped = render(F.when(role.isin("user", "assistant"), role).otherwise(escape(role)), escape(text))
    alone = F.regexp_extract_all(plain, F.lit(TURN), F.lit(0))
    back = parse_turn(F.get(alone, F.lit(0)))
    safe = (F.size(alone) == 1) & (F.get(alone, F.lit(0)) == plain) & (back["role"] == role) & (back["text"] == text)
    each = rows.select(F.col(id_col).alias("conv"), F.struct(
        F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
        F.when(safe, plain).otherwise(escaped).alias("first"), F.when(~safe | F.contains(plain, F.lit("\\")), escaped).alias("full"),
    ).alias("t"))
    whole = each.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("t"))
    turns = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    # `full` is null where escaping changes nothing.
    whole = whole.select(
        "conv", turns.alias("turns"), F.array_join(F.transform("t", lambda x: x["first"]), "").alias("first"),
        F.array_join(F.transform("t", lambda x: F.coalesce(x["full"], x["first"])), "").alias("full"),
    )
    whole = whole.select("conv", "turns", "full", F.when(comes_back(F.col("first"), F.col("turns")), F.col("first")).otherwise(F.col("full")).alias("formatted"))
    whole = whole.select("conv", "turns", "formatted", parse(F.col("formatted")).alias("recovered"))
    same = F.to_json("recovered").eqNullSafe(F.to_json("turns"))
    checked = F.when(same, F.col("formatted")).otherwise(F.raise_error(F.concat(F.lit("No round trip for conversation "), F.col("conv").cast("string"))))
    return whole.select(F.col("conv").alias(id_col), checked.alias("formatted"), "turns", "recovered")


def conversation_digests(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Digests of what is read back from `formatted`; the loss mask covers assistant texts."""
    read = F.col("recovered")
    loss = F.array_join(F.transform(F.filter(read, lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    turns = F.array_join(F.transform(read, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.select(
        id_col, F.size(read).cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
