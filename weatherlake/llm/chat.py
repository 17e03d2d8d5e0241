"""Chat formatting checked by a grammar round trip; DataFrame functions only.

A conversation is rendered as one string of turns

    <s>ROLE[INST]TEXT[/INST]</s>

Inside role and text a backslash may escape the character after it.  The parser is deterministic:
it splits at ``</s>``, then at the first ``[INST]``, drops the closing ``[/INST]`` and removes the
escapes.  A control string inside role or text is a syntax error and reads as null.  Rendering starts without escapes.  Turns whose text the parser does not give back are
escaped, and if the conversation still differs all its turns are; escaped content has no control
string in it, so then it is identical.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, BODY, SHUT, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = r"</?s>|\[/?INST\]"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, r"([<\[])(?=/?(?:s>|INST\]))", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(BODY), text, F.lit(SHUT + CLOSE))


def parse(rendered: Column) -> Column:
    """Turns (role, text, body) of a rendered conversation; body is the text as it stands there."""
    pieces = F.filter(F.split(rendered, CLOSE, -1), lambda piece: piece != "")

    def turn(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(len(OPEN) + 1), F.length(piece) - len(OPEN))
        head = F.substring_index(inner, BODY, 1)
        rest = F.substring(inner, F.length(head) + len(BODY) + 1, F.length(inner))
        body = F.substring(rest, F.lit(1), F.greatest(F.length(rest) - len(SHUT), F.lit(0)))
        role = F.when(~head.rlike(CONTROL), unescape(head))
        text = F.when(~body.rlike(CONTROL), unescape(body))
        return F.struct(role.alias("role"), text.alias("text"), body.alias("body"), head.alias("head"))

    return F.transform(pieces, turn)


def format_chats(
    df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: conv_id, formatted, turns (read back), loss_spans.

    Turns stand in order of turn, then role and text, so repeated rows stay as repeated turns.  Null
    role or text counts as empty, a null turn comes first, null ids form one conversation, no
    rows give no conversation.  loss_spans holds (start, length) in code points, from 0, of each
    assistant text in ``formatted``.  A conversation is one training sample and thus one row.
    """
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")
    ).alias("_turn"))
    # A turn is parsed alone first: what it does not give back needs escapes.
    raw = render_turn(F.col("_turn.role"), F.col("_turn.text"))
    whole = F.array(F.struct(F.col("_turn.role").alias("role"), F.col("_turn.text").alias("text")))
    found = F.transform(parse(raw), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    rows = rows.withColumn("_plain", found == whole)
    escaped = render_turn(escape(F.col("_turn.role")), escape(F.col("_turn.text")))
    rows = rows.withColumn("_full", escaped).withColumn("_raw", F.when(F.col("_plain"), raw).otherwise(escaped))
    turns = F.sort_array(F.collect_list(F.struct(
        F.col("_turn.turn").alias("turn"), F.col("_turn.role").alias("role"), F.col("_turn.text").alias("text"), "_raw", "_full"
    )))
    chats = rows.groupBy("conv_id").agg(turns.alias("_turns"))
    source = F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    chats = chats.withColumn("_first", F.array_join(F.transform("_turns", lambda t: t["_raw"]), ""))
    again = F.transform(parse(F.col("_first")), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    last = F.array_join(F.transform("_turns", lambda t: t["_full"]), "")
    chats = chats.withColumn("formatted", F.when(again == source, F.col("_first")).otherwise(last))
    chats = chats.select("conv_id", "formatted", parse(F.col("formatted")).alias("_parsed"))
    width = len(OPEN) + len(BODY) + len(SHUT) + len(CLOSE)
    none = F.array().cast("array<struct<start:int,length:int>>")

    def add(state: Column, t: Column) -> Column:
        start = state["at"] + len(OPEN) + F.length(t["head"]) + len(BODY)
        span = F.struct(start.alias("start"), F.length(t["body"]).alias("length"))
        spans = F.when(t["role"] == "assistant", F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        at = state["at"] + width + F.length(t["head"]) + F.length(t["body"])
        return F.struct(at.alias("at"), spans.alias("spans"))

    state = F.aggregate("_parsed", F.struct(F.lit(0).alias("at"), none.alias("spans")), add)
    turns = F.transform("_parsed", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return chats.select("conv_id", "formatted", turns.alias("turns"), state["spans"].alias("loss_spans"))


def chat_digests(chats: DataFrame) -> DataFrame:
    """Digests of what is read back from ``format_chats``: all turns, and the text under the loss mask."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = F.transform(
        "loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))
    )
    rows = chats.withColumn("_loss", F.array_join(masked, ""))
    return rows.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
