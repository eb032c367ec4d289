"""Chat formatting with a grammar that reads back what was written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapwatch.llm.tables import text_or_empty

# How a turn opens and closes, by role. Any other role is written between ROLE and TEXT.
MARKS = {"user": ("[INST] ", " [/INST]\n"), "assistant": ("<s> ", " </s>\n"), "system": ("<<SYS>> ", " <</SYS>>\n")}
OTHER_OPEN, OTHER_TEXT, OTHER_CLOSE = "<<ROLE>> ", " <<TEXT>> ", " <</ROLE>>\n"
LOSS_ROLE = "assistant"

# A control string is one of these characters and then one of these ends. Backslashes between the two take
# away its meaning; a text gets one more of them, and reading takes one away.
_HEAD, _TAIL = r"([<\[])", r"(/?INST\]|/?s>|</?SYS>>|</?ROLE>>|<TEXT>>)"
_CONTROL = _HEAD + _TAIL
_TURN = (
    r"(?s)\[INST\] .*? \[/INST\]\n|<s> .*? </s>\n|<<SYS>> .*? <</SYS>>\n|<<ROLE>> .*? <<TEXT>> .*? <</ROLE>>\n"
)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _HEAD + r"(\\*)" + _TAIL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _HEAD + r"\\(\\*)" + _TAIL, "$1$2$3")


def _by_role(role: Column, known, other: Column) -> Column:
    out = None
    for name, marks in MARKS.items():
        out = (F if out is None else out).when(role == name, known(*marks))
    return out.otherwise(other)


def _pieces(role: Column, text: Column, escaped: Column) -> Column:
    """The parts of a written turn: opening, text, closing; only the text of LOSS_ROLE lies under the loss mask."""
    safe_role = escape(role)
    opening = _by_role(role, lambda o, c: F.lit(o), F.concat(F.lit(OTHER_OPEN), safe_role, F.lit(OTHER_TEXT)))
    closing = _by_role(role, lambda o, c: F.lit(c), F.lit(OTHER_CLOSE))
    body = F.when(escaped, escape(text)).otherwise(text)
    part = lambda t, loss: F.struct(t.alias("text"), loss.alias("loss"))
    return F.array(part(opening, F.lit(False)), part(body, role == LOSS_ROLE), part(closing, F.lit(False)))


def parse_turn(turn: Column) -> Column:
    """(role, text) of one written turn; NULL where a control string stands inside it, as that can't be read."""

    def inner(opening: str, closing: str) -> Column:
        return F.substr(turn, F.lit(len(opening) + 1), F.length(turn) - (len(opening) + len(closing)))

    other = inner(OTHER_OPEN, OTHER_CLOSE)
    place = F.instr(other, OTHER_TEXT)
    role, body = F.lit(None).cast("string"), F.lit(None).cast("string")
    is_other = turn.startswith(OTHER_OPEN) & (place > 0)
    role = F.when(is_other, F.substr(other, F.lit(1), place - 1))
    body = F.when(is_other, F.substr(other, place + len(OTHER_TEXT)))
    for name, (opening, closing) in MARKS.items():
        here = turn.startswith(opening)
        role, body = F.when(here, F.lit(name)).otherwise(role), F.when(here, inner(opening, closing)).otherwise(body)
    readable = body.isNotNull() & ~body.rlike(_CONTROL) & ~role.rlike(_CONTROL)
    return F.when(readable, F.struct(unescape(role).alias("role"), unescape(body).alias("text")))


def parse_chat(formatted: Column) -> Column:
    """All (role, text) turns of a formatted conversation, read from the text alone."""
    return F.transform(F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0)), parse_turn)


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conv_id: ``formatted``, ``segments`` (text, loss) that join to it, ``turns`` (role, text) as
    given, ``round_trip``.

    A turn is first written as it is, read back by the grammar, and written again with its control strings escaped
    if it was not recovered; escaped text always is. ``round_trip`` compares the turns read from the whole
    conversation with the given ones. Turns are ordered by turn, then role and text (ties, repeated rows; all are
    kept). NULL text and NULL role count as empty, NULL turn comes first, rows without conv_id are one conversation
    with a NULL id. An empty table gives no rows. Other columns are not looked at. A conversation becomes one text,
    so its turns meet in one row; nothing larger than a conversation does.
    """
    written = turns.select("conv_id", "turn", text_or_empty("role").alias("_role"), text_or_empty("text").alias("_text"))
    role, text = F.col("_role"), F.col("_text")
    plain = F.array_join(F.transform(_pieces(role, text, F.lit(False)), lambda p: p["text"]), "")
    # A text without these characters can't hold a control string, with or without a backslash.
    recovered = parse_turn(plain)
    escaped = F.when(
        text.contains("<") | text.contains("["),
        ~F.coalesce((recovered["role"] == role) & (recovered["text"] == text), F.lit(False)),
    ).otherwise(F.lit(False))
    row = F.struct("turn", role.alias("role"), text.alias("text"), escaped.alias("escaped"))
    chats = written.select("conv_id", row.alias("_row")).groupBy("conv_id").agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
    chats = chats.select(
        "conv_id",
        F.transform("_rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("turns"),
        F.flatten(F.transform("_rows", lambda r: _pieces(r["role"], r["text"], r["escaped"]))).alias("segments"),
    )
    chats = chats.select("*", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))
    chats = chats.select("*", parse_chat(F.col("formatted")).alias("_read"))
    return chats.select("conv_id", "formatted", "segments", "turns", (F.col("_read") == F.col("turns")).alias("round_trip"))
