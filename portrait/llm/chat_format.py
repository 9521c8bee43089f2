"""Chat formatting with a grammar round trip, in DataFrame functions only.

A turn is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``.  The rendered
turn is parsed again by the deterministic grammar below and compared with its
source; while they differ, the turn is escaped further, until both are equal:
plain, then control strings of the text escaped, then also line ends and
backslashes of the role.

Grammar: a document is a sequence of turns; a turn's text runs to the next end
mark and may hold no control string.  A control string is a first character,
``<`` or ``[``, and a rest; one with n >= 1 backslashes after the first
character stands for the same with n - 1.  Control strings hold no other ``<``
or ``[``, so none overlap and the escape is a bijection.

Turns are rendered one by one; only ``conversations`` brings a conversation's
turns together, since one string per conversation is what it returns.  Defined
cases: null text and null role are empty; null conv_id is one conversation of
its own; turns are ordered by (turn, role, text), null turns first; equal rows
are separate turns; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
# control strings (fixed values): the two marks of the template and those of another common one
CONTROL = ["<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]"]
_REST = r"(\|im_start\|>|\|im_end\|>|s>|/s>|INST\]|/INST\])"
RAW = r"([<\[])" + _REST
ANY = r"([<\[])(\\*)" + _REST
ESCAPED = r"([<\[])\\(\\*)" + _REST
LOSS_ROLE = "assistant"


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, ANY, r"$1\\$2$3")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape_text(role), F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape_text(F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\")))


def parse_turn(body: Column) -> Column:
    """A turn's inside (between the marks) as struct(role, text); null where
    the grammar does not allow it."""
    at = F.instr(body, "\n")
    role, text = F.substr(body, F.lit(1), at - 1), F.substr(body, at + 1)
    sound = (at > 0) & ~body.rlike(RAW)
    return F.when(sound, F.struct(unescape_role(role).alias("role"), unescape_text(text).alias("text")))


def render_turns(rows: DataFrame) -> DataFrame:
    """Adds ``rendered`` (and ``level``, the escapes it took) to rows with
    ``role`` and ``text``."""
    want = F.struct(F.col("role").alias("role"), F.col("text").alias("text"))
    join = lambda role, text: F.concat(role, F.lit("\n"), text)
    tries = [join(F.col("role"), F.col("text")), join(F.col("role"), escape_text(F.col("text"))),
             join(escape_role(F.col("role")), escape_text(F.col("text")))]
    body, level = tries[-1], F.lit(2)
    for i in (1, 0):
        same = parse_turn(tries[i]).eqNullSafe(want)
        body, level = F.when(same, tries[i]).otherwise(body), F.when(same, i).otherwise(level)
    return rows.withColumn("level", level).withColumn("rendered", F.concat(F.lit(START), body, F.lit(END)))


def conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id and the formatted text."""
    turns = render_turns(rows.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    return turns.groupBy("conv_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", "rendered"))),
        lambda x: x["rendered"]), "").alias("formatted"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Parses ``formatted`` again: adds ``turns``, an array of (role, text)."""
    bodies = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda x: x != "")
    return formatted.withColumn("turns", F.transform(
        bodies, lambda x: parse_turn(F.substr(x, F.lit(len(START) + 1)))))


def digest(formatted: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """Figures read back from the output; the loss mask covers the text of
    each turn of ``loss_role``."""
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == loss_role), lambda t: t["text"]), "")
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(formatted).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(every, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
