"""Chat formatting by a grammar round trip. DataFrame functions only.

A conversation is rendered turn by turn as

    <s>role LF text </s> LF        (without the blanks)

and read back by a deterministic parser: cut at each '</s>' LF; a piece starts
with '<s>', its role ends at the first LF, the rest is the text; a reserved
string inside a piece is an error. The recovered turns are compared to the
source; turns that differ are escaped and the conversation is rendered and read
again, until nothing differs (the second round always agrees).

Escaping puts one backslash behind the first character of each reserved string,
and of each reserved string that has backslashes there already; reading takes
one out. So it is reversible and leaves other text alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<s>", "</s>"
#: Reserved control strings (fixed values): of this template and of others that tokenizers know.
RESERVED = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>"]
ROUNDS = 2

_TAILS = {first: "|".join("\\Q" + r[1:] + "\\E" for r in RESERVED if r[0] == first) for first in "<["}
_RAW = "|".join("\\Q" + r + "\\E" for r in RESERVED)
_ESCAPABLE = "|".join(f"(?:(?<=\\Q{first}\\E)(?=\\\\*(?:{tails})))" for first, tails in _TAILS.items())
_ESCAPED = "|".join(f"(?:(?<=\\Q{first}\\E)\\\\(?=\\\\*(?:{tails})))" for first, tails in _TAILS.items())


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPABLE), F.lit("\\\\"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPED), F.lit(""))


def escape_role(role: Column) -> Column:
    """A role has a line of its own: line feeds are written as %0A, and % as %25."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def render(turns: Column) -> Column:
    """Text of an array of (role, text)."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"), t["text"], F.lit(CLOSE + "\n"))), "")


def _pieces(formatted: Column) -> Column:
    """What stands between the turns' marks; the last cut leaves an empty piece."""
    cut = F.split(formatted, r"\Q</s>\E\n", -1)
    return F.slice(cut, F.lit(1), F.size(cut) - 1)


def parse(formatted: Column) -> Column:
    """(role, text, valid) of each piece, unescaped."""

    def turn(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(OPEN) + 1))
        at = F.instr(body, "\n")
        valid = F.startswith(piece, F.lit(OPEN)) & (at > 0) & ~F.rlike(body, F.lit(_RAW))
        return F.struct(unescape_role(F.substr(body, F.lit(1), at - 1)).alias("role"), unescape(F.substr(body, at + 1)).alias("text"), valid.alias("valid"))

    return F.transform(_pieces(formatted), turn)


def loss_spans(formatted: Column, role: str = "assistant") -> Column:
    """(start, end) in ``formatted`` (characters, end exclusive) of the texts of turns of ``role``, as they stand there (escaped)."""
    pieces = F.transform(_pieces(formatted), lambda p: F.struct(F.char_length(p).alias("size"), F.startswith(p, F.lit(f"{OPEN}{role}\n")).alias("own")))
    head, tail = len(OPEN) + len(role) + 1, len(CLOSE) + 1
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        span = F.array(F.struct((acc["at"] + head).alias("start"), (acc["at"] + p["size"]).alias("end")))
        return F.struct((acc["at"] + p["size"] + tail).alias("at"), F.when(p["own"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(pieces, start, step)["spans"]


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (read back), loss_spans, round_trip of each conversation.

    Rows are ordered by turn (a null turn first; rows of one turn by role and
    text). A null role or text is empty. Rows with a null conv_id are one
    conversation. Repeated rows are turns of their own. A conversation is one
    text, so its turns meet in one row; other columns are not read.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    state = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    state = state.select("conv_id", F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("source"))
    state = state.withColumn("written", F.col("source"))
    for _ in range(ROUNDS):
        state = state.withColumn("formatted", render(F.col("written"))).withColumn("turns", parse(F.col("formatted")))
        # Arrays are zipped, each made once; looking them up turn by turn would parse the whole text again for each.
        same = F.zip_with("source", "turns", lambda s, t: F.coalesce(t == F.struct(s["role"].alias("role"), s["text"].alias("text"), F.lit(True).alias("valid")), F.lit(False)))
        tried = F.zip_with("written", same, lambda w, ok: F.struct(w.alias("w"), ok.alias("ok")))
        again = F.zip_with(tried, "source", lambda p, s: F.when(p["ok"], p["w"]).otherwise(F.struct(escape_role(s["role"]).alias("role"), escape(s["text"]).alias("text"))))
        state = state.withColumn("written", F.slice(again, F.lit(1), F.size("source")))
    state = state.withColumn("formatted", render(F.col("written"))).withColumn("turns", parse(F.col("formatted")))
    back = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return state.select("conv_id", "formatted", back.alias("turns"), loss_spans(F.col("formatted")).alias("loss_spans"), ((F.size("turns") == F.size("source")) & (back == F.col("source")) & F.forall("turns", lambda t: t["valid"])).alias("round_trip"))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, span by span."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["end"] - s["start"]))), "")
