"""Chat formatting with a grammar round trip, built-in functions only.

A turn is rendered as ``<|im_start|>role`` LF ``text<|im_end|>`` LF. The grammar reads it back: turns end at
``<|im_end|>`` LF, begin with ``<|im_start|>``, a role up to the first line end, and a text; neither holds a control string.
Then escapes are undone: in texts ``<``, backslashes and ``|`` lose one backslash; in roles ``\\p``, ``\\n`` and ``\\b`` stand for
``|``, a line end and a backslash.

Every turn is rendered and read back until the reading equals the source: first as it stands, then with the control
strings inside it escaped, then with everything escaped that the grammar would undo. The last level always reads back,
since it adds a backslash wherever the reader takes one off. Turns are settled row by row, before they are brought
together; a conversation is one output row, as a document is, and read back as a whole once more, its turns' hashes compared (``identical``).

Defined cases: null texts and roles are empty ones; turns go by number, nulls first, then as rendered; repeated rows stay; null conversation ids are one conversation; very long texts are not cut; other columns are ignored; an empty table
gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"
_TURN = "array<struct<role:string,text:string>>"
_CONTROL = r"<\|im_(start|end)\|>"
#: Marks a reader takes a backslash off, or would if there was one.
_MARK = r"<(\\*+)\|"


def _text_escaped(level: int, text: Column) -> Column:
    if level == 0:
        return text
    return F.regexp_replace(text, _CONTROL, r"<\\|im_$1|>") if level == 1 else F.regexp_replace(text, _MARK, r"<\\$1|")


def _role_escaped(level: int, role: Column) -> Column:
    if level == 0:
        return role
    slashes = F.replace(role, F.lit("\\"), F.lit("\\b"))
    return F.replace(F.replace(slashes, F.lit("|"), F.lit("\\p")), F.lit("\n"), F.lit("\\n"))


def text_read(text: Column) -> Column:
    """A text as it was before it was escaped."""
    return F.regexp_replace(text, r"<\\(\\*+)\|", r"<$1|")


def role_read(role: Column) -> Column:
    marks = F.replace(F.replace(role, F.lit("\\p"), F.lit("|")), F.lit("\\n"), F.lit("\n"))
    return F.replace(marks, F.lit("\\b"), F.lit("\\"))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(f"{END}\n"))


def segments(formatted: Column) -> Column:
    """The turns of a formatted text, without their ends; what follows the last end comes last."""
    return F.split(formatted, f"\\Q{END}\\E\n", -1)


def parsed(formatted: Column) -> Column:
    """Turns of a formatted text with escapes undone, or null where the grammar does not hold."""
    parts = segments(formatted)
    turns = F.slice(parts, F.lit(1), F.size(parts) - 1)
    body = lambda s: F.substring(s, F.lit(len(START) + 1), F.length(s))
    valid = lambda s: s.startswith(START) & body(s).contains("\n") & ~body(s).contains(START) & ~body(s).contains(END)
    turn = lambda s: F.struct(
        role_read(F.substring_index(body(s), "\n", 1)).alias("role"),
        text_read(F.substring(s, F.lit(len(START) + 1) + F.locate("\n", body(s)), F.length(s))).alias("text"),
    )
    whole = (F.element_at(parts, -1) == "") & F.forall(turns, valid)
    return F.when(whole, F.transform(turns, turn))


def settled(role: Column, text: Column) -> Column:
    """(role, text), escaped no more than needed for the reading to equal the source."""
    source = F.array(F.struct(role.alias("role"), text.alias("text"))).cast(_TURN)
    tries = [F.struct(_role_escaped(r, role).alias("role"), _text_escaped(t, text).alias("text")) for r in (0, 1) for t in (0, 1, 2)]
    reads = lambda t: F.coalesce(parsed(rendered(t["role"], t["text"])).cast(_TURN) == source, F.lit(False))
    chosen = tries[-1]
    for t in reversed(tries[:-1]):
        chosen = F.when(reads(t), t).otherwise(chosen)
    return chosen


def chat(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Per conversation ``formatted``, its loss mask ``loss`` and ``identical``: whether all of it reads back as its source.

    ``loss`` lists the texts of ``learned`` roles, in order: code points from ``start`` on, ``length`` of them; ``turn`` is the
    number of the turn and ``at`` the place in it, both from 0."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), empty(role_col).alias("role"), empty(text_col).alias("text"))
    made = rows.withColumn("made", settled(F.col("role"), F.col("text"))).select(
        "conv_id", "turn", rendered(F.col("made.role"), F.col("made.text")).alias("piece"), (F.length("made.role") + len(START) + 1).alias("at"), F.length("made.text").alias("length"),
        F.col("role").isin(*learned).alias("learned"), F.xxhash64("role", "text").alias("source"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "piece")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = made.withColumn("k", F.row_number().over(order) - 1).withColumn("start", F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)))
    turns = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("k", "piece", "start", "at", "length", "learned", "source"))).alias("turns"))
    mask = F.transform(F.filter("turns", lambda t: t["learned"]), lambda t: F.struct(t["k"].alias("turn"), t["at"].alias("at"), (t["start"] + t["at"]).alias("start"), t["length"].alias("length")))
    out = turns.select("conv_id", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"), mask.alias("loss"), F.transform("turns", lambda t: t["source"]).alias("source"))
    again = F.transform(parsed(F.col("formatted")), lambda t: F.xxhash64(t["role"], t["text"]))
    return out.select("conv_id", "formatted", "loss", F.coalesce(again == F.col("source"), F.lit(False)).alias("identical"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``turns`` and ``loss_text`` (all text under the mask, unescaped), from ``formatted`` and ``loss`` alone."""
    parts = formatted.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), "loss", parsed(F.col("formatted")).alias("turns"), segments(F.col("formatted")).alias("parts"))
    under = F.transform("loss", lambda m: text_read(F.substring(F.get("parts", m["turn"]), m["at"] + 1, m["length"])))
    return parts.select("conv_id", "turns", F.array_join(under, "").alias("loss_text"), "formatted_chars")
