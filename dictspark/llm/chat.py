"""Chat formatting in Spark expressions: sorted turn structs, adjacent turns of one role merged, a reversible template.

A conversation becomes ``<s>`` and its blocks. A block holds the adjacent turns of one role, with ``<turn>`` between them::

    user                  [INST] text [/INST]
    assistant              text </s>
    system                <<SYS>> text <</SYS>>
    another role          <role>name</name> text </role>

Control strings inside a text are broken by a backslash after their first character, and backslashes are doubled, so that a
text never holds a control string and can be read back. The loss mask covers the escaped texts of the assistant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scan

BEGIN, TURN = "<s>", "<turn>"
#: Opening and closing of a role's block.
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": (" ", " </s>"), "system": ("<<SYS>> ", " <</SYS>>")}
LEARNT = "assistant"

#: Control strings without their first character.
_CONTROL = r"s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|turn>|role>|/role>|/name>|none/>"


def escape(text: Column) -> Column:
    """No control string is left; :func:`unescape` gives the text back."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), rf"([<\[])({_CONTROL})", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[]?)\\(\\|{_CONTROL})", "$1$2")


def _role_name(role: Column) -> Column:
    return F.when(role.isNull(), F.lit("<none/>")).otherwise(escape(role))


def _opening(role: Column) -> Column:
    known = F.when(role == "user", MARKS["user"][0]).when(role == "assistant", MARKS["assistant"][0]).when(role == "system", MARKS["system"][0])
    return known.otherwise(F.concat(F.lit("<role>"), _role_name(role), F.lit("</name> ")))


def _closing(role: Column) -> Column:
    known = F.when(role == "user", MARKS["user"][1]).when(role == "assistant", MARKS["assistant"][1]).when(role == "system", MARKS["system"][1])
    return known.otherwise(F.lit(" </role>"))


def formatted(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, formatted, loss``: one row per conversation, ``loss`` an array of the spans (start, length, in code points) to learn from.

    Turns are ordered by number, turns of equal number by role and text; null numbers come first, null texts are empty, a null role is a role of
    its own. Rows with a null ``conv_id`` are one conversation. Repeated rows are turns of their own. Other columns are not read; an empty
    table gives no rows. One row holds a conversation, as the output asks for; nothing else is gathered by it.
    """
    named = rows.select(F.col(conv_id).alias("conv_id"), F.struct(F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"), escape(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("text")).alias("t"))
    turns = named.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # a turn opens a block if its role differs from the one before, and closes it if it differs from the one after
    beside = lambda i: F.get(F.col("turns"), i)["role"]
    edge = lambda a, b: ~a.eqNullSafe(b)
    n = F.size("turns")

    def piece(t: Column, i: Column) -> Column:
        opens = (i == 0) | edge(beside(i - 1), t["role"])
        closes = (i == n - 1) | edge(beside(i + 1), t["role"])
        before = F.concat(F.when(i == 0, BEGIN).otherwise(""), F.when(opens, _opening(t["role"])).otherwise(TURN))
        return F.struct(before.alias("before"), t["text"].alias("text"), F.when(closes, _closing(t["role"])).otherwise("").alias("after"), (t["role"] == LEARNT).alias("learnt"))

    pieces = turns.select("conv_id", F.transform("turns", piece).alias("pieces"))
    size = lambda p: F.length(p["before"]) + F.length(p["text"]) + F.length(p["after"])
    step = lambda p, at: F.struct((at + F.length(p["before"])).cast("long").alias("start"), F.length(p["text"]).cast("long").alias("length"), F.coalesce(p["learnt"], F.lit(False)).alias("learnt"))
    spans = scan(F.col("pieces"), F.lit(0), lambda at, p: at + size(p), step, lambda a, b: a + b, "struct<start:bigint,length:bigint,learnt:boolean>")
    whole = F.array_join(F.transform("pieces", lambda p: F.concat(p["before"], p["text"], p["after"])), "")
    loss = F.transform(F.filter("spans", lambda s: s["learnt"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))
    return pieces.withColumn("spans", spans).select("conv_id", whole.alias("formatted"), loss.alias("loss"))


_ENDS = {role: closing for role, (_, closing) in MARKS.items()} | {None: " </role>"}


def parsed(text: Column) -> Column:
    """The turns of a formatted conversation as ``array<struct<role, text>>``, read from the string alone.

    The string is cut at the ends of blocks, which a text can't hold; a block's end tells its role, or that its opening names it.
    """
    body = text.substr(F.lit(len(BEGIN) + 1), F.length(text))
    blocks = F.regexp_extract_all(body, F.lit(r"(?s).*?(?: \[/INST\]| </s>| <</SYS>>| </role>)"), F.lit(0))

    def turns(block: Column) -> Column:
        name = F.regexp_extract(block, r"(?s)^<role>(.*?)</name> ", 1)
        role, start, end = F.when(name != "<none/>", unescape(name)), F.length(name) + len("<role></name> "), F.lit(len(_ENDS[None]))
        for known, (opening, closing) in MARKS.items():
            own = block.endswith(closing)
            role, start, end = F.when(own, known).otherwise(role), F.when(own, len(opening)).otherwise(start), F.when(own, len(closing)).otherwise(end)
        inner = block.substr(start + 1, F.length(block) - start - end)
        return F.transform(F.split(inner, TURN, -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def under_mask(text: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescape(text.substr((s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
