r"""Chat text from turns by a grammar round trip, in DataFrame operations only.

A conversation is rendered as one text, read again by a deterministic parser, and
compared with its turns; turns that come back otherwise are escaped and the
conversation is rendered and read again, until it comes back identical.

Grammar::

    text := turn*
    turn := "<s>" role "\n" body "</s>"
    body := "[INST] " said " [/INST]" for role user, "<<SYS>>" said "<</SYS>>" for role system, said for others

``said`` and ``role`` must not hold a control string (``<s> </s> [INST] [/INST]
<<SYS>> <</SYS>>``); a backslash makes the next character plain, and stands
after the first character of an escaped control string or doubled for itself.

Defined cases: a null text or role counts as empty; a null ``conv_id`` is a
conversation of its own; turns sort by turn, then role, then text, so ties and
repeated rows keep a fixed order and all appear; an empty table gives an empty
result; other columns never take part.  A conversation is one row of the output,
so its size bounds the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A backslash, or the first character of a control string.
CONFLICT = r"\\|<(?=/?s>|<SYS>>|</SYS>>)|\[(?=/?INST\])"
#: What a text must not hold: a control string, or a last backslash that escapes nothing.
CONTROL = r"</?s>|<<SYS>>|<</SYS>>|\[/?INST\]|(?<!\\)(?:\\\\)*\\\z"
TURNS = "array<struct<role:string,said:string>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONFLICT, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\s\S])", "$1")


def _escape_role(role: Column) -> Column:
    return F.regexp_replace(escape(role), "\n", "\\\\\n")


def _opening(role: Column) -> Column:
    return F.when(role == "user", "[INST] ").when(role == "system", "<<SYS>>").otherwise("")


def _closing(role: Column) -> Column:
    return F.when(role == "user", " [/INST]").when(role == "system", "<</SYS>>").otherwise("")


def _rendered(turn: Column, escaped: Column) -> Column:
    """``(before, said, after)`` of one turn, as written."""
    role, said = turn["role"], turn["said"]
    as_role = F.when(escaped, _escape_role(role)).otherwise(role)
    return F.struct(
        F.concat(F.lit("<s>"), as_role, F.lit("\n"), _opening(role)).alias("before"),
        F.when(escaped, escape(said)).otherwise(said).alias("said"),
        F.concat(_closing(role), F.lit("</s>")).alias("after"),
    )


def _joined(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda p: F.concat(p["before"], p["said"], p["after"])), "")


def _parsed_piece(piece: Column) -> Column:
    """The turn that a piece between two ``</s>`` says, null where it breaks the grammar."""
    written = F.regexp_extract(piece, r"^<s>((?:[^\\\n]++|\\[\s\S])*+)\n", 1)
    role = unescape(written)
    starts = F.startswith(piece, F.concat(F.lit("<s>"), written, F.lit("\n"), _opening(role)))
    body = F.substring(piece, F.char_length(written) + F.char_length(_opening(role)) + F.lit(5), F.char_length(piece))
    ends = F.endswith(body, _closing(role))
    said = F.left(body, F.char_length(body) - F.char_length(_closing(role)))
    plain = ~F.rlike(said, F.lit(CONTROL)) & ~F.rlike(written, F.lit(CONTROL))
    return F.when(starts & ends & plain, F.struct(role.alias("role"), unescape(said).alias("said")))


def parse(text: Column) -> Column:
    """Turns of a rendered text: ``array<struct<role,said>>``, with null for each piece outside the grammar."""
    pieces = F.split(text, "</s>", -1)
    whole = F.transform(F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))), _parsed_piece)
    return F.when(F.element_at(pieces, -1) == "", whole).otherwise(F.concat(whole, F.array(F.lit(None).cast("struct<role:string,said:string>"))))


def conversations(turns: DataFrame) -> DataFrame:
    """``conv_id`` and its turns in order."""
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("said"),
        ).alias("t"),
    )
    ordered = F.array_sort(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["said"].alias("said"))).alias("turns"))


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``loss`` (spans ``start, length`` in code points of the
    assistant texts as written), ``escaped`` (turns that needed it) and ``identical`` (whether the last reading gave
    the turns back).  ``turns`` has ``conv_id, turn, role, text``."""
    plain = conversations(turns).withColumn("first", F.transform("turns", lambda t: _rendered(t, F.lit(False))))
    # First reading: turns that do not come back alone are in conflict.
    alone = F.transform(
        F.arrays_zip("turns", "first"),
        lambda z: ~parse(F.concat(z["first"]["before"], z["first"]["said"], z["first"]["after"])).eqNullSafe(F.array(z["turns"])),
    )
    same = parse(_joined(F.col("first"))).eqNullSafe(F.col("turns"))
    first = plain.withColumn("marks", F.when(same, F.transform("turns", lambda t: F.lit(False))).otherwise(alone)).drop("first")
    again = first.withColumn("parts", F.transform(F.arrays_zip("turns", "marks"), lambda z: _rendered(z["turns"], z["marks"])))
    # Second reading: if a conversation still differs, escape all of its turns.
    same = parse(_joined(F.col("parts"))).eqNullSafe(F.col("turns"))
    last = F.when(same, F.col("parts")).otherwise(F.transform("turns", lambda t: _rendered(t, F.lit(True))))
    done = again.withColumn("marks", F.when(same, F.col("marks")).otherwise(F.transform("marks", lambda m: F.lit(True)))).withColumn("parts", last)
    size = F.char_length
    ends = F.aggregate(
        F.arrays_zip("turns", "parts"),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, z: F.struct(
            (acc["at"] + size(z["parts"]["before"]) + size(z["parts"]["said"]) + size(z["parts"]["after"])).alias("at"),
            F.when(
                z["turns"]["role"] == "assistant",
                F.concat(
                    acc["spans"],
                    F.array(F.struct((acc["at"] + size(z["parts"]["before"])).alias("start"), size(z["parts"]["said"]).alias("length"))),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return done.select(
        "conv_id",
        _joined(F.col("parts")).alias("formatted"),
        ends.alias("loss"),
        F.size(F.filter("marks", lambda m: m)).alias("escaped"),
        parse(_joined(F.col("parts"))).eqNullSafe(F.col("turns")).alias("identical"),
    )


def under_loss(formatted: Column, spans: Column) -> Column:
    """The text that the loss mask covers, unescaped, nothing between the spans."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + F.lit(1), s["length"]))), "")
