"""Chat formatting with a grammar round trip, in DataFrame operations only.

A turn is an opening mark, a body and a closing mark; the parser takes, from left to right, each opening mark
and what follows up to the first closing mark. Every turn is rendered as it is, reparsed and compared with its
source; a turn that does not come back identical is rendered with its control characters escaped. No mark
contains another, so turns that come back alone come back in a row; the whole conversation is reparsed all
the same, and a difference is an error.

The escape writes ``\\`` as ``\\0``, ``[`` as ``\\1`` and ``<`` as ``\\2``; every mark holds one of ``[`` and ``<``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Opening and closing mark of each role. Fixed values.
MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("<<SYS>> ", " <</SYS>>"), "assistant": ("<s> ", " </s>")}
#: A role without marks of its own is written, escaped, between ROLE marks; a missing role has the NONE mark.
ROLE_OPEN, ROLE_CLOSE, NO_ROLE, OTHER_CLOSE = "[ROLE] ", " [/ROLE] ", "[NONE] ", " [/TURN]"
_ESCAPES = (("\\", "\\0"), ("[", "\\1"), ("<", "\\2"))


def _pattern() -> str:
    opens = [*(m[0] for m in MARKS.values()), ROLE_OPEN, NO_ROLE]
    closes = [*(m[1] for m in MARKS.values()), OTHER_CLOSE]
    either = lambda marks: "|".join("\\Q" + m + "\\E" for m in marks)
    return f"(?s)(?:{either(opens)}).*?(?:{either(closes)})"


PATTERN = _pattern()


def escape(text: Column) -> Column:
    for plain, code in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(_ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _opening(role: Column) -> Column:
    known = F.when(role.isNull(), F.lit(NO_ROLE))
    for name, (opened, _) in MARKS.items():
        known = known.when(role == name, F.lit(opened))
    return known.otherwise(F.concat(F.lit(ROLE_OPEN), escape(role), F.lit(ROLE_CLOSE)))


def _closing(role: Column) -> Column:
    known = F.when(role.isNull(), F.lit(OTHER_CLOSE))
    for name, (_, closed) in MARKS.items():
        known = known.when(role == name, F.lit(closed))
    return known.otherwise(F.lit(OTHER_CLOSE))


def _turn(piece: Column) -> Column:
    """One parsed turn: role, text, and how many characters stand before and after its body."""
    role = F.when(piece.startswith(NO_ROLE), F.lit(None).cast("string"))
    close = F.when(piece.startswith(NO_ROLE) | piece.startswith(ROLE_OPEN), F.lit(len(OTHER_CLOSE)))
    opened = F.when(piece.startswith(NO_ROLE), F.lit(len(NO_ROLE)))
    for name, (start, end) in MARKS.items():
        role = role.when(piece.startswith(start), F.lit(name))
        opened = opened.when(piece.startswith(start), F.lit(len(start)))
        close = close.when(piece.startswith(start), F.lit(len(end)))
    named = F.substring_index(F.substr(piece, F.lit(len(ROLE_OPEN) + 1)), ROLE_CLOSE, 1)
    role = role.otherwise(unescape(named))
    opened = opened.otherwise(F.length(named) + len(ROLE_OPEN) + len(ROLE_CLOSE))
    body = F.substr(piece, opened + 1, F.greatest(F.lit(0), F.length(piece) - opened - close))
    return F.struct(
        role.alias("role"), unescape(body).alias("text"), opened.alias("before"), close.alias("after"),
        F.length(piece).alias("chars"),
    )


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text, before, after, chars)."""
    return F.transform(F.regexp_extract_all(formatted, F.lit(PATTERN), F.lit(0)), _turn)


def _sources(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def format_conversations(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, formatted and loss_spans, one row for each conversation.

    ``loss_spans`` are the bodies of assistant turns in ``formatted``: start and end in code points, end exclusive.
    All work on a turn is done before turns meet; then a conversation is one value, as its formatted text is one, and
    may be as long as a value of Spark can be.

    Rows are ordered by turn, null first; equal turns by role, then text. A null text is empty, a null role is
    kept as a turn without role, rows with a null conv_id form one conversation. Repeated rows are turns of their
    own. An empty table gives an empty result; other columns are not read.
    """
    rows = conversations.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.col(f"`{role}`").cast("string").alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    opening, closing = _opening(F.col("role")), _closing(F.col("role"))
    plain = F.concat(opening, "text", closing)
    source = F.array(F.struct("role", "text"))
    same = _sources(F.col("parsed")).eqNullSafe(source) & (F.element_at("parsed", 1)["chars"] == F.length("plain"))
    tried = rows.withColumn("plain", plain).withColumn("parsed", parse_turns(F.col("plain")))
    body = F.when(F.size("parsed") == 1, F.when(same, F.col("text"))).otherwise(F.lit(None))
    rendered = tried.withColumn("body", F.coalesce(body, escape(F.col("text")))).select(
        "conv_id",
        F.struct("turn", "role", "text", F.concat(opening, "body", closing).alias("piece")).alias("row"),
    )
    gathered = rendered.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    whole = gathered.select(
        "conv_id",
        F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("source"),
        F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"),
    ).withColumn("turns", parse_turns(F.col("formatted")))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))
    walked = F.aggregate(
        "turns",
        start,
        lambda state, t: F.struct(
            (state["at"] + t["chars"]).alias("at"),
            F.when(
                t["role"] == "assistant",
                F.concat(
                    state["spans"],
                    F.array(
                        F.struct(
                            (state["at"] + t["before"]).alias("start"),
                            (state["at"] + t["chars"] - t["after"]).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(state["spans"])
            .alias("spans"),
        ),
    )
    checked = F.when(
        _sources(F.col("turns")).eqNullSafe(F.col("source")) & (F.col("walked.at") == F.length("formatted")),
        F.col("formatted"),
    ).otherwise(F.raise_error(F.lit("a formatted conversation does not parse back to its source")))
    return whole.withColumn("walked", walked).select(
        "conv_id", checked.alias("formatted"), F.col("walked.spans").alias("loss_spans")
    )


def read_turns(formatted: str = "formatted") -> Column:
    return _sources(parse_turns(F.col(formatted)))


def loss_text(formatted: str = "formatted", spans: str = "loss_spans") -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescape(F.substr(F.col(formatted), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))),
        ),
        "",
    )
