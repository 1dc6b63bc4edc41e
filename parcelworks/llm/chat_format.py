"""Conversations as one training text each, by column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, AGAIN = "<|im_start|>", "<|im_end|>\n", "<|im_again|>"
_END = r"<\|im_end\|>\n"
_AGAIN = r"<\|im_again\|>"


def escape(text: Column) -> Column:
    """Break every ``<|``: a backslash goes behind the ``<``, also where some stand there already."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    """A role stays on one line."""
    slashes = F.regexp_replace(escape(role), r"\\", r"\\\\")
    return F.regexp_replace(slashes, "\n", r"\\n")


def _unescape_role(role: Column) -> Column:
    lines = F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return unescape(F.regexp_replace(lines, r"\\\\", r"\\"))


def format_conversations(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learn: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``blocks``, ``formatted`` and ``loss_spans``.

    Turns go by number; turns of one role in a row share one block, with a mark between
    their texts. ``loss_spans`` has the places of the ``learn`` role's texts in ``formatted``
    (code points, end exclusive), each text by itself. Control strings inside texts are
    escaped, so ``read_back`` gives the turns again.

    Null roles and texts count as empty; turns of one number go by role, then text, and
    repeated rows stay; a null number comes first. Rows without an id form one conversation
    with a null id. Other columns are left out; an empty table gives no rows. A conversation
    becomes one cell, so its turns meet in one task.
    """
    own = lambda name: F.coalesce(F.col(f"`{name}`"), F.lit(""))
    packed = F.struct(F.col(f"`{turn}`").alias("turn"), own(role).alias("role"), own(text).alias("text"))
    rows = turns.groupBy(F.col(f"`{conv_id}`").alias("conv_id")).agg(F.sort_array(F.collect_list(packed)).alias("turns"))
    begins = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]),
    )
    rows = rows.withColumn("begins", begins)
    texts = lambda i, k: F.slice(
        "turns", i + 1, F.coalesce(F.get("begins", k + 1), F.size("turns")) - i
    )
    blocks = F.transform(
        "begins",
        lambda i, k: F.struct(
            F.get("turns", i)["role"].alias("role"), F.transform(texts(i, k), lambda t: t["text"]).alias("texts")
        ),
    )
    rows = rows.select("conv_id", blocks.alias("blocks"))
    head = lambda b: F.concat(F.lit(START), _escape_role(b["role"]), F.lit("\n"))
    body = lambda b: F.transform(b["texts"], escape)
    whole = F.array_join(
        F.transform("blocks", lambda b: F.concat(head(b), F.array_join(body(b), AGAIN), F.lit(END))), ""
    )
    # Lengths of what comes before each text and of the text, and whether it is to be learnt.
    pieces = F.flatten(
        F.transform(
            "blocks",
            lambda b: F.transform(
                body(b),
                lambda t, i: F.struct(
                    F.when(i == 0, F.length(head(b)) + len(END)).otherwise(F.lit(len(AGAIN))).alias("gap"),
                    F.length(t).alias("chars"),
                    (b["role"] == learn).alias("learn"),
                ),
            ),
        )
    )
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    # The first block has no end mark before it.
    start = F.struct(F.lit(-len(END)).alias("at"), none.alias("spans"))

    def step(state: Column, piece: Column) -> Column:
        begin = state["at"] + piece["gap"]
        end = begin + piece["chars"]
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        more = F.when(piece["learn"], F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), more.alias("spans"))

    spans = F.aggregate("pieces", start, step, lambda s: s["spans"])
    return rows.select("conv_id", "blocks", whole.alias("formatted"), pieces.alias("pieces")).select(
        "conv_id", "blocks", "formatted", spans.alias("loss_spans")
    )


def read_back(formatted: str = "formatted") -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    parts = F.split(F.col(formatted), _END, -1)
    found = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.substr(p, F.lit(len(START) + 1)))

    def turns(block: Column) -> Column:
        line = F.substring_index(block, "\n", 1)
        texts = F.split(F.substr(block, F.length(line) + 2), _AGAIN, -1)
        return F.transform(texts, lambda t: F.struct(_unescape_role(line).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(found, turns))


def text_under(spans: str = "loss_spans", formatted: str = "formatted") -> Column:
    """The texts at the given places, unescaped, one after the other."""
    cut = lambda s: unescape(F.substr(F.col(formatted), s["start"] + 1, s["end"] - s["start"]))
    return F.array_join(F.transform(spans, cut), "")
