"""Chat formatting with DataFrame functions only.

A finite-state machine over roles checks the order of turns, and a declarative template turns each conversation
into text segments with a loss flag each. Control strings inside roles and texts are broken up reversibly: a
backslash is doubled, and one backslash goes behind the first character of every control string. No control string
holds a backslash, so none is left inside escaped text, and the markers of the output are exactly those of the
template.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """Markers around a turn, which roles carry loss, and which role may follow which state.

    ``guarded`` are further control strings that must not appear inside texts. ``moves`` holds
    (state, role, next state); a conversation starts in ``start`` and should end in one of ``final``.
    """

    turn_open: str = "<|im_start|>"
    role_close: str = "<|im_sep|>"
    turn_close: str = "<|im_end|>"
    guarded: tuple[str, ...] = ("<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: tuple[tuple[str, str, str], ...] = (
        ("start", "system", "ready"), ("start", "user", "asked"), ("ready", "user", "asked"),
        ("asked", "assistant", "answered"), ("answered", "user", "asked"),
    )
    final: tuple[str, ...] = ("answered",)

    def controls(self) -> tuple[str, ...]:
        held = (self.turn_open, self.role_close, self.turn_close, *self.guarded)
        if any(len(c) < 2 or "\\" in c for c in held):
            raise ValueError("a control string needs two characters at least and no backslash")
        return held


def escape(text: Column, template: ChatTemplate) -> Column:
    heads = "|".join(f"\\Q{c[0]}\\E(?=\\Q{c[1:]}\\E)" for c in template.controls())
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), heads, "$0\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_conversations(rows: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """One row per conversation: conv_id, formatted, segments (start, length, loss; in code points),
    n_turns, valid, first_bad (index of the first turn out of order, or null).

    Rows of a conversation are ordered by turn, then role, then text, so repeated turns have a fixed order; a null turn
    comes first. Null text and null role count as empty. An order that the machine does not accept is still
    formatted, with ``valid`` false. Rows without conv_id form one conversation. An empty table gives no rows.
    A conversation is one row of the result, so its turns meet in one task as they must.
    """
    turns = rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    loss = F.col("role").isin(*template.loss_roles)
    header = F.concat(F.lit(template.turn_open), escape(F.col("role"), template), F.lit(template.role_close))
    cut = turns.select(
        "conv_id", "turn", "role", "text", header.alias("header"), escape(F.col("text"), template).alias("body"),
        loss.alias("loss"),
    )
    size = F.length("header") + F.length("body") + len(template.turn_close)
    earlier = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("at", F.coalesce(F.sum(size.cast("long")).over(earlier), F.lit(0)))
    gathered = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("turn", "role", "text", "at", "header", "body", "loss")
    )).alias("turns"))
    texts = F.transform("turns", lambda t: F.concat(t.header, t.body, F.lit(template.turn_close)))
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        _segment(t["at"], F.length(t.header), F.lit(False)),
        _segment(t["at"] + F.length(t.header), F.length(t.body), t.loss),
        _segment(t["at"] + F.length(t.header) + F.length(t.body), F.lit(len(template.turn_close)), F.lit(False)),
    )))
    order = _run_machine(F.col("turns"), template)
    return gathered.select(
        "conv_id", F.concat_ws("", texts).alias("formatted"), segments.alias("segments"), F.size("turns").cast("long").alias("n_turns"), order.alias("order"),
    ).select(
        "conv_id", "formatted", "segments", "n_turns",
        (F.isnull("order.bad") & F.col("order.state").isin(*template.final)).alias("valid"),
        F.col("order.bad").alias("first_bad"),
    )


def _segment(start: Column, length: Column, loss: Column) -> Column:
    return F.struct(start.cast("long").alias("start"), length.cast("long").alias("length"), loss.alias("loss"))


def _run_machine(turns: Column, template: ChatTemplate) -> Column:
    """Fold the roles through the transition table: last state, and index of the first refused turn."""
    table = F.create_map(*[F.lit(x) for s, role, to in template.moves for x in (f"{s}\n{role}", to)])
    return F.aggregate(
        turns,
        F.struct(F.lit(template.start).alias("state"), F.lit(0).cast("long").alias("i"),
                 F.lit(None).cast("long").alias("bad")),
        lambda s, t: F.struct(
            F.coalesce(F.try_element_at(table, F.concat(s.state, F.lit("\n"), t.role)), s.state).alias("state"),
            (s.i + 1).cast("long").alias("i"),
            F.coalesce(
                s.bad,
                F.when(F.isnull(F.try_element_at(table, F.concat(s.state, F.lit("\n"), t.role))), s.i),
            ).cast("long").alias("bad"),
        ),
    )


def read_back(formatted: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """conv_id, turns (role, text) and loss_text, parsed from ``formatted`` and ``segments`` alone."""
    quoted = lambda marker: f"\\Q{marker}\\E"
    pieces = F.split("formatted", quoted(template.turn_close))
    turns = F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.split(p, quoted(template.role_close)),
    )
    open_chars = len(template.turn_open)
    parsed = F.transform(turns, lambda t: F.struct(
        unescape(F.substr(t[0], F.lit(open_chars + 1))).alias("role"), unescape(t[1]).alias("text")
    ))
    under_loss = F.transform(
        F.filter("segments", lambda s: s.loss),
        lambda s: unescape(F.substr("formatted", (s.start + 1).cast("int"), s.length.cast("int"))),
    )
    return formatted.select(
        "conv_id", "formatted", parsed.alias("turns"), F.concat_ws("", under_loss).alias("loss_text")
    )
