r"""Chat formatting: a finite-state machine over roles and a declarative template.

A template gives the text before and after each role's turn, the roles that carry
loss, and the machine's transitions ``state -> {role: next state}``.  Every turn
becomes segments (text, loss); the formatted conversation is their concatenation.

Inside texts and role names every backslash is doubled, and wherever a control string
starts a backslash goes behind its first character.  So no control string is left in
a body, the output can be cut at the template's own marks, and dropping each backslash
that takes the next character with it gives the text back.

Defined cases: turns go by (turn, role, text), null turns last; null text is empty,
null role is the role ``""`` (read back as empty); rows that repeat are turns of
their own; a conversation whose role order the machine refuses is formatted all the
same, with ``valid`` false and ``error_turn`` its first bad position; a null conv_id
is one conversation of its own; a conversation, however long its texts, becomes one row in one
task; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Template:
    """``### role: `` before a turn, `` </turn>`` and a line end after it."""

    open: str = "### "
    sep: str = ": "
    close: str = " </turn>\n"
    #: Strings that must not be taken for the template's own inside a text.
    controls: tuple[str, ...] = ("###", "</turn>")
    loss_roles: tuple[str, ...] = ("assistant",)
    title: Mapping[str, str] = field(default_factory=lambda: {"system": "System", "user": "User",
                                                              "assistant": "Assistant"})
    start: str = "start"
    #: state -> {role: next state}; a role that is not listed is an error.
    machine: Mapping[str, Mapping[str, str]] = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"}})


def escape(text: Column, controls: tuple[str, ...]) -> Column:
    r"""Double every backslash, then break every start of a control string, overlapping ones too."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in controls:
        out = F.regexp_replace(out, rf"\Q{c[0]}\E(?=\Q{c[1:]}\E)", c[0] + r"\\")
    return out


def unescape(text: Column) -> Column:
    r"""The inverse of ``escape``: a backslash before anything gives that thing."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fsm(roles: Column, t: Template) -> Column:
    """(state, bad): the state after all ``roles``, and the first position refused (null: none)."""
    step = F.create_map(*[F.lit(x) for s, to in t.machine.items() for r, n in to.items() for x in (f"{s}>{r}", n)])
    zero = F.struct(F.lit(t.start).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad"))

    def move(acc, role):
        to = F.element_at(step, F.concat(acc["state"], F.lit(">"), role))
        return F.struct(F.coalesce(to, acc["state"]).alias("state"), (acc["at"] + 1).alias("at"),
                        F.coalesce(acc["bad"], F.when(to.isNull(), acc["at"])).alias("bad"))
    return F.aggregate(roles, zero, move)


def _head(role: Column, t: Template) -> Column:
    r"""The name of a listed role; of any other ``\@`` and the escaped role, which no listed name starts with."""
    named = F.create_map(*[F.lit(x) for kv in t.title.items() for x in kv])
    return F.coalesce(F.element_at(named, role), F.concat(F.lit(r"\@"), escape(role, (*t.controls, t.sep))))


def turn_segments(turns: Column, t: Template) -> Column:
    """Segments (text, loss) of an array of (role, text) turns: head, body, tail of each."""
    def one(x):
        head = F.concat(F.lit(t.open), _head(x["role"], t), F.lit(t.sep))
        return F.array(F.struct(head.alias("text"), F.lit(False).alias("loss")),
                       F.struct(escape(x["text"], t.controls).alias("text"), x["role"].isin(*t.loss_roles).alias("loss")),
                       F.struct(F.lit(t.close).alias("text"), F.lit(False).alias("loss")))
    return F.flatten(F.transform(turns, one))


def format_chats(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, valid, error_turn, segments, formatted), one row per conversation.

    The grouping needs a conversation in one row, as its output is one string; only
    (turn, role, text) of it are moved.
    """
    t = template
    rows = conversations.select(
        "conv_id", F.struct(F.col("turn").isNull().alias("late"), F.col("turn").alias("turn"),
                            F.coalesce("role", F.lit("")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text")).alias("x"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("turns"))
    bad = fsm(F.transform("turns", lambda x: x["role"]), t)["bad"]
    chats = chats.select("conv_id", bad.alias("error_turn"), turn_segments(F.col("turns"), t).alias("segments"))
    return chats.select("conv_id", F.col("error_turn").isNull().alias("valid"), "error_turn", "segments",
                        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def read_back(formatted: Column, t: Template = Template()) -> Column:
    """The (role, text) turns of a formatted conversation, from the string alone."""
    roles = F.create_map(*[F.lit(x) for k, v in t.title.items() for x in (v, k)])
    pieces = F.split(formatted, rf"\Q{t.close}\E", -1)

    def turn(piece):
        at = F.locate(t.sep, piece)
        head = F.substr(piece, F.lit(len(t.open) + 1), at - len(t.open) - 1)
        other = unescape(F.substr(head, F.lit(3)))
        return F.struct(F.when(F.startswith(head, F.lit(r"\@")), other).otherwise(F.element_at(roles, head)).alias("role"),
                        unescape(F.substr(piece, at + len(t.sep))).alias("text"))
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
