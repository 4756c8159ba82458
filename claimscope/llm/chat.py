"""Chat formatting: conversations to text segments with loss flags.

A declarative template names the markers, the roles that are learnt from and
the turn order as a finite-state machine.  Control strings inside texts and
roles are escaped, so that the formatted text can be read back exactly.

Only DataFrame functions.  One shuffle groups a conversation's turns; a row
of the output is one conversation, which is what bounds its memory.

Defined cases: null text or role is empty; turns are ordered by ``turn``
(null first), ties by role, then text; a null ``conv_id`` is a conversation;
a conversation that breaks the turn order is formatted all the same, with
``valid`` false and ``bad_turn`` the number (from 0) of the first turn that
does, or the number of turns if it ends too early.  Other columns are unused.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """Every marker starts with ``control``; ``escape`` is one character."""

    control: str = "<|"
    role_open: str = "<|role|>"
    text_open: str = "<|text|>"
    turn_close: str = "<|end|>"
    escape: str = "\\"
    learnt: tuple[str, ...] = ("assistant",)
    start: str = "start"
    ends: tuple[str, ...] = ("assistant",)
    #: state -> {role: next state}
    turns: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "system", "user": "user"},
            "system": {"user": "user"},
            "user": {"assistant": "assistant"},
            "assistant": {"user": "user"},
        }
    )

    def escaped(self, text: Column) -> Column:
        e = self.escape
        return F.replace(F.replace(text, F.lit(e), F.lit(e + e)), F.lit(self.control), F.lit(self.control[0] + e + self.control[1:]))

    def unescaped(self, text: Column) -> Column:
        e = self.escape
        return F.replace(F.replace(text, F.lit(self.control[0] + e + self.control[1:]), F.lit(self.control)), F.lit(e + e), F.lit(e))


TEMPLATE = ChatTemplate()
_BROKEN = "<broken>"


def _states(template: ChatTemplate, roles: Column) -> Column:
    """(state, turns that were right): the machine's run over the roles."""
    steps = F.map_from_arrays(*(F.array(*(F.lit(x) for x in xs)) for xs in zip(*((f"{s}>{r}", t) for s, moves in template.turns.items() for r, t in moves.items()), strict=True)))

    def step(acc: Column, role: Column) -> Column:
        to = F.coalesce(F.element_at(steps, F.concat(acc["state"], F.lit(">"), role)), F.lit(_BROKEN))
        return F.struct(to.alias("state"), (acc["right"] + F.when(to == _BROKEN, 0).otherwise(1)).alias("right"))

    return F.aggregate(roles, F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("right")), step)


def format_chats(conversations: DataFrame, template: ChatTemplate = TEMPLATE) -> DataFrame:
    """(conv_id, turn, role, text) rows -> a row for each conversation:
    conv_id, n_turns, valid, bad_turn, segments array<struct<text, loss>>.
    The formatted text is the concatenation of the segments."""
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = conversations.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segments(t: Column) -> Column:
        return F.array(
            F.struct(F.concat(F.lit(template.role_open), template.escaped(t["role"]), F.lit(template.text_open)).alias("text"), F.lit(False).alias("loss")),
            F.struct(template.escaped(t["text"]).alias("text"), t["role"].isin(*template.learnt).alias("loss")),
            F.struct(F.lit(template.turn_close).alias("text"), F.lit(False).alias("loss")),
        )

    run = _states(template, F.transform("turns", lambda t: t["role"]))
    chats = chats.select("conv_id", F.size("turns").cast("long").alias("n_turns"), run.alias("run"), F.flatten(F.transform("turns", segments)).alias("segments"))
    valid = F.col("run.state").isin(*template.ends)
    return chats.select("conv_id", "n_turns", valid.alias("valid"), F.when(~valid, F.col("run.right")).alias("bad_turn"), "segments")


def formatted(segments: Column | str) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_turns(text: Column | str, template: ChatTemplate = TEMPLATE) -> Column:
    """Formatted text -> array<struct<role, text>>, unescaped."""

    def turn(piece: Column) -> Column:
        halves = F.split(piece, re.escape(template.text_open), 2)
        role = F.substring(halves[0], len(template.role_open) + 1, 2**31 - 1)
        return F.struct(template.unescaped(role).alias("role"), template.unescaped(halves[1]).alias("text"))

    pieces = F.split(text, re.escape(template.turn_close), -1)
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def chat_digest(conversations: DataFrame, template: ChatTemplate = TEMPLATE) -> DataFrame:
    """Digests of what is read back from the formatted conversations."""
    out = format_chats(conversations, template).withColumn("formatted", formatted("segments"))
    out = out.withColumn("back", read_turns("formatted", template))
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: template.unescaped(s["text"])), "")
    turns = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.withColumn("loss", loss).select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        F.col("bad_turn").cast("long").alias("bad_turn"),
    )


ORACLE = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))),
numbered AS (SELECT *, row_number() OVER w - 1 AS k, coalesce(lag(role) OVER w, 'start') AS before FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
judged AS (SELECT *, CASE WHEN (before || '>' || role) IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user') THEN 1 ELSE 0 END AS fine,
    length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + length('<|role|><|text|><|end|>') AS chars
  FROM numbered)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars,
  min(fine) = 1 AND arg_max(role, k) = 'assistant' AS valid,
  CASE WHEN NOT (min(fine) = 1 AND arg_max(role, k) = 'assistant') THEN coalesce(min(k) FILTER (WHERE fine = 0), count(*))::BIGINT END AS bad_turn
FROM judged GROUP BY conv_id
"""
