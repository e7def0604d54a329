"""Preference formatting of chat pairs in native expressions.

A row holds a chosen and a rejected conversation, each an array of turns
(role, text).  Their longest common prefix of turns is rendered once as the
prompt; what is left of each is its completion, with a mask that trains on the
replies and hides the turns' headings and what others say.  All of it is
DataFrame expressions over the row's arrays: nothing is shuffled.

A turn is rendered as heading, text and end mark.  Defined results: a null
conversation is an empty one; a null role or text is empty, so turns that
differ in that only are equal; repeated rows give repeated results; a pair is
``usable`` if both completions have something to train on and they differ;
added columns replace columns of the same name, all others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomewise.llm.batches import clashes, quoted

REPLY_ROLE = "assistant"
HEAD, END = "<|{role}|>\n", "<|end|>\n"
_TURNS = "array<struct<role:string,text:string>>"


def _plain(turns: Column) -> Column:
    return F.transform(F.coalesce(turns.cast(_TURNS), F.array().cast(_TURNS)), lambda t: F.struct(
        F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))


def common_turns(a: Column, b: Column) -> Column:
    """Number of leading turns that two arrays of turns share."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    differs = F.array_position(same, False).cast("int")
    return F.least(F.when(differs == 0, F.size(same)).otherwise(differs - 1), F.size(a), F.size(b))


def _head(role: Column, head: str) -> Column:
    before, _, after = head.partition("{role}")
    return F.concat(F.lit(before), role, F.lit(after)) if "{role}" in head else F.lit(head)


def render(turns: Column, head: str = HEAD, end: str = END) -> Column:
    """Turns as one text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t["role"], head), t["text"], F.lit(end))), "")


def segments(turns: Column, reply_role: str = REPLY_ROLE, head: str = HEAD, end: str = END) -> Column:
    """The mask of a rendered text: consecutive ``chars`` and whether to
    ``train`` on them, two segments per turn."""
    return F.flatten(F.transform(turns, lambda t: F.array(
        F.struct(F.char_length(_head(t["role"], head)).alias("chars"), F.lit(False).alias("train")),
        F.struct((F.char_length(t["text"]) + len(end)).alias("chars"), (t["role"] == reply_role).alias("train")))))


def trained_chars(mask: Column) -> Column:
    return F.aggregate(mask, F.lit(0).cast("long"),
                       lambda n, s: n + F.when(s["train"], s["chars"]).otherwise(0))


_ADDED = ["n_prompt_turns", "prompt", "chosen_completion", "chosen_mask", "rejected_completion", "rejected_mask",
          "usable"]


def format_preferences(pairs: DataFrame, chosen_col: str = "chosen", rejected_col: str = "rejected",
                       reply_role: str = REPLY_ROLE, head: str = HEAD, end: str = END) -> DataFrame:
    """``pairs`` with ``n_prompt_turns, prompt``, a completion text and a mask
    (see ``segments``) for each side, and ``usable``."""
    keep = [F.col(quoted(c)) for c in clashes(pairs, _ADDED)]
    own = F.struct(_plain(F.col(quoted(chosen_col))).alias("c"), _plain(F.col(quoted(rejected_col))).alias("r"))

    def formed(p: Column) -> Column:
        n = common_turns(p["c"], p["r"])
        return F.struct(n.alias("n"), F.slice(p["c"], F.lit(1), n).alias("p"),
                        F.slice(p["c"], n + 1, F.size(p["c"])).alias("c"),
                        F.slice(p["r"], n + 1, F.size(p["r"])).alias("r"))

    def shown(x: Column) -> Column:
        cm, rm = segments(x["c"], reply_role, head, end), segments(x["r"], reply_role, head, end)
        return F.struct(x["n"].alias("n_prompt_turns"), render(x["p"], head, end).alias("prompt"),
                        render(x["c"], head, end).alias("chosen_completion"), cm.alias("chosen_mask"),
                        render(x["r"], head, end).alias("rejected_completion"), rm.alias("rejected_mask"),
                        ((trained_chars(cm) > 0) & (trained_chars(rm) > 0)).alias("usable"))

    # one-element transforms bind each step once, so no array is built again per use
    steps = F.transform(F.transform(F.array(own), formed), shown)
    made = pairs.select(*keep, F.explode(steps).alias("_made"))
    return made.select(*keep, *[F.col("_made")[c].alias(c) for c in _ADDED])


def conversations_as_turns(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                           text_col: str = "text") -> DataFrame:
    """One row per conversation, ``id_col, turns``, in the order of turn, role
    and text; repeated rows count once.  A row without an id belongs to no
    conversation that is known: it is one of its own, of a single turn, so
    however many there are, nothing gathers them."""
    row = F.struct(F.col(quoted(turn_col)).alias("turn"),
                   F.coalesce(F.col(quoted(role_col)), F.lit("")).alias("role"),
                   F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text"))
    conversation = F.col(quoted(id_col))
    return (df.groupBy(conversation.alias(id_col), F.when(conversation.isNull(), row).alias("_own"))
              .agg(F.sort_array(F.collect_set(row)).alias("_rows"))
              .select(quoted(id_col), F.transform("_rows", lambda t: F.struct(
                  t["role"].alias("role"), t["text"].alias("text"))).alias("turns")))


def mirrored_replies(turns: Column, reply_role: str = REPLY_ROLE) -> Column:
    """A worse conversation from a real one: its replies in reverse order; a
    reply that stays in place (the middle or only one) echoes the turn before."""
    places = F.filter(F.transform(turns, lambda t, i: F.when(t["role"] == reply_role, i)), lambda i: i.isNotNull())
    return F.transform(F.array(F.struct(turns.alias("t"), places.alias("at"))), lambda b: F.transform(
        b["t"], lambda t, i: F.when(t["role"] != reply_role, t).otherwise(F.struct(
            t["role"].alias("role"), _mirrored(b["t"], b["at"], i, F.array_position(b["at"], i).cast("int")).alias("text")))))[0]


def _mirrored(turns: Column, at: Column, i: Column, k: Column) -> Column:
    other = F.get(at, F.size(at) - k)
    return F.when(other != i, F.get(turns, other)["text"]).otherwise(
        F.coalesce(F.get(turns, i - 1)["text"], F.lit("")))
