"""Conversations as training text, by Spark expressions only.

The rows of a conversation are collected as (turn, role, text) structs and
sorted; neighbours of one role are merged into a block by array functions; the
blocks are concatenated under a template, which says where a block of each
role begins and what follows it.

*Escaping.*  A marker of the template inside a text gets a backslash after its
first character: ``[INST]`` becomes ``[\\INST]``, and what already looks so
gets one backslash more, ``[\\INST]`` becomes ``[\\\\INST]``.  No marker is left in an
escaped text, every text has its own escaped form, and texts without markers
stay as they are.  Markers begin with a character that occurs nowhere else in
any marker, so none can arise where a text meets its neighbours.

*Loss mask.*  The formatted text is given in segments, each with a flag: markers
and what the model reads have ``loss`` false, the assistant's texts true.

A conversation becomes one value, which is what a trainer reads; its memory
grows with its own turns only.  Rows without a conversation id do not meet in
one group: each is a conversation of its own.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import let, narrowed


@dataclass(frozen=True)
class Template:
    """Markers of a chat template.

    ``opening`` and ``closing`` are written before and after a block of a role;
    a role without an opening of its own gets ``named``, its name and
    ``end_name``.  ``also`` stands between merged texts of one role, ``begin``
    before the first block.  ``learned`` is the role whose texts bear the loss.
    """

    begin: str = "<s>"
    opening: dict[str, str] = field(default_factory=lambda: {
        "system": "[SYS]", "user": "[INST]", "assistant": "[/INST]"})
    closing: dict[str, str] = field(default_factory=lambda: {"assistant": "</s>"})
    named: str = "[ROLE]"
    end_name: str = "[/ROLE]"
    also: str = "[+]"
    learned: str = "assistant"

    def __post_init__(self) -> None:
        markers = self.markers()
        first = {m[0] for m in markers}
        if len(set(markers)) < len(markers) or "\\" in "".join(markers) \
                or any(len(m) < 2 or first & set(m[1:]) for m in markers):
            raise ValueError("markers must differ, have two characters or more, no backslash, and "
                             "begin with characters that occur nowhere else in them")

    def markers(self) -> list[str]:
        return [self.begin, *self.opening.values(), *self.closing.values(), self.named,
                self.end_name, self.also]


INST = Template()


def _any_of(values: list[str]) -> str:
    """A pattern for any of the values, longest first."""
    return "|".join(re.escape(v) for v in sorted(values, key=len, reverse=True))


def _replaced(text: Column, template: Template, pattern: str, by: str) -> Column:
    """``pattern`` replaced for every first character of a marker and the rests that follow it.

    Most texts hold no such character; the search for it is all they cost.
    """
    rests: dict[str, list[str]] = {}
    for marker in template.markers():
        rests.setdefault(marker[0], []).append(marker[1:])
    for head, tails in sorted(rests.items()):
        found = pattern.format(head=re.escape(head), tails=_any_of(tails))
        text = let(text, lambda t: F.when(F.contains(t, F.lit(head)), F.regexp_replace(t, found, by))
                   .otherwise(t))
    return text


def escaped(text: Column, template: Template = INST) -> Column:
    """``text`` with a backslash more in everything that looks like a marker."""
    return _replaced(text, template, r"({head}\\*)({tails})", r"$1\\$2")


def unescaped(text: Column, template: Template = INST) -> Column:
    """The inverse of ``escaped``."""
    return _replaced(text, template, r"({head}\\*)\\({tails})", "$1$2")


def _by_role(role: Column, values: dict[str, str], other: Column) -> Column:
    out = other
    for name, value in values.items():
        out = F.when(role == name, F.lit(value)).otherwise(out)
    return out


def turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
          role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns array<struct<turn, role, text>>), one row per conversation, sorted.

    NULL role and NULL text are empty.  Order: turn (NULL first), then role and
    text, so that ties give one result; repeated rows stay.  Rows without
    conv_id are conversations of one turn each.
    """
    rows = narrowed(conversations, conv_id=conv_id, turn=turn, role=role, text=text).select(
        "conv_id", F.struct("turn", F.coalesce(F.col("role"), F.lit("")).alias("role"),
                            F.coalesce(F.col("text"), F.lit("")).alias("text")).alias("own"))
    known = (rows.where("conv_id is not null").groupBy("conv_id")
             .agg(F.sort_array(F.collect_list("own")).alias("turns")))
    return known.union(rows.where("conv_id is null").select("conv_id", F.array("own")))


def blocks(turns: Column) -> Column:
    """Sorted turns -> array<struct<role, texts>>: neighbours of one role merged."""
    def of(turns: Column) -> Column:
        n = F.size(turns)
        places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(places, lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]))
        return let(starts, lambda starts: F.transform(starts, lambda at, k: F.struct(
            F.get(turns, at)["role"].alias("role"),
            F.transform(F.slice(turns, at + 1, F.coalesce(F.get(starts, k + 1), n) - at),
                        lambda t: t["text"]).alias("texts"))))

    return let(turns, of)


def _segments(block: Column, template: Template) -> Column:
    """One block as segments: opening, escaped texts with separators, closing."""
    role = block["role"]
    name = F.concat(F.lit(template.named), escaped(role, template), F.lit(template.end_name))
    learned = role == template.learned

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    no = F.lit(False)
    texts = F.flatten(F.transform(block["texts"], lambda t, k: F.array(
        segment(F.when(k == 0, _by_role(role, template.opening, name))
                .otherwise(F.lit(template.also)), no),
        segment(escaped(t, template), learned))))
    return F.concat(texts, F.array(segment(_by_role(role, template.closing, F.lit("")), no)))


def formatted(conversations: DataFrame, template: Template = INST, conv_id: str = "conv_id",
              turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, formatted, segments array<struct<text, loss>>), one row per conversation.

    ``formatted`` is the segments' texts end to end.  One shuffle, by
    conversation; rows and edge cases as in ``turns``.  An empty table gives an
    empty table; extra columns are left out.
    """
    merged = turns(conversations, conv_id, turn, role, text).select(
        "conv_id", blocks(F.col("turns")).alias("blocks"))
    begin = F.array(F.struct(F.lit(template.begin).alias("text"), F.lit(False).alias("loss")))
    cut = merged.select("conv_id", F.concat(begin, F.flatten(F.transform(
        "blocks", lambda b: _segments(b, template)))).alias("segments"))
    return cut.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "")
                      .alias("formatted"), "segments")


def read_back(formatted: Column, template: Template = INST) -> Column:
    """The turns of a formatted text: array<struct<role, text>>, in order."""
    body = F.substring(formatted, len(template.begin) + 1, 2**31 - 1)
    for marker in (*template.opening.values(), template.named):
        # no text holds the first marker: it can part the blocks
        body = F.replace(body, F.lit(marker), F.lit(template.begin + marker))
    parts = F.filter(F.split(body, re.escape(template.begin), -1), lambda p: p != "")

    def turns_of(part: Column) -> Column:
        name, rest = F.lit(""), part
        for role, marker in template.opening.items():
            own = part.startswith(marker)
            name = F.when(own, F.lit(role)).otherwise(name)
            rest = F.when(own, F.substring(part, len(marker) + 1, 2**31 - 1)).otherwise(rest)
        other = part.startswith(template.named)
        stop = F.instr(part, template.end_name)
        name = F.when(other, unescaped(F.substring(
            part, F.lit(len(template.named) + 1), stop - len(template.named) - 1), template)).otherwise(name)
        rest = F.when(other, F.substring(part, stop + len(template.end_name), F.lit(2**31 - 1))).otherwise(rest)
        closing = _by_role(name, {r: m for r, m in template.closing.items()}, F.lit(""))
        texts = F.split(F.substring(rest, F.lit(1), F.length(rest) - F.length(closing)),
                        re.escape(template.also), -1)
        return let(name, lambda name: F.transform(texts, lambda t: F.struct(
            name.alias("role"), unescaped(t, template).alias("text"))))

    return F.flatten(F.transform(parts, turns_of))


def digests(done: DataFrame, template: Template = INST) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of ``formatted``'s rows.

    The turns are read back from the formatted text, the learned text from the
    segments under the mask; both are unescaped.
    """
    back = done.select("conv_id", "formatted", read_back(F.col("formatted"), template).alias("turns"),
                       F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]),
                                                lambda s: unescaped(s["text"], template)), "").alias("learned"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"],
                                                                F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"),
                       F.sha2(said, 256).alias("turns_sha256"),
                       F.length("learned").cast("bigint").alias("loss_chars"),
                       F.sha2("learned", 256).alias("loss_sha256"),
                       F.length("formatted").cast("bigint").alias("formatted_chars"))
