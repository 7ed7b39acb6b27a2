"""Conversations formatted by a template and checked by a finite-state machine over roles.

The template is data: what stands before and after each role's text, whether the text counts
for the loss, and which role may follow which state.  Texts may hold anything.  Inside them, every
marker of the template is broken by a backslash after its first character and every backslash is
doubled, so markers in the output are the template's own, and the text comes back exactly.

All work is column expressions; a conversation is one group, its turns are folded in order.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BAD = "bad"


@dataclass(frozen=True)
class Template:
    """``marks``: by role what stands before and after a text.  ``loss``: roles whose texts count.
    ``moves``: by state and role the next state; a missing entry is an error.  ``ends``: states
    in which a conversation may end.  Roles without marks get ``other``, their name inside."""

    marks: dict[str, tuple[str, str]]
    loss: frozenset[str]
    moves: dict[tuple[str, str], str]
    start: str
    ends: frozenset[str]
    other: tuple[str, str, str] = field(default=("<|", "|>", "<|end|>"))

    def __post_init__(self):
        if any(len(m) < 2 or "\\" in m for m in self.markers):
            raise ValueError("a marker has two characters or more, none of them a backslash")
        opens = [marks[0] for marks in self.marks.values()] + [self.other[1]]
        closes = [marks[1] for marks in self.marks.values()] + [self.other[2]]
        for m in self.markers:
            for k in range(1, len(m)):
                if any(o.endswith(m[:k]) for o in opens) or any(c.startswith(m[k:]) for c in closes):
                    raise ValueError(f"a text and the mark beside it could look like {m!r}")

    @property
    def markers(self) -> list[str]:
        every = {m for pair in self.marks.values() for m in pair} | set(self.other)
        return sorted(every, key=lambda m: (-len(m), m))


INSTRUCT = Template(
    marks={"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")},
    loss=frozenset({"assistant"}),
    moves={
        ("start", "system"): "instructed",
        ("start", "user"): "asked",
        ("instructed", "user"): "asked",
        ("asked", "assistant"): "answered",
        ("answered", "user"): "asked",
    },
    start="start",
    ends=frozenset({"answered"}),
)


def escape(text: Column, template: Template) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    # a place after the first and before the second character of a marker
    places = "|".join(f"(?<={re.escape(m[0])})(?={re.escape(m[1:])})" for m in template.markers)
    return F.regexp_replace(doubled, places, r"\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _mark(role: Column, template: Template, side: int) -> Column:
    pairs = [F.lit(x) for name, marks in template.marks.items() for x in (name, marks[side])]
    first, last, end = template.other
    other = F.concat(F.lit(first), escape(role, template), F.lit(last)) if side == 0 else F.lit(end)
    return F.coalesce(F.element_at(F.create_map(*pairs), role), other)


def format_conversations(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """``(conv_id, n_turns, valid, bad_turn, segments)`` for each conversation of ``turns(conv_id,
    turn, role, text)``.

    ``segments`` are ``(role, kind, text, loss)`` in order: a turn's opening mark, its escaped text
    and its closing mark; joined they are the formatted conversation.  ``valid`` says whether the
    machine takes all turns and ends well; ``bad_turn`` is the place of the first turn refused.
    Conversations that are not valid are formatted all the same.

    Rows go by turn, then role, then text, null turns first; repeated rows are repeated turns.  A
    null text is empty, a null role the empty role.  Rows without conv_id are one conversation of
    their own.  An empty table gives an empty table; other columns are ignored.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("row"),
    )
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    moves = F.create_map(
        *(F.lit(x) for (state, role), target in template.moves.items() for x in (f"{state}\n{role}", target))
    )

    def move(machine: Column, row: Column) -> Column:
        target = F.element_at(moves, F.concat_ws("\n", machine["state"], row["role"]))
        refused = target.isNull() & (machine["state"] != BAD)
        return F.struct(
            F.coalesce(F.when(machine["state"] != BAD, target), F.lit(BAD)).alias("state"),
            (machine["at"] + 1).alias("at"),
            F.when(refused, machine["at"]).otherwise(machine["bad_turn"]).alias("bad_turn"),
        )

    start = F.struct(
        F.lit(template.start).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad_turn")
    )

    def segments(row: Column) -> Column:
        def one(kind: str, text: Column, loss: Column) -> Column:
            return F.struct(row["role"].alias("role"), F.lit(kind).alias("kind"), text.alias("text"), loss.alias("loss"))

        return F.array(
            one("open", _mark(row["role"], template, 0), F.lit(False)),
            one("text", escape(row["text"], template), row["role"].isin(*sorted(template.loss))),
            one("close", _mark(row["role"], template, 1), F.lit(False)),
        )

    machine = F.aggregate("rows", start, move)
    return grouped.select(
        "conv_id",
        F.size("rows").cast("long").alias("n_turns"),
        machine.alias("machine"),
        F.flatten(F.transform("rows", segments)).alias("segments"),
    ).select(
        "conv_id",
        "n_turns",
        F.col("machine.state").isin(*sorted(template.ends)).alias("valid"),
        F.col("machine.bad_turn").alias("bad_turn"),
        "segments",
    )


def formatted_text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def write_formatted(conversations: DataFrame, path: str) -> None:
    """One row per conversation: the formatted string, and ``(start, length, loss)``, in characters,
    of its segments."""
    sized = F.transform("segments", lambda s: F.struct(F.length(s["text"]).alias("length"), s["loss"].alias("loss")))
    conversations.select(
        "conv_id", "valid", "bad_turn", formatted_text(F.col("segments")).alias("formatted"), sized.alias("spans")
    ).write.mode("overwrite").parquet(path)


def read_formatted(stored: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """``(conv_id, valid, formatted, turns, loss_texts)`` from what ``write_formatted`` has written.

    Turns are found by the template's markers in the string alone, which is how a reader without
    the spans would do it; ``loss_texts``, unescaped, by the spans.
    """
    first, last, end = template.other
    opens = {marks[0]: role for role, marks in template.marks.items()}
    closes = {marks[1] for marks in template.marks.values()} | {end}
    ends = "|".join(map(re.escape, sorted(closes)))
    # a turn: its opening mark, anything up to the first closing mark
    names = "|".join(map(re.escape, sorted(opens, key=len, reverse=True)))
    turn = rf"(?s)(?:{names}|{re.escape(first)}.*?{re.escape(last)}).*?(?:{ends})"
    head = rf"(?s)^({names}|{re.escape(first)}.*?{re.escape(last)})(.*?)(?:{ends})$"
    roles = F.create_map(*(F.lit(x) for mark, role in opens.items() for x in (mark, role)))

    def parsed(found: Column) -> Column:
        mark = F.regexp_extract(found, head, 1)
        own = F.substring(mark, F.lit(len(first) + 1), F.length(mark) - len(first) - len(last))
        return F.struct(
            F.coalesce(F.element_at(roles, mark), unescape(own)).alias("role"),
            unescape(F.regexp_extract(found, head, 2)).alias("text"),
        )

    def place(state: Column, span: Column) -> Column:
        piece = F.when(span["loss"], F.array(F.struct(state["at"].alias("start"), span["length"].alias("length"))))
        return F.struct(
            (state["at"] + span["length"]).alias("at"), F.concat(state["found"], F.coalesce(piece, NO_PIECES())).alias("found")
        )

    def NO_PIECES() -> Column:
        return F.array().cast("array<struct<start: int, length: int>>")

    losses = F.aggregate("spans", F.struct(F.lit(1).alias("at"), NO_PIECES().alias("found")), place, lambda s: s["found"])
    return stored.select(
        "conv_id",
        "valid",
        "formatted",
        F.transform(F.regexp_extract_all("formatted", F.lit(turn), 0), parsed).alias("turns"),
        F.transform(losses, lambda s: unescape(F.substring("formatted", s["start"], s["length"]))).alias("loss_texts"),
    )


def digests(read: DataFrame) -> DataFrame:
    """What each conversation holds, as counts and digests."""
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(listed, "UTF-8"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(F.encode(loss, "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
