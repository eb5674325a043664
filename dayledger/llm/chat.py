"""Conversations as training text: a state machine checks the order of roles, a template writes the
segments and says which of them count in the loss. DataFrame functions only.

The template is data: what opens each role's turns, what ends a turn, the moves allowed between
states. Every opening and the end is a control string; inside a text a backslash behind its first
character breaks it, and backslashes of the text are doubled, so what is written can be read back.

A block of BLOCK turns is a function from the state before it to the state after it. Blocks are
folded first, then the blocks of a conversation, so a very long conversation is put together from
few rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"
BLOCK = 256  # turn numbers of a block


@dataclass(frozen=True)
class Template:
    """`openings`: role -> control string before its texts. Any other role is written between the two
    strings of `other`. `moves`: (state, role) -> state; a turn without one is out of order."""

    openings: dict[str, str]
    moves: dict[tuple[str, str], str]
    other: tuple[str, str] = ("### Role ", ": ")
    end: str = "</turn>\n"
    loss: frozenset[str] = field(default_factory=lambda: frozenset({"assistant"}))
    start: str = "start"
    finals: frozenset[str] = field(default_factory=lambda: frozenset({"answered"}))

    def __post_init__(self):
        for control in self.controls:
            # a string that begins as it ends could come out of its own breaking
            borders = any(control[:k] == control[-k:] for k in range(1, len(control)))
            if len(control) < 2 or ESCAPE in control or borders:
                raise ValueError(f"{control!r} cannot be a control string")
        first = [self.other[0], *self.openings.values()]
        if any(a != b and b.startswith(a) for a in first for b in first) or len(set(first)) < len(first):
            raise ValueError("one opening begins with another")
        if not set(self.loss) | {r for _, r in self.moves} <= set(self.openings):
            raise ValueError("loss and moves name roles without an opening")

    @property
    def controls(self) -> list[str]:
        return [self.end.strip("\n"), self.other[0], *self.openings.values()]

    @property
    def states(self) -> list[str]:
        return sorted({self.start, *self.finals, *self.moves.values(), *(s for s, _ in self.moves)})


TURNS = Template(
    openings={"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "},
    moves={
        ("start", "system"): "told", ("start", "user"): "asked", ("told", "user"): "asked",
        ("asked", "assistant"): "answered", ("answered", "user"): "asked",
    },
)


def escaped(text: Column, controls: list[str]) -> Column:
    text = F.replace(text, F.lit(ESCAPE), F.lit(2 * ESCAPE))
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(c[0] + ESCAPE + c[1:])), controls, text)


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _folded(items: Column, start: Column, step) -> Column:
    """The state, and how many turns were in order, after all items."""
    zero = F.struct(start.cast("int").alias("state"), F.lit(0).cast("long").alias("good"))

    def merge(acc: Column, item: Column) -> Column:
        state, good = step(acc["state"], item)
        return F.struct(state.cast("int").alias("state"), (acc["good"] + good).cast("long").alias("good"))

    return F.aggregate(items, zero, merge)


def formatted(conversations: DataFrame, template: Template = TURNS) -> DataFrame:
    """One row per conv_id of `conversations` (conv_id, turn, role, text; other columns are not read).

    n_turns; n_in_order, the turns before the first one out of order; in_order, whether that is all;
    complete, whether they also end in a final state; segments (text, loss) in the order of turns,
    which joined are the formatted text. Turns go by number, null first, equal numbers by role and
    text; every row is a turn, repeated ones too. Null roles and texts are empty. Rows without a
    conv_id are one conversation. No rows give no rows.
    """
    states, roles = template.states, list(template.openings)
    stuck, width = len(states), len(roles) + 1  # a state that no turn leaves, and any other role
    after = [states.index(template.moves[s, r]) if (s, r) in template.moves else stuck for s in states for r in [*roles, None]]
    after = F.array(*[F.lit(s) for s in after + [stuck] * width])
    def code(role: Column) -> Column:
        return reduce(lambda c, k: F.when(role == roles[k], k).otherwise(c), range(len(roles)), F.lit(len(roles)))

    def opening(role: Column) -> Column:
        named = escaped(role, [*template.controls, template.other[1]])
        first = F.concat(F.lit(template.other[0]), named, F.lit(template.other[1]))
        return reduce(lambda c, r: F.when(role == r, template.openings[r]).otherwise(c), roles, first)

    turn = F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    blocks = (
        conversations.select(F.col("conv_id").cast("long"), F.floor(F.col("turn").cast("long") / BLOCK).alias("block"), turn.alias("turn"))
        .groupBy("conv_id", "block").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    )

    def move(state: Column, turn: Column) -> tuple[Column, Column]:
        new = F.get(after, state * width + code(turn["role"]))
        return new, (new != stuck).cast("long")

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    no = F.lit(False)
    blocks = blocks.select(
        "conv_id",
        F.struct(
            "block", F.size("turns").cast("long").alias("n"),
            F.transform(F.sequence(F.lit(0), F.lit(stuck)), lambda s: _folded(F.col("turns"), s, move)).alias("ends"),
            F.flatten(F.transform("turns", lambda t: F.array(
                segment(opening(t["role"]), no),
                segment(escaped(t["text"], template.controls), t["role"].isin(*template.loss)),
                segment(F.lit(template.end), no),
            ))).alias("segments"),
        ).alias("block"),
    )
    whole = blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list("block")).alias("blocks"))

    def through(state: Column, block: Column) -> tuple[Column, Column]:
        end = F.get(block["ends"], state)
        return end["state"], end["good"]

    finals = [states.index(s) for s in template.finals]
    return whole.select(
        "conv_id",
        F.aggregate(F.transform("blocks", lambda b: b["n"]), F.lit(0).cast("long"), lambda a, n: a + n).alias("n_turns"),
        _folded(F.col("blocks"), F.lit(states.index(template.start)), through).alias("end"),
        F.flatten(F.transform("blocks", lambda b: b["segments"])).alias("segments"),
    ).select(
        "conv_id", "n_turns", F.col("end.good").alias("n_in_order"), (F.col("end.good") == F.col("n_turns")).alias("in_order"),
        F.col("end.state").isin(*finals).alias("complete"), "segments",
    )


def joined(segments: str = "segments") -> Column:
    """The formatted text."""
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def under_loss(segments: str = "segments") -> Column:
    """What counts in the loss, as it was before escaping."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


def turns_of(text: Column, template: Template = TURNS) -> Column:
    """The turns (role, text) that a formatted text holds, read back from it alone."""
    ended = "(?s)" + _quoted(template.end)
    pieces = F.split(text, ended)
    rest = F.slice(pieces, 1, F.size(pieces) - 1)  # behind the last end there is nothing

    def turn(piece: Column) -> Column:
        before, behind = template.other
        named = F.substr(piece, F.lit(len(before) + 1))
        name = F.substring_index(named, behind, 1)
        role, body = unescaped(name), F.substr(named, F.length(name) + len(behind) + 1)
        for known, opening in template.openings.items():
            own = F.startswith(piece, F.lit(opening))
            role = F.when(own, known).otherwise(role)
            body = F.when(own, F.substr(piece, F.lit(len(opening) + 1))).otherwise(body)
        return F.struct(role.alias("role"), unescaped(body).alias("text"))

    return F.transform(rest, turn)


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or c == "\n" else "\\" + c for c in text)


def digested(chats: DataFrame, template: Template = TURNS) -> DataFrame:
    """What `formatted` wrote, read back: conv_id, n_turns, turns_sha256 (role, newline, text, newline
    of each turn), loss_chars, loss_sha256 (of all text under the loss, unescaped), formatted_chars,
    in_order and complete."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = chats.withColumn("text", joined()).select("*", turns_of(F.col("text"), template).alias("turns"), under_loss().alias("loss"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("text").cast("long").alias("formatted_chars"), "in_order", "complete",
    )


def with_hard_case(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text, and conversation -7, whose two texts hold the control strings."""
    hard = conversations.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    own = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return own.unionByName(hard)
