"""Chat formatting by a finite-state machine over roles.

A ``Template`` is declarative: the strings around a turn, the transitions that
are allowed between roles, the states in which a conversation may end and the
roles whose text is learnt from.  Formatting emits ordered segments, each with
its loss flag; concatenated they are the formatted conversation.

Control strings all begin with ``<|``.  Inside a text, ``<`` followed by any
number of backslashes and ``|`` gets one backslash more, so ``<|`` never occurs
in an escaped text and the change can be undone exactly; all other texts are
unchanged.  In roles, backslashes and line ends are escaped as well.

Rows are dealt by conversation and sorted by turn inside the partitions; the
formatter and the reader stream over them, holding one turn at a time, so a
conversation may be as long as its data.

Defined cases: a null text or role is empty; an unknown role or a forbidden
transition marks the conversation invalid from that turn on, but it is still
formatted whole; equal turns are ordered by role, then text, null turns come
first; repeated rows are turns of their own; rows without conv_id form one
conversation with a null id; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlumen.llm.common import arrow_map

START = "start"


@dataclass(frozen=True)
class Template:
    """Turn order and markup of a chat format; keys of ``transitions`` are (state, role)."""

    turn_open: str = "<|im_start|>"
    role_end: str = "\n"
    turn_close: str = "<|im_end|>\n"
    loss_roles: frozenset = frozenset({"assistant"})
    accepting: frozenset = frozenset({"user", "assistant"})
    transitions: dict = field(default_factory=lambda: {
        (START, "system"): "system", (START, "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user"})

    def next(self, state: str | None, role: str) -> str | None:
        """The state after a turn; None once a turn was out of order."""
        return None if state is None else self.transitions.get((state, role))


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text) if "|" in text else text


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text) if "|" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


SEGMENTS = ("conv_id bigint, turn_no bigint, segment int, text string, loss boolean, "
            "state string, in_order boolean")


def format_segments(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """Ordered segments of every conversation (three a turn: opening, text, closing).

    ``state`` is the machine's state after the turn (null once out of order).
    Rows come out in the order of their partition: by conversation, turn, segment.
    """
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    placed = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def make():
        now: dict = {"conv": None, "turn": 0, "state": START, "any": False}

        def step(cols):
            out: dict[str, list] = {k: [] for k in
                                    ("conv_id", "turn_no", "segment", "text", "loss", "state", "in_order")}
            for conv, role, text in zip(cols["conv_id"], cols["role"], cols["text"], strict=True):
                if not now["any"] or conv != now["conv"]:
                    now.update(conv=conv, turn=0, state=START, any=True)
                state = now["state"] = template.next(now["state"], role)
                parts = ((template.turn_open + escape_role(role) + template.role_end, False),
                         (escape(text), role in template.loss_roles), (template.turn_close, False))
                for k, (part, loss) in enumerate(parts):
                    for name, value in zip(out, (conv, now["turn"], k, part, loss, state, state is not None),
                                           strict=True):
                        out[name].append(value)
                now["turn"] += 1
            return out

        return step

    return arrow_map(placed, SEGMENTS, make)


class Reader:
    """Reads turns back from formatted text that arrives in pieces."""

    def __init__(self, template: Template):
        self.t, self.held = template, ""

    def feed(self, piece: str):
        """Yield (role, text) of every turn that ``piece`` completes."""
        self.held += piece
        while (end := self.held.find(self.t.turn_close)) >= 0:
            turn, self.held = self.held[:end], self.held[end + len(self.t.turn_close):]
            if not turn.startswith(self.t.turn_open):
                raise ValueError("formatted text doesn't begin with a turn")
            role, _, text = turn[len(self.t.turn_open):].partition(self.t.role_end)
            yield unescape_role(role), unescape(text)


DIGESTS = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
           "formatted_chars bigint, valid boolean, first_bad_turn bigint")


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation, read from the segments alone (in their order)."""

    def make():
        now: dict = {}

        def begin(conv):
            now.update(conv=conv, turns=0, all=hashlib.sha256(), loss=hashlib.sha256(), loss_chars=0, chars=0,
                       bad=None, state=START, reader=Reader(template))

        def close(out):
            if now["reader"].held:
                raise ValueError("formatted text ends inside a turn")
            valid = now["bad"] is None and now["state"] in template.accepting
            for name, value in zip(out, (now["conv"], now["turns"], now["all"].hexdigest(), now["loss_chars"],
                                         now["loss"].hexdigest(), now["chars"], valid, now["bad"]), strict=True):
                out[name].append(value)

        def step(cols):
            out: dict[str, list] = {k.split()[0]: [] for k in DIGESTS.split(", ")}
            if cols is None:
                if now:
                    close(out)
                return out
            for conv, no, text, loss, state in zip(cols["conv_id"], cols["turn_no"], cols["text"], cols["loss"],
                                                   cols["state"], strict=True):
                if not now or conv != now["conv"]:
                    if now:
                        close(out)
                    begin(conv)
                now["chars"] += len(text)
                if loss:
                    plain = unescape(text)
                    now["loss"].update(plain.encode())
                    now["loss_chars"] += len(plain)
                if state is None and now["bad"] is None:
                    now["bad"] = no
                now["state"] = state
                for role, said in now["reader"].feed(text):
                    now["turns"] += 1
                    now["all"].update(f"{role}\n{said}\n".encode())
            return out

        return step

    return arrow_map(segments, DIGESTS, make, finish=True)
