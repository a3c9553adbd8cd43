"""Chat transcripts: a machine over roles checks their order, a template turns them into segments with loss flags."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, FAILED = "start", "failed"


@dataclass(frozen=True)
class Template:
    """How turns are written, which roles are learned, and which role may follow which state.

    Each turn is ``opening`` with the role's label, its text, then ``closing``. ``escape`` goes before each character of
    a text that could begin a control string, and before itself, so that texts are read back as they were.
    """

    labels: dict[str, str] = field(default_factory=lambda: {
        "system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"})
    opening: str = "### {label}: "
    closing: str = " </turn>\n"
    escape: str = "\\"
    learned: frozenset[str] = frozenset({"assistant"})
    #: state: roles that may come next; after a role the state has its name
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        START: ("system", "user"), "system": ("user",), "user": ("assistant",),
        "assistant": ("user", "tool"), "tool": ("assistant",)})

    def next_state(self, state: str, role: str) -> str:
        """The state after a turn; a turn out of order leads to ``failed``, which no turn leaves."""
        return role if role in self.follows.get(state, ()) else FAILED

    def hide(self, text: str, also: str = "") -> str:
        """The text with an escape before each character that begins a control string, and before itself."""
        guarded = {self.opening[0], self.closing.lstrip()[0], self.escape, *also}
        return re.sub(f"([{re.escape(''.join(sorted(guarded)))}])", lambda m: self.escape + m[1], text)

    def show(self, text: str) -> str:
        return re.sub(f"{re.escape(self.escape)}(.)", r"\1", text, flags=re.S)

    def open_turn(self, role: str) -> str:
        """The opening of a turn; a role without a label is written out after an equals sign."""
        return self.opening.format(label=self.labels.get(role) or "=" + self.hide(role, ":"))

    def turns(self) -> re.Pattern:
        """Finds the turns of a formatted text as (label, hidden text)."""
        before, after = self.opening.split("{label}")
        lead, end, esc = self.closing[:-len(self.closing.lstrip())], self.closing.lstrip(), re.escape(self.escape)
        first = re.escape(self.opening[0] + end[0])
        return re.compile(
            f"{re.escape(before)}((?:[^:{esc}]|{esc}.)*+){re.escape(after)}"
            f"((?:[^{esc}{first}]++|{esc}.)*+)(?<={re.escape(lead)}){re.escape(end)}", re.S)

    def read(self, formatted: str, pattern: re.Pattern | None = None) -> list[tuple[str, str]]:
        """Role and text of each turn of a formatted text."""
        roles, out, at = {v: k for k, v in self.labels.items()}, [], 0
        lead = len(self.closing) - len(self.closing.lstrip())
        for m in (pattern or self.turns()).finditer(formatted):
            if m.start() != at:
                raise ValueError("text outside of a turn")
            at, body = m.end(), m[2][:len(m[2]) - lead]
            role = self.show(m[1][1:]) if m[1].startswith("=") else roles[m[1]]
            out.append((role, self.show(body)))
        if at != len(formatted):
            raise ValueError("text outside of a turn")
        return out


SEGMENTS = "conv_id long, segment long, turn long, text string, loss boolean, state string"


def _ordered(df: DataFrame, *order: str) -> DataFrame:
    """All rows of a conversation in one partition, in order; sorted with spilling, read as a stream."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def format_chats(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """Segments of all conversations: (conv_id, segment, turn, text, loss, state).

    A turn gives three segments: its opening, its text and its closing; ``loss`` marks texts of learned roles. Their
    concatenation is the formatted conversation. ``state`` is the machine's after the turn; ``failed`` once a turn came
    out of order, and such conversations are written all the same. Rows come by turn, equal turns by role and text.
    A null text or role is empty, a null conv_id is a conversation of its own kind, null turns come first. A
    conversation is read as a stream, so its length is not bounded by memory.
    """
    rows = rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, number, begun = None, START, 0, False
        for batch in batches:
            out = {name: [] for name in ("conv_id", "segment", "turn", "text", "loss", "state")}
            for row in batch.to_pylist():
                if not begun or row["conv_id"] != conv:
                    conv, state, number, begun = row["conv_id"], START, 0, True
                state = template.next_state(state, row["role"])
                parts = (template.open_turn(row["role"]), template.hide(row["text"]), template.closing)
                for k, part in enumerate(parts):
                    out["conv_id"].append(conv)
                    out["segment"].append(number)
                    out["turn"].append(row["turn"])
                    out["text"].append(part)
                    out["loss"].append(k == 1 and row["role"] in template.learned)
                    out["state"].append(state)
                    number += 1
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], list(out))

    return _ordered(rows, "turn", "role", "text").mapInArrow(write, SEGMENTS)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"


def read_chats(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """Digests of the conversations that segments hold, read back from their texts.

    ``turns_sha256`` is over role, newline, text, newline of each turn; ``loss_sha256`` over the texts under the loss
    mask; ``valid`` tells whether all turns came in order.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in DIGESTS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        begun, conv, now, held, pattern = False, None, None, [], template.turns()

        def fresh():
            return {"n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "all": 0, "ok": True}

        def told(conv, x):
            return conv, x["n"], x["turns"].hexdigest(), x["chars"], x["loss"].hexdigest(), x["all"], x["ok"]

        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if not begun or row["conv_id"] != conv:
                    if begun:
                        done.append(told(conv, now))
                    begun, conv, now, held = True, row["conv_id"], fresh(), []
                held.append(row)
                now["all"] += len(row["text"])
                if len(held) == 3:
                    ((role, text),) = template.read("".join(x["text"] for x in held), pattern)
                    now["n"] += 1
                    now["turns"].update(f"{role}\n{text}\n".encode())
                    now["ok"] &= row["state"] != FAILED
                    if held[1]["loss"]:
                        now["chars"] += len(text)
                        now["loss"].update(text.encode())
                    held = []
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*done), kinds)], names)
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(told(conv, now), kinds)], names)

    return _ordered(segments, "segment").mapInArrow(read, DIGESTS)
