"""Chat formatting: a state machine over roles writes turns as text segments, each with a loss flag, from a template."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of formatted text in a row; a longer conversation continues in a further row, cut between turns.
PART = 1 << 20
_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_ROLE_ESCAPES = {"\\": "\\\\", "\n": "\\n"}


def escape(text: str) -> str:
    """``text`` without any ``<|``: one backslash more between the two, whatever number stood there."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role in one line, without ``<|``."""
    return escape("".join(_ROLE_ESCAPES.get(c, c) for c in role))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass(frozen=True)
class Template:
    """What is written for a turn, what of it is learned, and which role may follow which.

    ``turn`` lists the segments in order: ``("mark", text)`` is written as it is, ``("role", "")`` and ``("text", "")``
    stand for the turn's own.  Marks hold the only ``<|`` of the output.  ``moves`` maps a state and a role to the next
    state; a role without a move is a fault: the turn is written all the same and the machine goes on in the state that
    the role leads to elsewhere, or stays where it is.
    """

    turn: tuple[tuple[str, str], ...] = (("mark", "<|im_start|>"), ("role", ""), ("mark", "\n"), ("text", ""), ("mark", "<|im_end|>\n"))
    learned: frozenset[str] = frozenset({"assistant"})
    start: str = "empty"
    complete: frozenset[str] = frozenset({"answered"})
    moves: Mapping[str, Mapping[str, str]] = field(default_factory=lambda: {
        "empty": {"system": "instructed", "user": "asked"},
        "instructed": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    })

    def __post_init__(self) -> None:
        kinds = [k for k, _ in self.turn]
        if kinds.count("role") != 1 or kinds.count("text") != 1:
            raise ValueError("a turn has one role and one text")
        for kind, after in (("role", "\n"), ("text", "<|")):
            at = kinds.index(kind) + 1
            if at == len(kinds) or kinds[at] != "mark" or not self.turn[at][1].startswith(after):
                raise ValueError(f"the mark behind the {kind} must start with {after!r}")
        if kinds[0] != "mark" or not self.turn[0][1].startswith("<|"):
            raise ValueError("a turn must start with a mark that starts with '<|'")

    def step(self, state: str, role: str) -> tuple[str, bool]:
        """The next state, and whether ``role`` was due."""
        to = self.moves.get(state, {}).get(role)
        if to is not None:
            return to, True
        return next((m[role] for m in self.moves.values() if role in m), state), False

    def segments(self, role: str, text: str) -> Iterator[tuple[str, bool]]:
        """The text segments of one turn, each with its loss flag."""
        for kind, mark in self.turn:
            if kind == "mark":
                yield mark, False
            elif kind == "role":
                yield escape_role(role), False
            else:
                yield escape(text), role in self.learned

    def reader(self) -> re.Pattern[str]:
        """One written turn: group ``role`` and group ``text``."""
        parts = {"role": r"(?P<role>[^\n]*)", "text": r"(?P<text>.*?)"}
        return re.compile("".join(parts.get(k) or re.escape(m) for k, m in self.turn), re.DOTALL)


CHAT = Template()
FORMATTED = ("conv_id long, part int, text string, loss array<struct<start: long, end: long>>, n_turns long, n_faults long, "
             "state string, last boolean")
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_FORMATTED = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("text", pa.string()), ("loss", _SPANS), ("n_turns", pa.int64()),
                        ("n_faults", pa.int64()), ("state", pa.string()), ("last", pa.bool_())])


class _Machine:
    """One conversation on its way through the template; :meth:`take` gives what has been written so far as a row."""

    def __init__(self, conv_id: int | None, template: Template) -> None:
        self.conv_id, self.template, self.state, self.part = conv_id, template, template.start, 0
        self._clear()

    def _clear(self) -> None:
        self.pieces, self.size, self.loss, self.turns, self.faults = [], 0, [], 0, 0

    def turn(self, role: str, text: str) -> None:
        self.state, due = self.template.step(self.state, role)
        self.turns += 1
        self.faults += not due
        for piece, learned in self.template.segments(role, text):
            if learned and piece:
                self.loss.append({"start": self.size, "end": self.size + len(piece)})
            self.pieces.append(piece)
            self.size += len(piece)

    def take(self, last: bool) -> dict:
        row = {"conv_id": self.conv_id, "part": self.part, "text": "".join(self.pieces), "loss": self.loss, "n_turns": self.turns,
               "n_faults": self.faults, "state": self.state, "last": last}
        self.part += 1
        self._clear()
        return row


def format_conversations(conversations: DataFrame, *, template: Template = CHAT, part: int | None = None, conv_id: str = "conv_id",
                         turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every conversation as training text: ``(conv_id, part, text, loss, n_turns, n_faults, state, last)``.

    Rows are ordered by ``turn`` (null first), then role, then text, and written by the template's state machine, which
    goes through the sorted rows of a partition and holds one part of one conversation at a time.  ``loss`` holds the
    learned spans of ``text`` in code points, in order, end exclusive; ``n_faults`` counts the turns of the part whose
    role was not due; ``state`` is where the machine stands behind the part.  A conversation of more than ``part``
    characters has several rows, cut between turns; ``last`` marks the final one.

    Defined results: a null role or text is empty; an empty learned text has no span; repeated rows are turns of their
    own; rows with a null id are one conversation without an id; an empty table gives an empty table; control strings
    in a text or role are escaped and come back as they were; other columns are not carried.
    """
    most = PART if part is None else part
    rows = conversations.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
                                F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = None
        for batch in batches:
            done = []
            for who, role_, text_ in zip(*[batch[c].to_pylist() for c in ("conv_id", "role", "text")], strict=True):
                if machine is None or who != machine.conv_id:
                    if machine:
                        done.append(machine.take(True))
                    machine = _Machine(who, template)
                elif machine.size >= most:
                    done.append(machine.take(False))
                machine.turn(role_, text_)
            yield pa.RecordBatch.from_pylist(done, _FORMATTED)
        if machine:
            yield pa.RecordBatch.from_pylist([machine.take(True)], _FORMATTED)

    sorted_ = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return sorted_.select("conv_id", "role", "text").mapInArrow(write, FORMATTED)


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_faults long, "
           "complete boolean")
_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                      ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_faults", pa.int64()), ("complete", pa.bool_())])


def turns_of(text: str, template: Template = CHAT) -> Iterator[tuple[str, str]]:
    """The ``(role, text)`` turns that a formatted text holds; a text that is not made of whole turns is an error."""
    reader, at = template.reader(), 0
    while at < len(text):
        found = reader.match(text, at)
        if not found:
            raise ValueError(f"no turn of the template at character {at}")
        yield unescape_role(found["role"]), unescape(found["text"])
        at = found.end()


class _Digest:
    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.turns, self.learned = conv_id, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.faults = 0
        self.state = None

    def read(self, text: str, loss: list[dict], faults: int, state: str, template: Template) -> None:
        for role, said in turns_of(text, template):
            self.turns.update(f"{role}\n{said}\n".encode())
            self.n_turns += 1
        for span in loss:
            said = unescape(text[span["start"]:span["end"]])
            self.learned.update(said.encode())
            self.loss_chars += len(said)
        self.chars += len(text)
        self.faults += faults
        self.state = state

    def row(self, template: Template) -> dict:
        return {"conv_id": self.conv_id, "n_turns": self.n_turns, "turns_sha256": self.turns.hexdigest(), "loss_chars": self.loss_chars,
                "loss_sha256": self.learned.hexdigest(), "formatted_chars": self.chars, "n_faults": self.faults,
                "complete": self.faults == 0 and self.state in template.complete}


def read_back(formatted: DataFrame, *, template: Template = CHAT) -> DataFrame:
    """One row per conversation, read from the formatted text and its loss spans alone.

    ``turns_sha256`` is over role, newline, text, newline of every turn; ``loss_sha256`` and ``loss_chars`` over all
    learned text, unescaped; ``complete`` says that no turn was out of order and the last state is a final one.
    Conversations of one part are read where they are; only the parts of longer ones are brought together, sorted and
    read one after the other.
    """
    columns = ["conv_id", "part", "text", "loss", "n_faults", "state"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = None
        for batch in batches:
            done = []
            for who, part, text, loss, faults, state in zip(*[batch[c].to_pylist() for c in columns], strict=True):
                if part == 0:
                    if digest:
                        done.append(digest.row(template))
                    digest = _Digest(who)
                digest.read(text, loss, faults, state, template)
            yield pa.RecordBatch.from_pylist(done, _DIGESTS)
        if digest:
            yield pa.RecordBatch.from_pylist([digest.row(template)], _DIGESTS)

    whole = F.expr("part = 0 AND last")
    long = formatted.filter(~whole).select(columns).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return formatted.filter(whole).select(columns).mapInArrow(read, DIGESTS).union(long.mapInArrow(read, DIGESTS))
