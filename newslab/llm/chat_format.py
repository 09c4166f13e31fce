"""Operator 1, chat formatting: a finite-state machine over roles writes template segments with loss flags.

Turns are dealt by conversation and sorted inside each partition, so the machine reads a stream of rows and
holds one turn at a time, whatever the length of a conversation.  The result is one row per text segment;
concatenating the ``text`` of a conversation's segments gives its formatted string.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START = "start"


@dataclass(frozen=True)
class Role:
    """Markers around a turn of one role; ``loss``: whether its text is trained on."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Declarative chat template: markers per role, and the machine's legal moves between roles.

    A role without an entry in ``roles`` is written between ``other_open`` (with the role's name) and
    ``other_close``, never trained on, and is an illegal move.
    """

    roles: dict[str, Role] = field(default_factory=lambda: {
        "system": Role("<<SYS>>\n", "\n<</SYS>>\n"),
        "user": Role("[INST] ", " [/INST]"),
        "assistant": Role("<s>", "</s>", loss=True),
    })
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        START: ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    })
    accept: tuple[str, ...] = ("assistant",)
    other_open: tuple[str, str] = ("[ROLE ", "] ")
    other_close: str = " [/ROLE]"

    @property
    def controls(self) -> list[str]:
        """Every control string, stripped, longest first."""
        raw = [m for r in self.roles.values() for m in (r.open, r.close)] + [*self.other_open[:1], self.other_close]
        return sorted({m.strip() for m in raw if m.strip()}, key=lambda m: (-len(m), m))


DEFAULT = Template()
SEGMENTS = "conv_id long, turn long, segment long, kind string, text string, loss boolean, legal boolean"
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, n_segments long, valid boolean")


def escaper(template: Template):
    """Reversible escaping: a backslash doubles; inside each control string ``\\.`` follows its first character."""
    inner = re.compile("(" + "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in template.controls) + ")")
    name_end = template.other_open[1].strip()

    def escape(text: str, name: bool = False) -> str:
        out = text.replace("\\", "\\\\")
        out = inner.sub(r"\1\\.", out)
        return out.replace(name_end, "\\:") if name else out

    return escape


_ESCAPED = re.compile(r"\\([\\.:])")


def unescaper(template: Template):
    back = {"\\": "\\", ".": "", ":": template.other_open[1].strip()}

    def unescape(text: str) -> str:
        return _ESCAPED.sub(lambda m: back[m[1]], text)

    return unescape


def _emit(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)


_SEG_SCHEMA = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("segment", pa.int64()),
                         ("kind", pa.string()), ("text", pa.string()), ("loss", pa.bool_()), ("legal", pa.bool_())])
_DIG_SCHEMA = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                         ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                         ("n_segments", pa.int64()), ("valid", pa.bool_())])
_FLUSH_CHARS = 4_000_000


def format_conversations(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Segments of every conversation of ``turns`` (conv_id, turn, role, text; other columns are ignored).

    Per turn three segments: ``open``, ``text`` (escaped; ``loss`` set by the template) and ``close``; after the
    last turn an empty ``end`` segment.  ``legal`` says whether the machine allowed the move (for ``end``: whether
    it stopped in an accepting state); illegal turns are formatted all the same, so a caller may filter or repair.

    Null role or text counts as empty; a null turn comes first; equal turns are ordered by role, then text, and
    repeated rows are formatted as often as they occur; rows with a null conv_id form one conversation; an empty
    table gives no rows.
    """
    rows = (turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escape, out, size = escaper(template), [], 0
        current, state, seg = object(), START, 0
        for batch in batches:
            for conv, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if conv != current:
                    if seg:
                        out.append((current, None, seg, "end", "", False, state in template.accept))
                    current, state, seg = conv, START, 0
                legal = role in template.moves.get(state, ())
                state = role
                known = template.roles.get(role)
                opened = known.open if known else escape(role, True).join(template.other_open)
                closed = known.close if known else template.other_close
                body = escape(text)
                out += [(conv, turn, seg, "open", opened, False, legal),
                        (conv, turn, seg + 1, "text", body, bool(known and known.loss), legal),
                        (conv, turn, seg + 2, "close", closed, False, legal)]
                seg += 3
                size += len(body) + 60
                if size > _FLUSH_CHARS:
                    yield _emit(out, _SEG_SCHEMA)
                    out, size = [], 0
        if seg:
            out.append((current, None, seg, "end", "", False, state in template.accept))
        yield _emit(out, _SEG_SCHEMA)

    return rows.mapInArrow(run, SEGMENTS)


class TurnParser:
    """Reads turns back from a formatted string that arrives in pieces, cut anywhere; holds the turn at hand only.

    Markers are all that it goes by: no control string occurs inside an escaped text, so a turn's text ends where the
    closing marker of its role first occurs.
    """

    def __init__(self, template: Template):
        self.unescape = unescaper(template)
        self.opens = sorted(((r.open, name, r.close) for name, r in template.roles.items()), key=lambda o: -len(o[0]))
        self.other, self.other_close = template.other_open, template.other_close
        self.rest, self.role, self.close, self.seen = "", None, "", 0

    def _open(self) -> bool:
        for mark, role, close in self.opens:
            if self.rest.startswith(mark):
                self.role, self.close, self.rest, self.seen = role, close, self.rest[len(mark):], 0
                return True
        before, after = self.other
        if self.rest.startswith(before) and (end := self.rest.find(after, len(before))) >= 0:
            self.role, self.close = self.unescape(self.rest[len(before):end]), self.other_close
            self.rest, self.seen = self.rest[end + len(after):], 0
            return True
        if self.rest.startswith(before) or any(m.startswith(self.rest) for m in (*(o[0] for o in self.opens), before)):
            return False  # the rest of the marker is still to come
        raise ValueError(f"no opening marker at {self.rest[:40]!r}")

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        """Turns (role, text) that end in ``piece``."""
        self.rest += piece
        while self.rest or self.role is not None:
            if self.role is None and not self._open():
                return
            end = self.rest.find(self.close.strip(), self.seen)
            lead = len(self.close) - len(self.close.lstrip())
            if end < 0 or len(self.rest) < end - lead + len(self.close):
                self.seen = max(0, len(self.rest) - len(self.close)) if end < 0 else end
                return
            text, self.rest = self.rest[:end - lead], self.rest[end - lead + len(self.close):]
            yield self.role, self.unescape(text)
            self.role = None

    def finish(self) -> None:
        if self.rest or self.role is not None:
            raise ValueError("the formatted string ends inside a turn")


def read_back(segments: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Per conversation, digests of its formatted string, parsed again, and of the text under its loss mask.

    The string is the conversation's segments one after the other; turns are found in it by its markers alone
    (``TurnParser``).  Reads the segments in the order in which they were made, in the same stage and without another
    shuffle, one segment at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unescape, parser, out = unescaper(template), TurnParser(template), []
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n_turns = loss_chars = chars = n_segments = 0
        valid = True
        for batch in batches:
            conv_ids, texts, flags, legals, kinds = (
                batch.column(batch.schema.get_field_index(c)).to_pylist()
                for c in ("conv_id", "text", "loss", "legal", "kind"))
            for conv, text, flag, legal, kind in zip(conv_ids, texts, flags, legals, kinds):
                valid = valid and legal
                chars += len(text)
                for role, plain in parser.feed(text):
                    turns.update(f"{role}\n{plain}\n".encode())
                    n_turns += 1
                if flag:
                    masked = unescape(text)
                    loss.update(masked.encode())
                    loss_chars += len(masked)
                if kind == "end":
                    parser.finish()
                    out.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, n_segments, valid))
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                    n_turns = loss_chars = chars = n_segments = 0
                    valid = True
                    continue
                n_segments += 1
            if len(out) > 10_000:
                yield _emit(out, _DIG_SCHEMA)
                out = []
        yield _emit(out, _DIG_SCHEMA)

    return segments.mapInArrow(run, DIGESTS)
