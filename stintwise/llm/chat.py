"""Chat formatting by incremental black-box rendering.

A template is any object with ``render(turns) -> str`` for a list of (role, text).
Nothing is assumed about its inside: the conversation's successive turn prefixes
are rendered and consecutive outputs compared.  What prefix k adds to prefix k-1
is turn k's span; an output that does not begin with the one before shows a
template that rewrites history.  The text's place within a span is found the same
way, from two renderings of the turn with different texts.

Every prefix of every conversation is rendered, so a template that rewrites only in
between is found at any length; the characters rendered grow with the square of a
conversation's turns.

Defined cases: a null text or role is empty; turns are ordered by turn number
(nulls first), then role and text, so ties and repeated rows have a fixed order and
each is a turn; rows with a null conversation id form one conversation; an empty
table gives an empty result; further columns are ignored.  A conversation is held
whole in one task; different conversations are spread by a shuffle on the id.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]


class InstTemplate:
    """User turns in [INST] marks, assistant turns up to </s>, other roles named in [ROLE] marks.

    Control strings inside texts and role names are broken up by a backslash after
    their first character, and backslashes are doubled, so ``unescape`` restores them.
    """

    control = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")

    def escape(self, text: str) -> str:
        text = text.replace("\\", "\\\\")
        for c in self.control:
            text = text.replace(c, c[0] + "\\" + c[1:])
        return text

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)

    def render(self, turns: list[Turn]) -> str:
        out = []
        for role, text in turns:
            body = self.escape(text)
            if role == "user":
                out.append(f"<s>[INST] {body} [/INST]")
            elif role == "assistant":
                out.append(f" {body} </s>")
            else:
                out.append(f"<s>[ROLE] {self.escape(role)} [/ROLE] {body} </s>")
        return "".join(out)

    def parse(self, formatted: str) -> list[Turn]:
        """The turns of a rendered conversation."""
        turns, at = [], 0

        def upto(mark: str) -> str:
            nonlocal at
            end = formatted.index(mark, at) - 1
            text, at = formatted[at:end], end + 1 + len(mark)
            return self.unescape(text)

        while at < len(formatted):
            if formatted.startswith("<s>[INST] ", at):
                at += 10
                turns.append(("user", upto("[/INST]")))
            elif formatted.startswith("<s>[ROLE] ", at):
                at += 10
                role = upto("[/ROLE]")
                at += 1
                turns.append((role, upto("</s>")))
            else:
                at += 1
                turns.append(("assistant", upto("</s>")))
        return turns


@dataclass
class Located:
    """A rendered conversation; ``spans`` is None if the template rewrites history."""

    text: str
    spans: list[tuple[int, int]] | None
    rewritten_at: int | None = None      # first turn whose rendering changes earlier output


def locate_turns(render, turns: list[Turn]) -> Located:
    """Each turn's span in the rendered conversation, by rendering all its prefixes."""
    before, spans, rewritten = "", [], None
    for k in range(1, len(turns) + 1):
        now = render(turns[:k])
        if not now.startswith(before) and rewritten is None:
            rewritten = k - 1
        spans.append((len(before), len(now)))
        before = now
    return Located(before, spans if rewritten is None else None, rewritten)


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


class Formatter:
    """Renders conversations and finds the text within each turn's span."""

    def __init__(self, template, loss_roles: tuple[str, ...] = ("assistant",)):
        self.template, self.loss_roles = template, loss_roles
        self.frames: dict[tuple, tuple[int, int]] = {}

    def _frame(self, before: list[Turn], role: str) -> tuple[int, int]:
        """Characters that the template puts before and after a text, by two renderings."""
        base = len(self.template.render(before)) if before else 0
        a, b = (self.template.render(before + [(role, t)])[base:] for t in ("0", "1"))
        head = _common(a, b)
        return head, _common(a[::-1], b[::-1])

    def _content(self, text: str, span: tuple[int, int], turns: list[Turn], k: int) -> tuple[int, int] | None:
        role, want = turns[k]
        key = (turns[k - 1][0] if k else None, role)
        for fresh in (False, True):
            if fresh or key not in self.frames:
                self.frames[key] = self._frame(turns[:k], role)
            head, tail = self.frames[key]
            start, end = span[0] + head, span[1] - tail
            if start <= end and self.template.unescape(text[start:end]) == want:
                return start, end
        return None

    def format(self, turns: list[Turn]) -> dict:
        """Rendered text; per turn its span, its text's span and whether it is under the loss mask."""
        got = locate_turns(self.template.render, turns)
        out = {"formatted": got.text, "rewritten_at": got.rewritten_at, "spans": None}
        if got.spans is not None:
            out["spans"] = []
            for k, span in enumerate(got.spans):
                place = self._content(got.text, span, turns, k)
                out["spans"].append({"role": turns[k][0], "start": span[0], "end": span[1],
                                     "text_start": place and place[0], "text_end": place and place[1],
                                     "loss": place is not None and turns[k][0] in self.loss_roles})
        return out


SPANS = "array<struct<role: string, start: bigint, end: bigint, text_start: bigint, text_end: bigint, loss: boolean>>"
_SPANS_ARROW = pa.list_(pa.struct([("role", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                   ("text_start", pa.int64()), ("text_end", pa.int64()), ("loss", pa.bool_())]))


def format_conversations(rows: DataFrame, template=None, conv: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv``, ``formatted``, ``spans`` (null if history is rewritten), ``rewritten_at``."""
    template = template or InstTemplate()
    ordered = (rows.select(F.col(conv), F.col(turn).alias("_turn"),
                           F.coalesce(F.col(role).cast("string"), F.lit("")).alias("_role"),
                           F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
               .repartition(conv).sortWithinPartitions(conv, "_turn", "_role", "_text"))
    kind = ordered.schema[conv].dataType.simpleString()

    def turns(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            yield from zip(b.column(conv).to_pylist(), b.column("_role").to_pylist(), b.column("_text").to_pylist())

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter = Formatter(template)
        held: list[dict] = []
        size = 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([h["conv"] for h in held], conv_type), pa.array([h["formatted"] for h in held], pa.string()),
                 pa.array([h["spans"] for h in held], _SPANS_ARROW),
                 pa.array([h["rewritten_at"] for h in held], pa.int64())], [conv, "formatted", "spans", "rewritten_at"])

        conv_type = None

        def typed(it):
            nonlocal conv_type
            for b in it:
                conv_type = b.schema.field(conv).type
                yield b

        for key, group in groupby(turns(typed(batches)), key=lambda r: r[0]):
            held.append({"conv": key, **formatter.format([(r, t) for _, r, t in group])})
            size += len(held[-1]["formatted"])
            if size > 1 << 20:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    return ordered.mapInArrow(render, f"`{conv}` {kind}, formatted string, spans {SPANS}, rewritten_at bigint")


def digests(formatted: DataFrame, template=None, conv: str = "conv_id") -> DataFrame:
    """Counts and digests read back from the formatted texts and their loss spans."""
    template = template or InstTemplate()
    kind = formatted.schema[conv].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, spans in zip(b.column("formatted").to_pylist(), b.column("spans").to_pylist()):
                turns = template.parse(text)
                said = hashlib.sha256()
                for r, t in turns:
                    said.update(f"{r}\n{t}\n".encode())
                loss, chars = hashlib.sha256(), 0
                for s in spans or []:
                    if s["loss"]:
                        part = template.unescape(text[s["text_start"]:s["text_end"]])
                        chars += len(part)
                        loss.update(part.encode())
                rows.append((len(turns), said.hexdigest(), chars, loss.hexdigest(), len(text)))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(conv), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.int64())],
                [conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select(conv, "formatted", "spans").mapInArrow(
        read, f"`{conv}` {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
              "formatted_chars bigint")
