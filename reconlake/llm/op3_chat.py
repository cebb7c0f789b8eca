"""Chat formatting with typed content parts.

A turn's content is a list of parts (text, image, audio, document). A visitor walks
them in order: text is escaped and kept, every other part becomes a placeholder; its
reference, its place and the number of tokens that it will expand to are recorded.
The template marks turns:

    user [INST]...[/INST]    assistant ...</s>    system [SYS]...[/SYS]
    any other role [ROLE]role[:]...[/ROLE]

and a conversation is <s> followed by its turns. Control strings inside texts get a
backslash before them, and so does each backslash, so that ``read_turn`` gives back
role and text exactly. The loss mask covers the assistant's texts.

Formatting needs one turn only, so turns are formatted where they lie, without a
shuffle. Digests of whole conversations stream through the sorted turns and keep a
running hash, never a conversation's text.

Nulls, ties, odd rows: a null text, part or role is empty; a null turn comes first;
rows that tie in turn are ordered by role, then text; rows that repeat are turns of
their own. Rows without conv_id are one conversation, with a null id. Unknown kinds
of part are an error. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START = "<s>"
KINDS = ("image", "audio", "document")
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("", "</s>"), "system": ("[SYS]", "[/SYS]")}
OTHER, SEP, OTHER_END = "[ROLE]", "[:]", "[/ROLE]"
CONTROL = [START, "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", OTHER, SEP, OTHER_END, *[f"<|{k}|>" for k in KINDS]]
_ESCAPE = re.compile("|".join([r"\\", *map(re.escape, CONTROL)]))
_UNESCAPE = re.compile(r"\\(.)", re.S)
PART = ("struct<kind:string,text:string,ref:string,width:bigint,height:bigint,seconds:double,pages:bigint>")
TURN = ("conv_id long, turn long, role string, formatted string, loss_start long, loss_end long, "
        "attachments array<struct<kind:string,ref:string,at:bigint,tokens:bigint>>, expanded_tokens long")


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


@dataclass(frozen=True)
class Expansion:
    """Tokens that an attachment expands to."""
    patch: int = 28                # an image's side of pixels per token
    per_second: float = 25.0
    per_page: int = 576


@dataclass
class PartVisitor:
    """Flattens parts in order; ``out`` is the text with placeholders."""
    rule: Expansion = field(default_factory=Expansion)
    out: list[str] = field(default_factory=list)
    length: int = 0
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict | None) -> None:
        if part is not None:
            getattr(self, f"visit_{part.get('kind') or 'text'}", self.unknown)(part)

    def unknown(self, part: dict) -> None:
        raise ValueError(f"no such kind of part: {part['kind']}")

    def _write(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def _attach(self, part: dict, tokens: float) -> None:
        self.attachments.append({"kind": part["kind"], "ref": part.get("ref"), "at": self.length,
                                 "tokens": max(1, math.ceil(tokens))})
        self._write(f"<|{part['kind']}|>")

    def visit_text(self, part: dict) -> None:
        self._write(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        side = [-(-(part.get(k) or 0) // self.rule.patch) for k in ("width", "height")]
        self._attach(part, side[0] * side[1])

    def visit_audio(self, part: dict) -> None:
        self._attach(part, (part.get("seconds") or 0) * self.rule.per_second)

    def visit_document(self, part: dict) -> None:
        self._attach(part, (part.get("pages") or 0) * self.rule.per_page)


def format_turn(role: str | None, parts: list[dict | None], rule: Expansion = Expansion()) -> dict:  # noqa: B008
    """The turn in the template, its loss mask and its attachments; places are code points of the turn."""
    role = role or ""
    before, after = MARKS.get(role) or (f"{OTHER}{escape(role)}{SEP}", OTHER_END)
    visitor = PartVisitor(rule, [before], len(before))
    for part in parts:
        visitor.visit(part)
    end = visitor.length
    mask = (len(before), end) if role == "assistant" else (None, None)
    return {"formatted": "".join(visitor.out) + after, "loss_start": mask[0], "loss_end": mask[1],
            "attachments": visitor.attachments, "expanded_tokens": sum(a["tokens"] for a in visitor.attachments)}


def read_turn(formatted: str) -> tuple[str, str]:
    """(role, content) of a formatted turn, unescaped; placeholders stay in the content."""
    for role, (before, after) in MARKS.items():
        if before and formatted.startswith(before):
            return role, unescape(formatted[len(before):-len(after)])
    if formatted.startswith(OTHER):
        # the first separator that is not escaped ends the role
        role = re.match(r"(?:\\.|(?!\[:\])[^\\])*", formatted[len(OTHER):], re.S)[0]
        return unescape(role), unescape(formatted[len(OTHER) + len(role) + len(SEP):-len(OTHER_END)])
    return "assistant", unescape(formatted[:-len(MARKS["assistant"][1])])


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pydict()
        made = [format_turn(role, [{"kind": "text", "text": text}, *(parts or [])])
                for role, text, parts in zip(rows["role"], rows["text"], rows["parts"], strict=True)]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int64()),
                                   ("tokens", pa.int64())]))
        yield pa.record_batch(
            [batch.column(0), batch.column(1), batch.column(2), pa.array([m["formatted"] for m in made], pa.string()),
             pa.array([m["loss_start"] for m in made], pa.int64()), pa.array([m["loss_end"] for m in made], pa.int64()),
             pa.array([m["attachments"] for m in made], kind),
             pa.array([m["expanded_tokens"] for m in made], pa.int64())],
            ["conv_id", "turn", "role", "formatted", "loss_start", "loss_end", "attachments", "expanded_tokens"])


def format_turns(turns: DataFrame, parts: str | None = None) -> DataFrame:
    """One formatted row per row of ``turns`` (conv_id, turn, role, text). ``parts`` names a
    column of typed parts that follow the text."""
    more = F.col(parts) if parts else F.lit(None)
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
                        more.cast(f"array<{PART}>").alias("parts")).mapInArrow(_format, TURN)


class _Digest:
    def __init__(self, conv_id: int | None):
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, len(START)
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int | None, end: int | None) -> None:
        role, text = read_turn(formatted)
        self.n_turns += 1
        self.chars += len(formatted)
        self.turns.update(f"{role}\n{text}\n".encode())
        if start is not None:
            masked = unescape(formatted[start:end])
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split(" ")[0] for f in DIGEST.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def batch_of(rows):
        return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    open_, done = None, []
    for batch in batches:
        for conv, *turn in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if open_ is None or conv != open_.conv_id:
                if open_ is not None:
                    done.append(open_.row())
                open_ = _Digest(conv)
            open_.add(*turn)
        if len(done) > 5000:
            yield batch_of(done)
            done = []
    if open_ is not None:
        done.append(open_.row())
    yield batch_of(done)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """The contract's columns per conversation, read back from the formatted turns."""
    # role and text order rows that tie in turn; both follow from the formatted turn
    rows = formatted.select("conv_id", "turn", "role", "formatted", "loss_start", "loss_end")
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
    return dealt.select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(_digest, DIGEST)
