"""Chat formatting of turns made of typed parts.

A visitor goes over the parts of a turn in order. Text is escaped and written; an image,
an audio clip or a document becomes a numbered placeholder, its reference and the number
of tokens it will be expanded to are recorded. A turn becomes one segment of text:

    <|turn|>role<|part|>content<|end|>

The formatted conversation is its segments in order. It stays one row a turn, so that a
conversation of any length fits; ``read_back`` goes through the segments in order.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, PART, END = "<|turn|>", "<|part|>", "<|end|>"
#: Strings that chat templates give a meaning. In texts a backslash goes behind their first
#: character, after every backslash has been doubled.
CONTROL = r"<\||</?s>|\[/?INST\]|<</?SYS>>"
#: Pixels of an image patch, tokens of a second of audio and of a document page.
PATCH, AUDIO_RATE, PAGE_TOKENS = 14, 25, 400
#: The role whose text is under the loss mask.
LEARNED = "assistant"

PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
_FORMATTED = (
    "conv_id long, turn long, segment string, loss array<struct<start:int,length:int>>, "
    "attachments array<struct<number:int,kind:string,ref:string,tokens:int>>, attachment_tokens long"
)
_control = re.compile(CONTROL)
_escaped = re.compile(r"\\(.)", re.S)
_segment = re.compile(r"<\|turn\|>(.*?)<\|part\|>(.*)<\|end\|>", re.S)


def escape(text: str) -> str:
    return _control.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _escaped.sub(r"\1", text)


class Visitor:
    """Collects the content of one turn; there is a method for each kind of part.

    Texts that follow each other are escaped as one, so that no control string is formed where they meet.
    """

    def __init__(self):
        self.waiting: list[str] = []
        self.out: list[str] = []
        self.length = 0
        self.texts: list[tuple[int, int]] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict | None) -> None:
        if part is not None:
            getattr(self, f"visit_{part['kind']}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        self.waiting.append(part["text"] or "")

    def finish(self) -> None:
        """Writes the texts that wait, as one."""
        text = escape("".join(self.waiting))
        self.waiting.clear()
        if text:
            self.texts.append((self.length, len(text)))
            self._write(text)

    def visit_image(self, part: dict) -> None:
        self._attach(part, math.ceil((part["width"] or 0) / PATCH) * math.ceil((part["height"] or 0) / PATCH))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, math.ceil((part["seconds"] or 0.0) * AUDIO_RATE))

    def visit_document(self, part: dict) -> None:
        self._attach(part, (part["pages"] or 0) * PAGE_TOKENS)

    def visit_other(self, part: dict) -> None:
        self._attach(part | {"kind": "other"}, 0)

    def _attach(self, part: dict, tokens: int) -> None:
        self.finish()
        number = len(self.attachments) + 1
        self.attachments.append({"number": number, "kind": part["kind"], "ref": part["ref"], "tokens": tokens})
        self._write(f"<|{part['kind']}:{number}|>")

    def _write(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        {
            "conv_id": pa.int64(),
            "turn": pa.int64(),
            "segment": pa.string(),
            "loss": pa.list_(pa.struct({"start": pa.int32(), "length": pa.int32()})),
            "attachments": pa.list_(
                pa.struct({"number": pa.int32(), "kind": pa.string(), "ref": pa.string(), "tokens": pa.int32()})
            ),
            "attachment_tokens": pa.int64(),
        }
    )
    for b in batches:
        rows = []
        for r in b.to_pylist():
            v = Visitor()
            for part in r["parts"] or ():
                v.visit(part)
            v.finish()
            role = r["role"] or ""
            head = f"{TURN}{escape(role)}{PART}"
            masked = v.texts if role == LEARNED else []
            rows.append(
                {
                    "conv_id": r["conv_id"],
                    "turn": r["turn"],
                    "segment": f"{head}{''.join(v.out)}{END}",
                    "loss": [{"start": len(head) + s, "length": n} for s, n in masked],
                    "attachments": v.attachments,
                    "attachment_tokens": sum(a["tokens"] for a in v.attachments),
                }
            )
        yield pa.RecordBatch.from_pylist(rows, schema)


def text_parts(text) -> F.Column:
    """A turn's ``parts`` if it is one text."""
    empty = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("kind"), text.cast("string").alias("text"), *(empty.cast(t).alias(n) for n, t in (
                ("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int")
            ))
        )
    )


def formatted(turns: DataFrame) -> DataFrame:
    """One segment for each row of ``turns`` (``conv_id, turn, role, parts``; ``parts`` as in PARTS).

    Adds the spans of code points under the loss mask (text of assistants), the
    attachments in order and the sum of their tokens. Null roles, parts and texts count as
    empty; kinds other than text, image, audio and document become placeholders named
    ``other`` without tokens. Repeated rows stay; other columns are ignored; an empty
    table gives no rows.
    """
    rows = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("parts").cast(PARTS)
    )
    return rows.mapInArrow(_format, _FORMATTED)


def parse(segment: str) -> tuple[str, str]:
    """Role and text of a segment; placeholders stay where they are."""
    role, content = _segment.fullmatch(segment).groups()
    return unescape(role), unescape(content)


class _Digest:
    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, spans: list[dict]) -> None:
        role, text = parse(segment)
        self.turns += 1
        self.chars += len(segment)
        self.all.update(f"{role}\n{text}\n".encode())
        for s in spans or ():
            masked = unescape(segment[s["start"] : s["start"] + s["length"]])
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())

    def row(self) -> dict:
        return {
            "conv_id": self.conv_id,
            "n_turns": self.turns,
            "turns_sha256": self.all.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars,
        }


_DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            (n, pa.string() if t == "string" else pa.int64())
            for n, t in (column.split() for column in _DIGESTS.split(", "))
        ]
    )
    now: _Digest | None = None
    for b in batches:
        done = []
        for conv_id, segment, loss in zip(*(b.column(n).to_pylist() for n in ("conv_id", "segment", "loss")), strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.row())
                now = _Digest(conv_id)
            now.add(segment, loss)
        yield pa.RecordBatch.from_pylist(done, schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.row()], schema)


def read_back(segments: DataFrame) -> DataFrame:
    """A row for each conversation of ``segments`` with digests of what its segments say.

    Segments are read in the order of ``turn``, nulls first, those of one turn in the
    order of their text. A task holds one batch and the running digests, whatever the
    length of a conversation. Rows with a null ``conv_id`` are one conversation.
    """
    ordered = segments.select("conv_id", "turn", "segment", "loss").repartition("conv_id")
    return ordered.sortWithinPartitions("conv_id", "turn", "segment").mapInArrow(_digests, _DIGESTS)
