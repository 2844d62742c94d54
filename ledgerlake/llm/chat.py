"""Chat formatting with typed content parts.

A turn's content is a list of typed parts (text, image, audio, document; plain
text is one text part).  A visitor flattens them in order: text is escaped, the
others become numbered placeholders, and each attachment is recorded with its
reference, its place and the number of tokens that its placeholder stands for.

A turn is written as ``<|turn|>role\\ntext<|end|>\\n``.  Control strings of this
and other common templates inside texts, roles and references are broken by a
backslash after their first character, and backslashes are doubled, so that no
control string survives in a text and ``unescape`` gives the text back.  The loss
mask covers the contents of assistant turns.

One row per turn goes in and one comes out; a conversation is its rows in order
of (turn, role, text), nulls first, and is never gathered: digests read it as a
sorted stream.  Null texts and roles count as empty, parts of unknown type are
written as text, rows with equal keys stay separate turns, a null conv_id is a
conversation of its own.  Other columns pass through.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import shuffle_width

TURN, END = "<|turn|>", "<|end|>\n"
# Strings that templates give a meaning; none may come out of a text whole.
CONTROL = [
    "<|turn|>", "<|end|>", "<|image", "<|audio", "<|document", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|eot_id|>",
    "<|start_header_id|>", "<|end_header_id|>", "<|begin_of_text|>", "<|end_of_text|>", "<|startoftext|>", "<s>", "</s>", "<pad>", "<unk>",
    "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<start_of_turn>", "<end_of_turn>",
]
_SPECIAL = re.compile(r"\\|" + "|".join(re.escape(c[0]) + f"(?={re.escape(c[1:])})" for c in CONTROL))
_TURN = re.compile(re.escape(TURN) + r"(?P<role>(?:[^\\\n]|\\.)*)\n(?P<text>.*?)" + re.escape(END), re.S)


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    """Inverse of ``escape``: a doubled backslash is one, any other goes."""
    out, at = [], 0
    while (k := text.find("\\", at)) >= 0:
        out.append(text[at:k])
        if text[k + 1 : k + 2] == "\\":
            out.append("\\")
            at = k + 2
        else:
            at = k + 1
    return "".join(out) + text[at:]


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\\n")


@dataclass
class Flattener:
    """Visitor of content parts; ``pieces`` is the turn's flat text."""

    patch: int = 28  # pixels along a side of the square that one image token covers
    audio_rate: float = 25.0  # tokens a second
    page_tokens: int = 640  # tokens a document page
    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    size: int = 0

    def _write(self, piece: str) -> None:
        self.pieces.append(piece)
        self.size += len(piece)

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('type') or 'text'}", self.visit_text)(part)

    def visit_text(self, part: dict) -> None:
        self._write(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        wide, high = max(1, part.get("width") or 1), max(1, part.get("height") or 1)
        self._attach("image", part, math.ceil(wide / self.patch) * math.ceil(high / self.patch))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, max(1, math.ceil((part.get("seconds") or 0.0) * self.audio_rate)))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, max(1, part.get("pages") or 1) * self.page_tokens)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        mark = f"<|{kind}:{len(self.attachments)}|>"
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "placeholder": mark, "at": self.size, "tokens": tokens})
        self._write(mark)


PART = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
TURN_SCHEMA = "segment string, loss_start int, loss_end int, attachments array<struct<kind:string,ref:string,placeholder:string,at:int,tokens:int>>, extra_tokens int"


def format_turn(role: str | None, parts: list[dict]) -> dict:
    """The turn's segment, its loss span (code points in the segment), attachments (places in the segment), tokens they expand by."""
    role, flat = role or "", Flattener()
    for part in parts:
        flat.visit(part)
    head, text = f"{TURN}{escape_role(role)}\n", "".join(flat.pieces)
    for a in flat.attachments:
        a["at"] += len(head)
    learn = role == "assistant"
    return {
        "segment": head + text + END, "loss_start": len(head) if learn else 0, "loss_end": len(head) + len(text) if learn else 0,
        "attachments": flat.attachments, "extra_tokens": sum(a["tokens"] for a in flat.attachments),
    }


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted text; placeholders stay in the text."""
    return [(unescape(m["role"]), unescape(m["text"])) for m in _TURN.finditer(formatted)]


def format_chat(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text and, if any, parts: see PART) with the struct _turn: see TURN_SCHEMA."""
    typed = "parts" in turns.columns

    @F.pandas_udf(TURN_SCHEMA)
    def formatted(roles: pd.Series, texts: pd.Series, parts: pd.Series) -> pd.DataFrame:
        rows = []
        for role, text, listed in zip(roles, texts, parts):
            content = [{"type": "text", "text": text}] if listed is None else [p for p in listed if p is not None]
            rows.append(format_turn(role, content))
        return pd.DataFrame(rows, columns=["segment", "loss_start", "loss_end", "attachments", "extra_tokens"])

    parts = F.col("parts").cast(PART) if typed else F.lit(None).cast(PART)
    return turns.withColumn("_turn", formatted(F.col("role"), F.col("text"), parts))


def chat_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from the segments: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, extra_tokens."""
    schema = pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("extra_tokens", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, begun = None, False
        n = learnt = size = extra = 0
        all_turns, loss = hashlib.sha256(), hashlib.sha256()
        for batch in batches:
            out = []
            for conv, segment, lo, hi, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                if begun and conv != held:
                    out.append((held, n, all_turns.hexdigest(), learnt, loss.hexdigest(), size, extra))
                if not begun or conv != held:
                    held, begun = conv, True
                    n = learnt = size = extra = 0
                    all_turns, loss = hashlib.sha256(), hashlib.sha256()
                for role, text in read_turns(segment):
                    n += 1
                    all_turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                masked = unescape(segment[lo:hi])
                learnt += len(masked)
                loss.update(masked.encode("utf-8", "surrogatepass"))
                size += len(segment)
                extra += tokens
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((held, n, all_turns.hexdigest(), learnt, loss.hexdigest(), size, extra), schema)], schema=schema)

    width = shuffle_width(formatted.sparkSession)
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    rows = formatted.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text", "_turn")
    rows = rows.repartition(width, "conv_id").sortWithinPartitions(*order)
    rows = rows.select("conv_id", "_turn.segment", "_turn.loss_start", "_turn.loss_end", "_turn.extra_tokens")
    return rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, extra_tokens long")
