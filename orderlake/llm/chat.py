"""Chat formatting with typed content parts.

A turn's content is a list of parts (text, image, audio, document). A visitor flattens
them in order: text is escaped, the others become a placeholder each, with their
reference and the number of tokens they expand to recorded beside the text. The template
marks a turn, its role, its body, the loss mask of assistant bodies and the end:

    <|turn|>role<|body|>text<|end|>        <|turn|>assistant<|body|><|loss|>text<|/loss|><|end|>

Escaping is reversible: every backslash is doubled, and every control string inside a
text gets a backslash after its first character, so no control string is left in it.

Formatting works row by row. Reading back (``read_conversations``) streams the turns of a
conversation in order through one task and keeps only digests, so a conversation with
very many turns needs no memory; its hash is sequential by definition.

Defined results: null role and null text are empty; null conv_id is a conversation of its
own; rows of one turn number order by their formatted text; a null turn comes first; an
empty table gives an empty result; extra columns are kept out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Control strings of the template and of common chat formats.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<|turn|>", "<|body|>", "<|loss|>", "<|/loss|>", "<|end|>",
           "<|image|>", "<|audio|>", "<|document|>", "<|endoftext|>", "<|im_start|>", "<|im_end|>"]
_ESCAPE = re.compile(r"\\|" + "|".join(re.escape(c) for c in CONTROL))
_UNESCAPE = re.compile(r"\\(\\?)")
_TURN = re.compile(r"<\|turn\|>(.*?)<\|body\|>(<\|loss\|>)?(.*?)(?:<\|/loss\|>)?<\|end\|>", re.S)

PART = ("struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>")
ATTACHMENT = "struct<position:int,type:string,ref:string,tokens:int>"


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


class FlattenParts:
    """Visitor over content parts: ``text`` so far, ``attachments`` in order."""

    def __init__(self, patch: int = 14, audio_tokens_per_second: float = 25.0, tokens_per_page: int = 256):
        self.patch, self.per_second, self.per_page = patch, audio_tokens_per_second, tokens_per_page
        self.text: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('type') or 'text'}", self.visit_text)(part)

    def visit_text(self, part: dict) -> None:
        self.text.append(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        across = -(-(part.get("width") or 0) // self.patch)
        down = -(-(part.get("height") or 0) // self.patch)
        self._attach("image", part, across * down)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, round((part.get("seconds") or 0) * self.per_second))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part.get("pages") or 0) * self.per_page)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.text.append(f"<|{kind}|>")
        self.attachments.append({"position": len(self.attachments), "type": kind, "ref": part.get("ref"),
                                 "tokens": int(tokens)})


def format_turn(role: str | None, parts: list[dict]) -> tuple[str, list[dict]]:
    flat = FlattenParts()
    for part in parts:
        flat.visit(part)
    body = "".join(flat.text)
    if role == "assistant":
        body = f"<|loss|>{body}<|/loss|>"
    return f"<|turn|>{escape(role or '')}<|body|>{body}<|end|>", flat.attachments


def read_turn(formatted: str) -> tuple[str, str, bool]:
    """(role, text, under the loss mask) of one formatted turn; placeholders stay."""
    m = _TURN.fullmatch(formatted)
    return unescape(m[1]), unescape(m[3]), bool(m[2])


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, turn, formatted, attachments; ``turns`` has conv_id, turn, role and either
    ``parts`` (list of PART) or plain ``text``."""
    if "parts" not in turns.columns:
        none = {t: F.lit(None).cast(t) for t in ("string", "int", "double")}
        turns = turns.withColumn("parts", F.array(F.struct(
            F.lit("text").alias("type"), F.col("text"), none["string"].alias("ref"), none["int"].alias("width"),
            none["int"].alias("height"), none["double"].alias("seconds"), none["int"].alias("pages"))))
    kind = pa.list_(pa.struct([("position", pa.int32()), ("type", pa.string()), ("ref", pa.string()),
                               ("tokens", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [format_turn(role, parts or []) for role, parts in
                    zip(batch.column("role").to_pylist(), batch.column("parts").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), pa.array([d[0] for d in done], pa.string()),
                 pa.array([d[1] for d in done], kind)], ["conv_id", "turn", "formatted", "attachments"])

    return turns.select("conv_id", "turn", "role", F.col("parts").cast(f"array<{PART}>")).mapInArrow(
        run, f"conv_id long, turn long, formatted string, attachments array<{ATTACHMENT}>")


def read_conversations(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, read back from its formatted turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        began, state = False, None

        def row():
            conv, n, turns, chars, loss, size = state
            return (conv, n, turns.hexdigest(), chars, loss.hexdigest(), size)

        for batch in batches:
            rows = []
            for conv, text in zip(batch.column("conv_id").to_pylist(), batch.column("formatted").to_pylist()):
                if not began or state[0] != conv:
                    if began:
                        rows.append(row())
                    began, state = True, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, said, masked = read_turn(text)
                state[1] += 1
                state[2].update(f"{role}\n{said}\n".encode())
                if masked:
                    state[3] += len(said)
                    state[4].update(said.encode())
                state[5] += len(text)
            if rows:
                yield as_batch(rows)
        if began:
            yield as_batch([row()])

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def as_batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    ordered = (formatted.select("conv_id", "turn", "formatted").repartition("conv_id")
               .sortWithinPartitions("conv_id", "turn", "formatted"))
    return ordered.select("conv_id", "formatted").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long")
