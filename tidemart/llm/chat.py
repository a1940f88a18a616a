"""Chat formatting of conversations whose messages hold typed content parts.

A message is a text or a list of parts (text, image, audio, document). A visitor, one method for each type,
flattens the parts in order: text is escaped, an attachment becomes a placeholder `<|image:3|>` that numbers the
attachments of the conversation, and its reference and expanded token count are recorded aside.

Template: a turn is `<|role|>`, the escaped role, a line feed, the body, `<|end|>` and a line feed. Escaping puts a
backslash before every backslash and every `|`, so no text, nor two texts side by side, can form the `<|` that opens
a control string. A line feed in a role is written as backslash and n. `read_turns` undoes all of it.

Order: turns by number (null first), equal numbers by role, then text, so repeated rows are all kept in a defined
order. A null text or role is empty; a null conversation id is a conversation of its own. An empty table gives an
empty result. A conversation is formatted as one value, so it must fit in the memory of a task; its rows are
gathered by Spark with its id as key.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

# Tokens that an attachment of a type takes up when the model sees it, for each unit of its size.
PART_TOKENS = {"image": 256, "audio": 50, "document": 400}
OPEN, CLOSE, END = "<|", "|>", "<|end|>\n"
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_PLACEHOLDER = re.compile(r"<\|[a-z]+:([0-9]+)\|>")
PART = "struct<type:string,text:string,ref:string,units:int>"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("|", "\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


@dataclass
class Flattener:
    """Visitor over content parts; keeps what it met in the order it met it.

    A null part, and a text part without text, is an empty text; a type that is not known raises, as no placeholder could stand for it.
    """

    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict | None) -> str:
        part = part or {}
        kind = part.get("type") or "text"
        if kind == "text":
            return self.visit_text(part)
        if kind not in PART_TOKENS:
            raise ValueError(f"unknown content part {kind!r}")
        return getattr(self, f"visit_{kind}")(part)

    def visit_text(self, part: dict) -> str:
        return escape(part.get("text") or "")

    def visit_image(self, part: dict) -> str:
        return self._attach("image", part)

    def visit_audio(self, part: dict) -> str:
        return self._attach("audio", part)

    def visit_document(self, part: dict) -> str:
        return self._attach("document", part)

    def _attach(self, kind: str, part: dict) -> str:
        number = len(self.attachments)
        units = max(1, part.get("units") or 1)
        self.attachments.append({"type": kind, "ref": part.get("ref"), "tokens": units * PART_TOKENS[kind]})
        return f"{OPEN}{kind}:{number}{CLOSE}"


def format_turns(turns: list[dict]) -> tuple[str, list[dict], list[dict]]:
    """The formatted conversation, start and end of each assistant body in it, and the attachments."""
    visitor, out, mask, at = Flattener(), [], [], 0
    for turn in turns:
        role = turn["role"] or ""
        head = f"{OPEN}role{CLOSE}{escape_role(role)}\n"
        body = "".join([visitor.visit(part) for part in turn["parts"] or ()])
        start = at + len(head)
        if role == "assistant":
            mask.append({"start": start, "end": start + len(body)})
        out += (head, body, END)
        at = start + len(body) + len(END)
    return "".join(out), mask, visitor.attachments


def read_turns(formatted: str, attachments: list[dict]) -> list[tuple[str, list[dict]]]:
    """Role and parts of each turn, read from the formatted conversation."""
    turns = []
    for turn in formatted.split(END)[:-1]:
        head, _, body = turn.partition("\n")
        pieces = _PLACEHOLDER.split(body)
        parts = []
        for i, piece in enumerate(pieces):
            if i % 2:
                parts.append(attachments[int(piece)])
            elif piece or len(pieces) == 1:
                parts.append({"type": "text", "text": unescape(piece)})
        turns.append((unescape_role(head.removeprefix(f"{OPEN}role{CLOSE}")), parts))
    return turns


def gathered(messages: DataFrame) -> DataFrame:
    """One row per conversation with its turns in order; `parts` is used where that column exists, else `text`."""
    if "parts" in messages.columns:
        parts = F.col("parts").cast(f"array<{PART}>")
    else:
        parts = F.array(
            F.struct(
                F.lit("text").alias("type"), F.col("text").cast("string").alias("text"),
                F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("units"),
            )
        )
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts"))
    return (
        messages.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("row"))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("row")).alias("turns"))
    )


def format_conversations(messages: DataFrame) -> DataFrame:
    """`conv_id`, `formatted`, `n_turns`, `loss` (start and end of what is learned), `attachments`, `attachment_tokens`."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        done = [format_turns(turns) for turns in batch.column("turns").to_pylist()]
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        attachment = pa.struct([("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])
        return pa.RecordBatch.from_pydict(
            {
                "conv_id": batch.column("conv_id"),
                "formatted": pa.array([text for text, _, _ in done], pa.string()),
                "loss": pa.array([mask for _, mask, _ in done], pa.list_(span)),
                "attachments": pa.array([found for _, _, found in done], pa.list_(attachment)),
            }
        )

    schema = """conv_id long, formatted string, loss array<struct<start:long,end:long>>,
        attachments array<struct<type:string,ref:string,tokens:long>>"""
    formatted = map_batches(gathered(messages), work, schema)
    return formatted.withColumn("attachment_tokens", F.expr("aggregate(attachments.tokens, 0L, (a, t) -> a + t)"))


def read_back(formatted: DataFrame) -> DataFrame:
    """What a reader of the formatted conversations finds: turns, what is learned, and their digests."""

    def digest(pieces: list[str]) -> str:
        return hashlib.sha256("".join(pieces).encode()).hexdigest()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = batch.to_pylist()
        turns = [read_turns(row["formatted"], row["attachments"]) for row in rows]
        spoken = [[(role, "".join([p.get("text") or "" for p in parts])) for role, parts in row] for row in turns]
        learned = [[unescape(_PLACEHOLDER.sub("", r["formatted"][s["start"] : s["end"]])) for s in r["loss"]] for r in rows]
        return pa.RecordBatch.from_pydict(
            {
                "conv_id": batch.column("conv_id"),
                "n_turns": pa.array(map(len, turns), pa.int64()),
                "turns_sha256": pa.array([digest([f"{r}\n{t}\n" for r, t in row]) for row in spoken], pa.string()),
                "loss_chars": pa.array([sum(map(len, row)) for row in learned], pa.int64()),
                "loss_sha256": pa.array(map(digest, learned), pa.string()),
                "formatted_chars": pa.array([len(r["formatted"]) for r in rows], pa.int64()),
            }
        )

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_batches(formatted.select("conv_id", "formatted", "loss", "attachments"), work, schema)
