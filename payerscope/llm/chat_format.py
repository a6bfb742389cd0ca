"""Conversations as one formatted text: typed content parts, escaped control strings, a loss mask.

A turn's content is a list of typed parts. A visitor walks them in order: text is escaped and copied, an image,
sound or document leaves a numbered placeholder, its reference and the number of tokens that a model puts in its
place. The template marks each turn by its role; what stands between an assistant's marks is under the loss mask.

Escaping: a backslash is doubled, and one is put after the first character of each control string that stands in a
text, so no escaped text holds a control string, and taking the backslashes out gives the text back. Control strings
start with ``<`` or ``[`` and hold no other start of one, so occurrences do not overlap.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import ceil
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_shared
from .chat_rows import Digest, conversations_of, fold_pieces, in_batches

MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
ROLE_MARK, ROLE_END, TURN_END = "[ROLE]", "[/ROLE]", "[END]"  # any other role is spelled out
PLACEHOLDERS = {"image": "IMAGE", "audio": "AUDIO", "document": "DOCUMENT"}
OTHER = "ATTACHMENT"
LEARNED = "assistant"

_FIXED = [mark for pair in MARKS.values() for mark in pair] + [ROLE_MARK, ROLE_END, TURN_END]
_HOLDER = rf"\[(?:{'|'.join([*PLACEHOLDERS.values(), OTHER])}):[0-9]+\]"
CONTROL = re.compile("|".join([*map(re.escape, _FIXED), _HOLDER]))
_TO_ESCAPE = re.compile(rf"\\|{CONTROL.pattern}")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
CHARS_A_PIECE = 1_000_000


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" if m[1] == "\\" else m[1], text)


class Sizes(NamedTuple):
    """What an attachment counts for: pixels a patch side, patches merged a side, tokens a second, a page."""

    patch: int = 14
    merged: int = 2
    audio_tokens_a_second: float = 25.0
    tokens_a_page: int = 512


PART_FIELDS = [
    ("kind", T.StringType()), ("text", T.StringType()), ("reference", T.StringType()), ("width", T.LongType()), ("height", T.LongType()),
    ("seconds", T.DoubleType()), ("pages", T.LongType()),
]
PART = T.StructType([T.StructField(*field) for field in PART_FIELDS])


class Flattener:
    """Visits the parts of a turn in order and collects formatted text and attachments."""

    def __init__(self, sizes: Sizes):
        self.sizes, self.out, self.attachments, self.at = sizes, [], [], 0

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part['kind']}", self.visit_other)(part)

    def put(self, text: str) -> None:
        self.out.append(text)
        self.at += len(text)

    def visit_text(self, part: dict) -> None:
        self.put(escape(part["text"] or ""))

    def visit_image(self, part: dict) -> None:
        side = self.sizes.patch * self.sizes.merged
        self.attach(part, ceil((part["width"] or 0) / side) * ceil((part["height"] or 0) / side))

    def visit_audio(self, part: dict) -> None:
        self.attach(part, ceil((part["seconds"] or 0) * self.sizes.audio_tokens_a_second))

    def visit_document(self, part: dict) -> None:
        self.attach(part, (part["pages"] or 0) * self.sizes.tokens_a_page)

    def visit_other(self, part: dict) -> None:
        self.attach(part, 0)

    def attach(self, part: dict, tokens: int) -> None:
        number = len(self.attachments) + 1
        self.attachments.append({"kind": part["kind"], "reference": part["reference"], "tokens": tokens, "number": number, "start": self.at})
        self.put(f"[{PLACEHOLDERS.get(part['kind'], OTHER)}:{number}]")


def format_turn(role: str, parts: list[dict], sizes: Sizes) -> tuple[str, tuple[int, int] | None, list[dict]]:
    """(text, place of the loss mask, attachments) of one turn."""
    flat = Flattener(sizes)
    if role in MARKS:
        flat.put(MARKS[role][0])
    else:
        flat.put(ROLE_MARK + escape(role) + ROLE_END)
    start = flat.at
    for part in parts:
        flat.visit(part)
    stop = flat.at
    flat.put(MARKS[role][1] if role in MARKS else TURN_END)
    return "".join(flat.out), (start, stop) if role == LEARNED else None, flat.attachments


def turns_in(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, escaped content) of each turn of a formatted text; content keeps its placeholders."""
    opening = {marks[0]: role for role, marks in MARKS.items()}
    holder, role, start, spelled = re.compile(_HOLDER), None, 0, 0
    for mark in CONTROL.finditer(formatted):
        if holder.fullmatch(mark[0]):
            continue
        if mark[0] in opening:
            role, start = opening[mark[0]], mark.end()
        elif mark[0] == ROLE_MARK:
            spelled = mark.end()
        elif mark[0] == ROLE_END:
            role, start = unescape(formatted[spelled:mark.start()]), mark.end()
        else:
            yield role, formatted[start:mark.start()]


MASK = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
ATTACHMENT = T.StructType([
    T.StructField("turn", T.LongType()), T.StructField("number", T.LongType()), T.StructField("kind", T.StringType()),
    T.StructField("reference", T.StringType()), T.StructField("tokens", T.LongType()), T.StructField("start", T.LongType()),
])
FORMATTED = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("piece", T.LongType()), T.StructField("whole", T.BooleanType()),
    T.StructField("n_turns", T.LongType()), T.StructField("formatted", T.StringType()), T.StructField("mask", T.ArrayType(MASK)),
    T.StructField("attachments", T.ArrayType(ATTACHMENT)), T.StructField("attachment_tokens", T.LongType()),
])
ARROW = pa.schema([
    ("conv_id", pa.int64()), ("piece", pa.int64()), ("whole", pa.bool_()), ("n_turns", pa.int64()), ("formatted", pa.string()),
    ("mask", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
    ("attachments", pa.list_(pa.struct([
        ("turn", pa.int64()), ("number", pa.int64()), ("kind", pa.string()), ("reference", pa.string()), ("tokens", pa.int64()),
        ("start", pa.int64()),
    ]))),
    ("attachment_tokens", pa.int64()),
])


def text_part(text: Column) -> Column:
    """Content that is one text part."""
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in PART_FIELDS[2:]]
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text.cast("string"), F.lit("")).alias("text"), *nothing))


def json_parts(content: Column) -> Column:
    """Content as chat interfaces write it: a JSON list of parts with ``type``; anything else is one text part."""
    fields = ", ".join(f"{'type' if name == 'kind' else name}: {kind.simpleString()}" for name, kind in PART_FIELDS)
    read = F.from_json(content, f"array<struct<{fields}>>").cast(T.ArrayType(PART))
    typed = content.rlike(r"\A\s*\[\s*\{") & read.isNotNull() & F.forall(read, lambda p: p["kind"].isNotNull())
    return F.when(typed, read).otherwise(text_part(content))


def format_chats(messages: DataFrame, sizes: Sizes = Sizes(), chars_a_piece: int = CHARS_A_PIECE) -> DataFrame:
    """Formatted conversations in pieces, with loss mask and attachments (schema ``FORMATTED``).

    ``messages`` has conv_id, turn, role and ``parts`` (an array of ``PART``); other columns are ignored. Rows stand in
    the order of turn (nulls first), then role, then parts. A null role is an empty one, null parts are none, a
    missing conv_id is a conversation of its own. Places count code points of the piece.

    Rows are dealt by ranges of (conv_id, turn, ...), so a conversation that holds a third of all rows is
    formatted by many tasks. A conversation is the concatenation of its pieces by number; ``whole`` says that a piece is
    all of it. Others are longer than ``chars_a_piece`` or may go on in the next task's range.
    """
    order = ["conv_id", "turn", "role", "parts"]
    rows = messages.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce("parts", F.array().cast(T.ArrayType(PART))).alias("parts"),
    )
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        previous, at_edge = None, True  # the first and the last conversation of a range may go on elsewhere
        for key, stream in conversations_of(batches):
            if previous:
                yield {**previous, "whole": previous["whole"] and not at_edge}
                at_edge = False
            previous, held, length, whole, mask, attachments, turns, first = None, [], 0, True, [], [], 0, None
            for row in stream:
                text, learned, found = format_turn(row["role"], row["parts"], sizes)
                if held and length + len(text) > chars_a_piece:
                    yield piece_of(key, first, False, turns, held, mask, attachments)
                    held, length, whole, mask, attachments, turns, first = [], 0, False, [], [], 0, None
                first = row["place"] if first is None else first
                if learned:
                    mask.append({"start": learned[0] + length, "stop": learned[1] + length})
                attachments += [{**a, "turn": row["turn"], "start": a["start"] + length} for a in found]
                held.append(text)
                length += len(text)
                turns += 1
            previous = piece_of(key, first, whole, turns, held, mask, attachments)
        if previous:
            yield {**previous, "whole": False}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches(pieces(batches), ARROW, 100)

    return dealt.mapInArrow(write, FORMATTED)


def piece_of(key, first: int, whole: bool, turns: int, held: list[str], mask: list[dict], attachments: list[dict]) -> dict:
    return {
        "conv_id": key, "piece": first, "whole": whole, "n_turns": turns, "formatted": "".join(held), "mask": mask,
        "attachments": attachments, "attachment_tokens": sum(a["tokens"] for a in attachments),
    }


# --- the registered query: all conversations formatted, written, read back and digested ------------------------

SELF_TEST = -7
SELF_TEST_TEXT = "</s>[INST] ok [/INST]"
DIGESTS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
    T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()),
])


def read_back(key: int | None, pieces: Iterator[dict]) -> dict:
    """What a reader of the formatted text sees: turns, and the text under the loss mask."""
    turns, learned, n_turns, chars = Digest(), Digest(), 0, 0
    for piece in pieces:
        text = piece["formatted"]
        chars += len(text)
        for role, content in turns_in(text):
            n_turns += 1
            turns.add(f"{role}\n{unescape(content)}\n")
        for span in piece["mask"]:
            learned.add(unescape(text[span["start"]:span["stop"]]))
    return {
        "conv_id": key, "n_turns": n_turns, "turns_sha256": turns.hex(), "loss_chars": learned.chars, "loss_sha256": learned.hex(),
        "formatted_chars": chars,
    }


def with_self_test(conversations: DataFrame, spark: SparkSession) -> DataFrame:
    """All rows and one conversation that says what control strings look like, each content one text part."""
    added = spark.range(2).select(
        F.lit(SELF_TEST).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(SELF_TEST_TEXT).alias("text"),
    )
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text"
    ).unionByName(added)
    return rows.select("conv_id", "turn", "role", text_part(F.col("text")).alias("parts"))


def chat_report(conversations: DataFrame, **limits: int) -> DataFrame:
    """One row per conversation, from the written formatted text."""
    spark = conversations.sparkSession
    written = write_shared(format_chats(with_self_test(conversations, spark), **limits), "chats")
    return fold_pieces(written, "whole", ["piece"], read_back, DIGESTS)
