"""Conversations as text for training: a compiled template renders turns and marks what a model
is to learn; the output can be read back turn by turn."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm.chat_template import Template

START, END = "<|im_start|>", "<|im_end|>"
#: Turns between control strings; a model learns what an assistant says.
CHAT_TEMPLATE = """
{%- for message in messages -%}
{{ start ~ (message.role | escape_line) ~ "\\n" }}
{%- if message.role == "assistant" -%}
{% generation %}{{ message.text | escape }}{% endgeneration %}
{%- else -%}
{{ message.text | escape }}
{%- endif -%}
{{ end ~ "\\n" }}
{%- endfor -%}
{%- if add_generation_prompt -%}{{ start ~ "assistant\\n" }}{%- endif -%}
"""
#: Characters after which a conversation's output is cut, at the next end of a turn.
PIECE_CHARS = 1 << 20
ROWS_AT_ONCE = 512
_FORMATTED = "conv_id bigint, piece int, text string, learnt array<struct<start:int,end:int>>"
_TURNS = "conv_id bigint, turn bigint, role string, text string, learnt boolean"
_DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint"
)
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)


def escape(text: str) -> str:
    """No control string is left: each ``<``, backslashes, ``|`` gets one more backslash."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_line(text: str) -> str:
    """The same for a text that must be one line."""
    return escape(text.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_line(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


FILTERS = {"escape": escape, "escape_line": escape_line}


def chat_template(source: str = CHAT_TEMPLATE, add_generation_prompt: bool = False) -> Template:
    constants = {"start": START, "end": END, "add_generation_prompt": add_generation_prompt}
    return Template(source, ("messages",), constants, FILTERS)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            some = batch.slice(at, ROWS_AT_ONCE)
            yield from zip(*(some.column(i).to_pylist() for i in range(some.num_columns)), strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of a few MB at most, unless one row is larger."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += size(row)
        if len(held) >= ROWS_AT_ONCE or chars >= PIECE_CHARS:
            yield _batch(held, schema)
            held, chars = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _cut(pieces: Iterator, piece_chars: int) -> Iterator[tuple[str, list[dict[str, int]]]]:
    """Texts and the stretches to learn in each, cut at ends of turns."""
    texts: list[str] = []
    learnt: list[dict[str, int]] = []
    chars = 0
    for piece in pieces:
        if piece is None:
            if chars >= piece_chars:
                yield "".join(texts), learnt
                texts, learnt, chars = [], [], 0
            continue
        text, is_learnt = piece
        if is_learnt:
            if learnt and learnt[-1]["end"] == chars:
                learnt[-1]["end"] += len(text)
            else:
                learnt.append({"start": chars, "end": chars + len(text)})
        texts.append(text)
        chars += len(text)
    if chars:
        yield "".join(texts), learnt


def format_conversations(
    conversations: DataFrame, path: str, source: str = CHAT_TEMPLATE,
    add_generation_prompt: bool = False, piece_chars: int = PIECE_CHARS,
) -> None:
    """Renders every conversation (rows conv_id, turn, role, text) and writes conv_id, piece, text
    and learnt (stretches of the text that a model is to learn) as Parquet.

    Turns go by turn, then by role and text, so ties and repeated rows (all kept) have one order;
    null turns come first. A null role or text is empty, null ids are one conversation. No rows write
    an empty table. Other columns are not read.

    A conversation is rendered as a stream by one task, turn by turn: nothing of it is held but one
    piece, whatever its length, so the template may use its messages in one outermost loop only
    (others are refused); a loop knows the turns before and after each.
    """
    if not chat_template(source, add_generation_prompt).in_one_pass("messages"):
        raise ValueError("the template must use its messages in one outermost loop")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )
    schema = pa.schema([
        ("conv_id", pa.int64()), ("piece", pa.int32()), ("text", pa.string()),
        ("learnt", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ])

    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = chat_template(source, add_generation_prompt)

        def formatted() -> Iterator[tuple]:
            for conv_id, turns in groupby(_rows(batches), itemgetter(0)):
                messages = ({"turn": t, "role": r, "text": x} for _, t, r, x in turns)
                cuts = _cut(template.render(messages=messages), piece_chars)
                for number, (text, learnt) in enumerate(cuts):
                    yield conv_id, number, text, learnt

        return _batches(formatted(), schema, lambda row: len(row[2]))

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    ordered.mapInArrow(rendered, _FORMATTED).write.parquet(path)


def _parsed(text: str, learnt: list[dict[str, int]]) -> Iterator[tuple[str, str, bool]]:
    """Role, text and whether the text is to be learnt, of each turn of a piece."""
    spans, at = {(s["start"], s["end"]) for s in learnt}, 0
    for found in _TURN.finditer(text):
        if found.start() != at:
            break
        at = found.end()
        yield unescape_line(found[1]), unescape(found[2]), found.span(2) in spans
    if text[at:] not in ("", f"{START}assistant\n"):
        raise ValueError(f"this is no turn: {text[at : at + 40]!r}")


def _formatted(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.schema(_FORMATTED).parquet(path)
    return found.repartition("conv_id").sortWithinPartitions("conv_id", "piece")


def read_turns(spark: SparkSession, path: str) -> DataFrame:
    """conv_id, turn (from 0), role, text and learnt of every turn of the written output."""
    schema = pa.schema([
        ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
        ("text", pa.string()), ("learnt", pa.bool_()),
    ])

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for conv_id, pieces in groupby(_rows(batches), itemgetter(0)):
                number = 0
                for _, _, text, learnt in pieces:
                    for turn in _parsed(text, learnt):
                        yield conv_id, number, *turn
                        number += 1

        return _batches(rows(), schema, lambda row: len(row[3]))

    return _formatted(spark, path).mapInArrow(turns, _TURNS)


def conversation_digests(spark: SparkSession, path: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256 (role, newline, text, newline of each turn), loss_chars and
    loss_sha256 (of all stretches to learn, unescaped) and formatted_chars, from the output.

    Pieces of a conversation go through one task in order, as a digest must, one at a time.
    """
    schema = pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for conv_id, pieces in groupby(_rows(batches), itemgetter(0)):
                turns, loss = hashlib.sha256(), hashlib.sha256()
                n_turns = loss_chars = formatted_chars = 0
                for _, _, text, learnt in pieces:
                    formatted_chars += len(text)
                    for role, said, _ in _parsed(text, learnt):
                        n_turns += 1
                        turns.update(f"{role}\n{said}\n".encode())
                    for span in learnt:
                        said = unescape(text[span["start"] : span["end"]])
                        loss_chars += len(said)
                        loss.update(said.encode())
                yield conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), formatted_chars

        return _batches(rows(), schema, lambda row: 0)

    return _formatted(spark, path).mapInArrow(digests, _DIGESTS)
