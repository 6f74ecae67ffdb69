r"""Chat formatting whose rendering is proved by parsing it again.

Grammar: a conversation is a sequence of turns

    ### ROLE:\n TEXT \n</turn>\n

ROLE has ``\``, ``:`` and line breaks escaped by ``\``. TEXT may not hold a control string (``</turn>`` or
``### ``) without a ``\`` before it; a control string after n > 0 backslashes stands for itself after n - 1. A turn is
first rendered with its text as it is and parsed; if that doesn't give back role and text, conflicting content is
escaped (one more ``\`` before every control string) and the result is parsed again. Rendering fails loudly if the
round trip still differs, which no text can bring about.

Turns are rendered where they are, then range-partitioned by (conv_id, turn) and gathered into blocks of text, so a
conversation of any length spreads over tasks. Reading back streams a conversation's blocks through one task with
constant memory: its digest depends on all turns in order.

NULL text or role is empty. Turns with equal numbers are ordered by role and text; NULL turns come first. Rows with a
NULL conv_id make one conversation. Repeated rows are turns of their own. Only the four columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm.common import Scratch, result, slices, table

END = "\n</turn>\n"
CONTROL = re.compile(r"(\\*)(</turn>|### )")
OPEN_CONTROL = re.compile(r"(?<!\\)(?:</turn>|### )")
ESCAPED = re.compile(r"\\(\\*)(</turn>|### )")
HEADER = re.compile(r"### ((?:[^\\:\n]|\\[\\:n])*):\n")
ROLE_OUT = {"\\": "\\\\", ":": "\\:", "\n": "\\n"}
ROLE_IN = {"\\\\": "\\", "\\:": ":", "\\n": "\n"}
LEARNED = "assistant"


def escape(text: str) -> str:
    return CONTROL.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2", text)


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, stop) of each turn; start and stop delimit the escaped text. Raises ValueError on any fault."""
    at = 0
    while at < len(formatted):
        header = HEADER.match(formatted, at)
        stop = formatted.find(END, header.end()) if header else -1
        if stop < 0:
            raise ValueError(f"no turn at {at}")
        body = formatted[header.end(): stop]
        if OPEN_CONTROL.search(body):
            raise ValueError(f"control string in the text at {header.end()}")
        yield re.sub(r"\\[\\:n]", lambda m: ROLE_IN[m[0]], header[1]), unescape(body), header.end(), stop
        at = stop + len(END)


def render(role: str, text: str) -> tuple[str, int, int, int]:
    """The formatted turn, start and stop of its text, and how many rounds of escaping it took."""
    name = "".join(ROLE_OUT.get(c, c) for c in role)
    body = text
    for rounds in range(2):
        formatted = f"### {name}:\n{body}{END}"
        try:
            turns = list(parse(formatted))
        except ValueError:
            turns = []
        if [t[:2] for t in turns] == [(role, text)]:
            return formatted, turns[0][2], turns[0][3], rounds
        body = escape(text)
    raise ValueError(f"a turn of role {role!r} does not survive the round trip")


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        made = [render(r or "", t or "") for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist(), strict=True)]
        columns = list(zip(*made, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in ("conv_id", "turn", "role", "text")), pa.array(columns[0], pa.string()),
             *(pa.array(c, pa.int64()) for c in columns[1:])],
            ["conv_id", "turn", "role", "text", "segment", "start", "stop", "rounds"])


def _gather(block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of whole turns with the spans of learned text, of segments sorted by conversation and turn."""
        segments, spans, size, block, now = [], [], 0, 0, ()

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([now[0]], pa.int64()), pa.array([block], pa.int64()), pa.array(["".join(segments)], pa.string()),
                 pa.array([spans], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))],
                ["conv_id", "block", "formatted", "loss"])

        for b in batches:
            for conv, role, segment, start, stop in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "segment", "start", "stop")), strict=True):
                if segments and ((conv,) != now or size + len(segment) > block_chars):
                    yield row()
                    segments, spans, size, block = [], [], 0, block + 1
                now = (conv,)
                if role == LEARNED:
                    spans.append({"start": size + start, "stop": size + stop})
                segments.append(segment)
                size += len(segment)
        if segments:
            yield row()
    return run


def format_conversations(rows: DataFrame, block_chars: int = 1_000_000) -> DataFrame:
    """(conv_id, part, block, formatted, loss): a conversation is its blocks in the order of (part, block).

    ``loss`` lists the spans of assistant texts in code points of ``formatted``; everything else is masked.
    """
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    turns = rows.mapInArrow(_render, "conv_id long, turn long, role string, text string, segment string, start long, stop long, rounds long")
    ordered = turns.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    blocks = ordered.mapInArrow(_gather(block_chars), "conv_id long, block long, formatted string, loss array<struct<start:long,stop:long>>")
    return blocks.withColumn("part", F.spark_partition_id()).select("conv_id", "part", "block", "formatted", "loss")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation, from blocks in order: what its formatted text says."""
    now: tuple = ()
    turns, loss, n, learned, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
    done = []
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    for b in batches:
        for conv, formatted, spans in zip(*(b.column(c).to_pylist() for c in ("conv_id", "formatted", "loss")), strict=True):
            if (conv,) != now:
                if now:
                    done.append([now[0], n, turns.hexdigest(), learned, loss.hexdigest(), chars])
                now = (conv,)
                turns, loss, n, learned, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for role, text, _, _ in parse(formatted):
                turns.update(f"{role}\n{text}\n".encode())
                n += 1
            for span in spans:
                text = unescape(formatted[span["start"]: span["stop"]])
                loss.update(text.encode())
                learned += len(text)
            chars += len(formatted)
        if len(done) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
            done = []
    if now:
        done.append([now[0], n, turns.hexdigest(), learned, loss.hexdigest(), chars])
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)


def read_back(blocks: DataFrame) -> DataFrame:
    """Digests of all conversations, parsed from their formatted text."""
    ordered = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    return ordered.mapInArrow(
        _digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that quotes the template, formatted, written and read back."""
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    with Scratch(spark, "chat") as scratch:
        return result(read_back(scratch.keep(format_conversations(rows), "formatted")), "op1")


ORACLE_OP1 = r"""
with rows_ as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -7, i, case i when 0 then 'user' else 'assistant' end, '\### Assistant: </turn> ok' from range(2) t(i)
), escaped as (
  select *, regexp_replace(text, '(\\*)(</turn>|### )', '\\\1\2', 'g') as body from rows_
)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length(role) + length(body) + 15)::bigint as formatted_chars
from escaped group by conv_id
"""
