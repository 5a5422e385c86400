"""Chat formatting from an event log.

A log row is (conv_id, seq, kind, message, role, text). Kinds: ``message`` opens a message with its first text,
``delta`` appends to it, ``edit`` replaces its text, ``regenerate`` clears it for new deltas and drops the
messages after it that were opened before. Folding is by message first and by conversation only for the narrow
"dropped" rule, so that one busy conversation is spread over its messages. Rendering gives one segment a
message; a conversation's output is its segments in order, never held whole by a task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Turn marks of the template, and the control strings that texts may not show unescaped.
OPEN, CLOSE = "<|turn|>", "<|end|>"
CONTROL = (OPEN, CLOSE, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: Put inside a control string when a text holds one; itself doubled in texts.
ESCAPE = "\\"

_SPECIAL = re.compile("|".join(re.escape(x) for x in (*CONTROL, ESCAPE)))
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """Reversible; the result holds no control string, as each one is broken after its first character."""
    return _SPECIAL.sub(lambda m: ESCAPE * 2 if m[0] == ESCAPE else f"{m[0][0]}{ESCAPE}{m[0][1]}{m[0][2:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def fold_events(log: DataFrame) -> DataFrame:
    """Final messages of each conversation: (conv_id, message, opened, role, text).

    Nulls: a null text is empty, a null seq comes first, a null role is ''. Ties in ``seq`` are ordered by kind and
    text. Events for a message that was never opened start it with an empty role. Empty logs give no rows.
    """
    reset = F.col("kind").isin("message", "edit", "regenerate")
    by_message = Window.partitionBy("conv_id", "message")
    live = (
        log.select("conv_id", "message", F.coalesce("seq", F.lit(-(1 << 62))).alias("seq"), "kind", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("last_reset", F.max(F.when(reset, F.col("seq"))).over(by_message))
    )
    kept = (F.col("last_reset").isNull()) | (F.col("seq") >= F.col("last_reset"))
    messages = live.groupBy("conv_id", "message").agg(
        F.min("seq").alias("opened"), F.max("role").alias("role"), F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("redone"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(kept & (F.col("kind") != "regenerate"), F.struct("seq", F.when(reset, 0).otherwise(1).alias("rank"), "text")))), lambda e: e["text"]), "").alias("text"),
    )
    # Regenerations drop messages: found on rows without text, of the conversations that have any, and taken away after.
    messages = Scratch(log.sparkSession, "chat").keep("messages", messages)
    narrow = messages.select("conv_id", "message", "opened", "redone")
    redone = narrow.filter("redone is not null").select(F.col("conv_id").alias("busy")).distinct()
    earlier = Window.partitionBy("conv_id").orderBy("opened", "message").rowsBetween(Window.unboundedPreceding, -1)
    cut = narrow.join(redone, F.col("conv_id").eqNullSafe(F.col("busy")), "left_semi").withColumn("cut", F.max("redone").over(earlier))
    gone = cut.filter("opened <= cut").select(F.col("conv_id").alias("gone_conv"), F.col("message").alias("gone_message"))
    kept = messages.join(gone, F.col("conv_id").eqNullSafe(F.col("gone_conv")) & F.col("message").eqNullSafe(F.col("gone_message")), "left_anti")
    return kept.select("conv_id", "message", "opened", "role", "text")


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pydict()
        segments, start, end = [], [], []
        for role, text in zip(rows["role"], rows["text"], strict=True):
            head = f"{OPEN}{escape(role).replace(chr(10), ESCAPE + chr(10))}\n"
            body = escape(text)
            segments.append(head + body + CLOSE)
            start.append(len(head) if role == "assistant" else None)
            end.append(len(head) + len(body) if role == "assistant" else None)
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), pa.array(segments, pa.string()), pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=["conv_id", "part", "segment", "loss_from", "loss_to"])


def render(messages: DataFrame) -> DataFrame:
    """A segment a message: (conv_id, part, segment, loss_from, loss_to), the offsets in code points of the segment.

    ``part`` orders a conversation's segments. Assistant texts are under the loss mask; marks and roles never are.
    """
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("opened", "message").alias("part"), "role", "text")
    part = rows.schema["part"].dataType.simpleString()
    return rows.mapInArrow(_render, f"conv_id long, part {part}, segment string, loss_from long, loss_to long")


_SEGMENT = re.compile(re.escape(OPEN) + r"((?:[^\\\n]|\\.)*)\n(.*)" + re.escape(CLOSE), re.S)


class _Reader:
    """Reads one conversation's segments back, keeping only digests and counts."""

    def __init__(self) -> None:
        self.turns, self.loss, self.n, self.loss_chars, self.chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def add(self, segment: str, start: int | None, end: int | None) -> None:
        m = _SEGMENT.fullmatch(segment)
        self.turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
        self.n += 1
        self.chars += len(segment)
        if start is not None:
            kept = unescape(segment[start:end])
            self.loss.update(kept.encode())
            self.loss_chars += len(kept)


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by conversation and order in, a row a conversation out; a conversation may span batches."""
    now, reader, done = None, None, []

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_pylist([dict(zip(_DIGEST.names, x, strict=True)) for x in done], schema=_DIGEST)
        done.clear()
        return out

    def close() -> None:
        if reader is not None:
            done.append((now, reader.n, reader.turns.hexdigest(), reader.loss_chars, reader.loss.hexdigest(), reader.chars))

    for batch in batches:
        rows = batch.to_pydict()
        for conv, segment, start, end in zip(rows["conv_id"], rows["segment"], rows["loss_from"], rows["loss_to"], strict=True):
            if reader is None or conv != now:
                close()
                now, reader = conv, _Reader()
            reader.add(segment, start, end)
        if done:
            yield flush()
    close()
    if done:
        yield flush()


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of each conversation, parsed from its formatted output."""
    dealt = segments.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return dealt.select("conv_id", "segment", "loss_from", "loss_to").mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def conversation_log(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as events: each row opens a message and streams its text as a delta.

    Rows that repeat a turn stay messages of their own, ordered by role and text.
    """
    again = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("message", F.struct(F.coalesce("turn", F.lit(-(1 << 40))).alias("turn"), again.alias("again")))
    seq = F.col("message.turn") * 2
    events = F.array(F.struct(seq.alias("seq"), F.lit("message").alias("kind"), F.lit("").alias("text")), F.struct((seq + 1).alias("seq"), F.lit("delta").alias("kind"), F.col("text").alias("text")))
    return rows.select("conv_id", "message", "role", F.inline(events))


def chat_digest(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    both = conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
    return read_back(render(fold_events(conversation_log(both))))
