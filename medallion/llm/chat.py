r"""Chat formatting by columnar byte assembly.

Each turn becomes ``<|im_start|>role\ntext<|im_end|>\n``. Inside roles and
texts every ``<``, backslashes, ``|`` gets one more backslash, so no text can
hold a control string and taking one backslash away restores it; roles also
write ``\`` as ``\\`` and a line feed as ``\n``.

Turns are dealt by conversation and sorted; an Arrow batch is then formatted
as a whole: segment lengths, cumulative offsets and scatter indices are numpy
arrays and all headers and contents are copied into one buffer. A
conversation that goes on in the next batch continues as its next piece, so
no conversation has to fit in memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import staged
from medallion.llm.words import buffers, slices

OPEN, BREAK, CLOSE = b"<|im_start|>", b"\n", b"<|im_end|>\n"
_CONST = np.frombuffer(OPEN + BREAK + CLOSE, np.uint8)
LEARNED_ROLE = "assistant"
PIECES = "conv_id {kind}, piece long, n_turns int, formatted string, loss_spans array<long>"


def escape(column: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(column, r"<(\\*)\|", r"<\\\1|")


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text) if "<\\" in text else text


def escape_role(column: pa.Array) -> pa.Array:
    plain = pc.replace_substring(pc.replace_substring(column, "\\", "\\\\"), "\n", "\\n")
    return escape(plain)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, turn offsets, start of each text) of the turns, in order."""
    role_data, role_at = buffers(roles)
    text_data, text_at = buffers(texts)
    source = np.concatenate([_CONST, role_data, text_data])
    n, a, b = len(roles), len(OPEN), len(BREAK)
    start, length = np.zeros((n, 5), np.int64), np.zeros((n, 5), np.int64)
    start[:, 0], length[:, 0] = 0, a
    start[:, 1], length[:, 1] = len(_CONST) + role_at[:-1], np.diff(role_at)
    start[:, 2], length[:, 2] = a, b
    start[:, 3], length[:, 3] = len(_CONST) + len(role_data) + text_at[:-1], np.diff(text_at)
    start[:, 4], length[:, 4] = a + b, len(CLOSE)
    flat = length.ravel()
    out_at = np.concatenate([[0], np.cumsum(flat)])
    index = np.repeat(start.ravel() - out_at[:-1], flat) + np.arange(out_at[-1])
    return source[index], out_at[::5], out_at[3:-1:5]


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before, piece = object(), -1
    for batch in batches:
        ids, roles, texts = batch.column(0), batch.column(1), escape(batch.column(2))
        learned = np.asarray(pc.equal(roles, LEARNED_ROLE))
        roles = escape_role(roles)
        for i, j, *_ in slices(texts):
            own = ids.slice(i, j - i)
            keys = own.to_pylist()
            data, at, text_at = assemble(roles.slice(i, j - i), texts.slice(i, j - i))
            text_end = at[1:] - len(CLOSE)
            cut = [0, *[k for k in range(1, len(keys)) if keys[k] != keys[k - 1]], len(keys)]
            pieces, spans = [], []
            for lo, hi in zip(cut, cut[1:], strict=False):
                piece = piece + 1 if keys[lo] == before else 0
                before = keys[lo]
                pieces.append(piece)
                marked = np.flatnonzero(learned[i + lo : i + hi]) + lo
                spans.append((np.stack([text_at[marked], text_end[marked]], 1) - at[lo]).ravel())
            bounds = at[cut]
            formatted = pa.Array.from_buffers(
                pa.large_string(), len(pieces), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)]
            )
            yield pa.RecordBatch.from_arrays(
                [own.take(pa.array(cut[:-1])), pa.array(pieces, pa.int64()), pa.array(np.diff(cut), pa.int32()),
                 formatted.cast(pa.string()), pa.array(spans, pa.list_(pa.int64()))],
                names=["conv_id", "piece", "n_turns", "formatted", "loss_spans"],
            )


def format_chats(turns: DataFrame) -> DataFrame:
    """Formatted pieces of the conversations in (conv_id, turn, role, text).

    Columns: conv_id, piece (0, 1, ... inside a conversation), n_turns,
    formatted, loss_spans (byte start and end, in the piece, of every text
    that the model learns from). Null roles and texts are empty; null
    conversation ids are one conversation; equal turn numbers are ordered by
    role and text, null turns come first, and repeated rows are repeated
    turns. An empty table gives no rows; other columns are not read.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    kind = rows.schema["conv_id"].dataType.simpleString()
    ordered = rows.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_format, PIECES.format(kind=kind))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    state: list | None = None

    def row(s: list) -> pa.RecordBatch:
        key, n, turns, chars, loss, total = s
        values = [key, n, turns.hexdigest(), chars, loss.hexdigest(), total]
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

    for batch in batches:
        kind = batch.schema.field(0).type
        done = []
        for key, formatted, spans in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if state is None or state[0] != key:
                if state is not None:
                    done.append(row(state))
                state = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[5] += len(formatted)
            for turn in formatted.split(CLOSE.decode())[:-1]:
                role, text = turn[len(OPEN):].split("\n", 1)
                state[1] += 1
                state[2].update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
            data = formatted.encode()
            for lo, hi in zip(spans[::2], spans[1::2], strict=True):
                learned = unescape(data[lo:hi].decode())
                state[3] += len(learned)
                state[4].update(learned.encode())
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
    if state is not None:
        yield row(state)


def chat_digests(pieces: DataFrame) -> DataFrame:
    """What a reader gets back from formatted pieces, per conversation.

    conv_id, n_turns, turns_sha256 (role, line feed, text, line feed per
    turn), loss_chars and loss_sha256 (of the texts under the loss mask),
    formatted_chars. Read in order, a piece at a time.
    """
    kind = pieces.schema["conv_id"].dataType.simpleString()
    ordered = pieces.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "piece")
    return ordered.select("conv_id", "formatted", "loss_spans").mapInArrow(
        _read,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def format_and_read(turns: DataFrame) -> DataFrame:
    """Write the formatted conversations, read them back and digest them."""
    return chat_digests(staged(format_chats(turns), "chats"))
