"""Chat formatting with loss masks that follow the offsets of one encoding.

A conversation is rendered whole and encoded once. The control strings are tokens
of their own, so no token reaches over a turn's end; the turns' spans and the
tokens' spans, both sorted, are intersected by binary search.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
FORMATTED = ("conv_id long, n_turns long, formatted string, ids binary, token_starts binary, "
             "token_ends binary, loss_mask binary")
_PLAIN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escaped(text: str) -> str:
    """No ``<|`` is left: one backslash more after each ``<`` that leads to a ``|``."""
    return _PLAIN.sub(r"<\\\1|", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray, np.ndarray]:
    """The conversation as one string, and the sorted spans of the assistant's texts in it."""
    parts, at, starts, ends = [], 0, [], []
    for role, text in turns:
        head, body = f"{TURN}{escaped(role)}{TEXT}", escaped(text)
        if role == "assistant":
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), np.array(starts, np.int64), np.array(ends, np.int64)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns back from the rendered string."""
    return [(unescaped(role), unescaped(text)) for role, text in
            (turn.split(TEXT, 1) for turn in (part[len(TURN):] for part in formatted.split(END)[:-1]))]


def mask_tokens(starts: np.ndarray, ends: np.ndarray, span_starts: np.ndarray, span_ends: np.ndarray) -> np.ndarray:
    """Which tokens lie in a span: the last span that begins at or before the token must reach its end."""
    if not len(span_starts):
        return np.zeros(len(starts), bool)
    span = np.searchsorted(span_starts, starts, "right") - 1
    return (span >= 0) & (ends <= span_ends[span]) & (ends > starts)


def loss_runs(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> list[str]:
    """The text under each unbroken run of the mask. Tokens that share a character overlap."""
    if not mask.any():
        return []
    breaks = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return [formatted[starts[a]:ends[b - 1]] for a, b in zip(breaks[::2], breaks[1::2])]


def chat_encoder(path: str):
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens([AddedToken(x, normalized=False) for x in (TURN, TEXT, END)])
    return tokenizer


def conversations(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[list[tuple]]:
    """Sorted turn rows as lists of up to ``size`` whole conversations (id, turns)."""
    done, current, turns = [], None, None
    for batch in batches:
        for conv_id, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
            if turns is None or conv_id != current:
                if turns is not None:
                    done.append((current, turns))
                    if len(done) >= size:
                        yield done
                        done = []
                current, turns = conv_id, []
            turns.append((role, text))
    if turns is not None:
        done.append((current, turns))
    if done:
        yield done


def format_chats(rows: DataFrame, tokenizer: str) -> DataFrame:
    """Render and encode every conversation of ``rows`` (conv_id, turn, role, text); one row each.

    ``ids``, ``token_starts`` and ``token_ends`` (code points of ``formatted``) are little-endian
    unsigned 32-bit, ``loss_mask`` has a byte per token, 1 in the assistant's texts.
    Turns go by turn, null turns first; ties by role, then text. Null roles and texts: empty.
    Null conv_ids form one conversation. Empty table: no rows. Other columns are ignored.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("ids", pa.binary()),
                        ("token_starts", pa.binary()), ("token_ends", pa.binary()), ("loss_mask", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core already
        encoder = chat_encoder(tokenizer)
        for chats in conversations(batches):
            out: dict[str, list] = {n: [] for n in schema.names}
            rendered = [render(turns) for _, turns in chats]
            for (conv_id, turns), (text, a, b), code in zip(
                    chats, rendered, encoder.encode_batch([r[0] for r in rendered], add_special_tokens=False)):
                spans = np.array(code.offsets, np.int64).reshape(-1, 2)
                mask = mask_tokens(spans[:, 0], spans[:, 1], a, b)
                for name, value in zip(schema.names, (
                        conv_id, len(turns), text, np.array(code.ids, "<u4").tobytes(), spans[:, 0].astype("<u4").tobytes(),
                        spans[:, 1].astype("<u4").tobytes(), mask.astype(np.uint8).tobytes())):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema)

    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    rows = rows.select(rows["conv_id"].cast("long").alias("conv_id"), "turn", *text)
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the loss mask, taken from the formatted rows alone."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                turns = parse(row["formatted"])
                starts, ends = (np.frombuffer(row[c], "<u4") for c in ("token_starts", "token_ends"))
                runs = loss_runs(row["formatted"], starts, ends, np.frombuffer(row["loss_mask"], np.uint8) > 0)
                loss = "".join(map(unescaped, runs))
                whole = "".join(f"{role}\n{text}\n" for role, text in turns)
                out.append((row["conv_id"], len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                            hashlib.sha256(loss.encode()).hexdigest(), len(row["formatted"])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6,
                                                (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))], names)

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                     "loss_sha256 string, formatted_chars long")


def trap(rows: DataFrame) -> DataFrame:
    """Conversation -1: texts that look like another template's control strings."""
    said = "</s>[INST] ok [/INST]"
    return rows.sparkSession.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                             "conv_id long, turn long, role string, text string")
