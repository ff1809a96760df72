"""Chat formatting: whole conversations as one text, its tokens, and the loss mask over them.

A conversation is rendered once and encoded once with offsets. The places of the turns'
texts in the rendering are known and sorted, so a binary search in the sorted token offsets
gives the tokens of each turn. Markers are special tokens of the tokenizer, so no token
crosses the end of a text.

Control strings (the markers and `reserved` ones) inside roles and texts get a backslash
after their first character; the same string with one backslash gets a second, and so on.
Taking one away is the exact inverse.

Defined cases: turns are ordered by turn (null first), then role, then text; null texts and
roles are empty; turns without a conversation id form one conversation; repeated rows are
turns of their own; an empty table gives an empty result. Other columns are ignored. A
conversation is one text and so is made in one task, like any document.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT = (
    "formatted string, spans array<struct<start:int,end:int,role:string>>, ids array<int>, "
    "starts array<int>, ends array<int>, loss array<boolean>"
)


@dataclass(frozen=True)
class Template:
    turn: str = "<|turn|>"
    text: str = "<|text|>"
    end: str = "<|end|>"
    reserved: tuple[str, ...] = ("<|endoftext|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    loss_roles: tuple[str, ...] = ("assistant",)

    def control(self) -> re.Pattern:
        """The first character of each control string, where the rest of it follows, with any
        backslashes in between."""
        strings = (self.turn, self.text, self.end, *self.reserved)
        if any(len(s) < 2 or "\\" in s for s in strings):
            raise ValueError("control strings have two characters at least and no backslash")
        return re.compile("|".join(f"{re.escape(s[0])}(?=\\\\*{re.escape(s[1:])})" for s in strings))

    def inverse(self) -> re.Pattern:
        strings = (self.turn, self.text, self.end, *self.reserved)
        return re.compile("|".join(f"(?<={re.escape(s[0])})\\\\(?=\\\\*{re.escape(s[1:])})" for s in strings))


class Formatter:
    """What a task needs: the tokenizer with the markers, and the template's patterns."""

    def __init__(self, path: str, template: Template):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import AddedToken, Tokenizer

        self.template = template
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        marks = (template.turn, template.text, template.end)
        self.tokenizer.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in marks])
        self.control, self.inverse = template.control(), template.inverse()

    def escape(self, text: str) -> str:
        return self.control.sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return self.inverse.sub("", text)

    def render(self, turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
        """The rendering and the place of each text in it."""
        t, parts, spans, at = self.template, [], [], 0
        for role, text in turns:
            head, body = f"{t.turn}{self.escape(role)}{t.text}", self.escape(text)
            parts += [head, body, t.end]
            spans.append((at + len(head), at + len(head) + len(body)))
            at += len(head) + len(body) + len(t.end)
        return "".join(parts), spans

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """The turns of a rendering."""
        t, out = self.template, []
        for piece in formatted.split(t.turn)[1:]:
            role, _, rest = piece.partition(t.text)
            out.append((self.unescape(role), self.unescape(rest.removesuffix(t.end))))
        return out

    def masked(self, formatted: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> list[str]:
        """The unescaped text of each run of tokens under the mask."""
        edges = np.flatnonzero(np.diff(np.concatenate(([False], loss, [False])).astype(np.int8)))
        return [self.unescape(formatted[starts[a] : ends[b - 1]]) for a, b in zip(edges[::2], edges[1::2])]


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """True for the tokens that lie within a span; both are sorted."""
    mask = np.zeros(len(starts), dtype=bool)
    if spans and len(starts):
        first = np.searchsorted(starts, [s for s, _ in spans], "left")
        last = np.searchsorted(ends, [e for _, e in spans], "right")
        for a, b in zip(first, last):
            mask[a:b] = True
    return mask


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def _encoder(path: str, template: Template, key: str):
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("role", pa.string())]))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Formatter(path, template)
        for batch in batches:
            turns = batch.column("turns").to_pylist()
            for at in range(0, len(turns), 256):
                part = [[(t["role"] or "", t["text"] or "") for t in conv] for conv in turns[at : at + 256]]
                made = [own.render(conv) for conv in part]
                coded = own.tokenizer.encode_batch([m[0] for m in made], add_special_tokens=False)
                ids, starts, ends, loss = [], [], [], []
                for conv, (_, spans), code in zip(part, made, coded):
                    places = np.array(code.offsets, dtype=np.int32).reshape(-1, 2)
                    ids.append(np.array(code.ids, dtype=np.int32))
                    starts.append(places[:, 0])
                    ends.append(places[:, 1])
                    wanted = [s for s, (role, _) in zip(spans, conv) if role in template.loss_roles]
                    loss.append(loss_mask(places[:, 0], places[:, 1], wanted))
                roles = [
                    [{"start": s, "end": e, "role": r} for (s, e), (r, _) in zip(m[1], conv)] for m, conv in zip(made, part)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key).slice(at, len(part)),
                        pa.array([m[0] for m in made], pa.string()),
                        pa.array(roles, span),
                        *(_lists(x, pa.int32()) for x in (ids, starts, ends)),
                        _lists(loss, pa.bool_()),
                    ],
                    [key, "formatted", "spans", "ids", "starts", "ends", "loss"],
                )

    return encode


def format_conversations(
    turns: DataFrame, tokenizer: str, template: Template = Template(),
    conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per conversation: its id and RESULT. `tokenizer` is a file of the tokenizers
    library whose pre-tokenizer keeps every character (byte-level BPE does)."""
    template.control()
    one = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    whole = turns.groupBy(F.col(conv).alias(conv)).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    kind = turns.schema[conv].dataType.simpleString()
    return whole.mapInArrow(_encoder(tokenizer, template, conv), f"`{conv}` {kind}, {RESULT}")
