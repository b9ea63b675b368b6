"""Chat formatting by a template that is only called, never looked into.

A template is a function from a list of (role, text) to a string. Rendering the
first 1, 2, ... turns and comparing each output with the one before gives each turn's
span: the part that is new. Where an output does not go on from the one before, the
template rewrites history, and no span can be trusted. The text inside a turn's
span lies between what two renderings with other texts in its place have in common.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

CONTROLS = re.compile(r"(\\*)(\[/?INST\]|\[/?TURN\]|</?s>)")
ESCAPED = re.compile(r"\\(\\*)(\[/?INST\]|\[/?TURN\]|</?s>)")


def escape(text: str) -> str:
    """One backslash more before each control string; `unescape` takes it away again."""
    return CONTROLS.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2", text)


def inst_template(turns: list[Turn]) -> str:
    """User turns in [INST], assistant turns up to </s>, turns of any other role in [TURN] with the role's name."""
    out = []
    for role, text in turns:
        if role == "user":
            out.append(f"[INST] {escape(text)} [/INST]")
        elif role == "assistant":
            out.append(f" {escape(text)} </s>")
        else:
            name = escape(role.replace("\\", "\\\\").replace("\n", "\\n"))
            out.append(f"[TURN] {name}\n{escape(text)} [/TURN]")
    return "".join(out)


def read_back(text: str) -> list[Turn]:
    """The turns that `inst_template` wrote."""
    turns, at = [], 0
    marks = (("[INST] ", " [/INST]", "user"), ("[TURN] ", " [/TURN]", None), (" ", " </s>", "assistant"))
    while at < len(text):
        begin, end, role = next(m for m in marks if text.startswith(m[0], at))
        stop = text.index(end, at + len(begin))
        inner = text[at + len(begin) : stop]
        at = stop + len(end)
        if role is None:
            name, _, inner = inner.partition("\n")
            role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(name))
        turns.append((role, unescape(inner)))
    return turns


def spans(turns: list[Turn], template: Template, loss_role: str = "assistant") -> tuple[str, list[int], list[tuple[int, int]], int | None]:
    """(output, where each turn begins, spans under the loss mask, first turn whose rendering rewrites earlier output).

    When a template rewrites history, there are no spans at all.
    """
    text, begins, masks, rewritten = template([]) if not turns else "", [], [], None
    for i, (role, _) in enumerate(turns):
        longer = template(turns[: i + 1])
        if rewritten is None and not longer.startswith(text):
            rewritten = i
        if rewritten is None:
            begins.append(len(text))
            if role == loss_role:
                probes = [template([*turns[:i], (role, probe)])[len(text) :] for probe in ("a", "b")]
                head = len(os.path.commonprefix(probes))
                tail = len(os.path.commonprefix([p[:head:-1] for p in probes]))
                masks.append((len(text) + head, len(longer) - tail))
        text = longer
    return (text, begins, masks, None) if rewritten is None else (text, [], [], rewritten)


def format_chats(conversations: DataFrame, template: Template = inst_template, loss_role: str = "assistant") -> DataFrame:
    """Each conversation as one text: (conv_id, n_turns, formatted, turn_starts, loss_spans, rewritten_at).

    Rows are turns, in the order of `turn` (null first), then role and text. A null text or
    role is empty; a null conv_id is one conversation; repeated rows are turns of their own;
    other columns are ignored; an empty table gives an empty one. Offsets are code points.
    A conversation is rendered whole, as a template demands; no task holds two at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, turns in zip(batch.column("conv_id").to_pylist(), batch.column("turns")):
                listed = [(t["role"], t["text"]) for t in turns.as_py()]
                text, begins, masks, rewritten = spans(listed, template, loss_role)
                row = {"conv_id": conv, "n_turns": len(listed), "formatted": text, "turn_starts": begins,
                       "loss_spans": [{"start": a, "end": b} for a, b in masks], "rewritten_at": rewritten}
                yield pa.RecordBatch.from_pylist([row], schema=out)

    id_type = conversations.schema["conv_id"].dataType
    out = pa.schema(
        [("conv_id", {"bigint": pa.int64(), "int": pa.int32()}.get(id_type.simpleString(), pa.string())), ("n_turns", pa.int64()), ("formatted", pa.string()),
         ("turn_starts", pa.list_(pa.int64())), ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("rewritten_at", pa.int32())]
    )
    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", empty("role"), empty("text")))).alias("turns"))
    return turns.mapInArrow(
        run,
        f"conv_id {id_type.simpleString()}, n_turns long, formatted string, turn_starts array<bigint>, "
        "loss_spans array<struct<start: bigint, end: bigint>>, rewritten_at int",
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What `inst_template` outputs hold, read back from them: turns and the text under the loss mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, masks in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist()):
                turns = read_back(text)
                loss = "".join(unescape(text[m["start"] : m["end"]]) for m in masks)
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
                rows.append((len(turns), sha(whole), len(loss), sha(loss), len(text)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            if not rows:
                continue
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *[pa.array(x, k) for x, k in zip(zip(*rows), kinds)]],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    kind = formatted.schema["conv_id"].dataType.simpleString()
    lean = formatted.select("conv_id", "formatted", "loss_spans")
    return lean.mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
