"""Chat formatting by columnar byte assembly.

A batch of turns becomes one preallocated buffer: segment lengths give cumulative offsets, headers
are scattered to theirs, and the bytes of roles and texts move by computed indices.  Every turn
stays a row, so a conversation of any length is split over tasks; its formatted text is the
concatenation of its turns in order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Control strings of public chat templates.
CONTROLS = (
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>",
    "<|end|>", "<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)


@dataclass(frozen=True)
class Template:
    """How a turn is marked: start, role, a line break, text, end.

    A control string inside a role or text gets a backslash behind its first character, and so
    does one that has backslashes there already, which makes the way back exact.
    """

    start: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    trained: tuple[str, ...] = ("assistant",)
    controls: tuple[str, ...] = CONTROLS
    firsts: tuple[str, ...] = field(init=False, repr=False)
    found: re.Pattern = field(init=False, repr=False)
    escaped: re.Pattern = field(init=False, repr=False)

    def __post_init__(self):
        controls = dict.fromkeys((self.start.strip(), self.end.strip(), *self.controls))
        if any(len(c) < 2 or "\\" in c for c in controls):
            raise ValueError("a control string needs two characters and no backslash")
        if any(a in c[1:] for a in controls for c in controls):
            raise ValueError("a control string may not stand inside another one")
        firsts = sorted({c[0] for c in controls})
        tails = [[re.escape(c[1:]) for c in controls if c[0] == f] for f in firsts]
        starts = lambda mid: "|".join(
            rf"{re.escape(f)}{mid}(?={'|'.join(t)})" for f, t in zip(firsts, tails)
        )
        object.__setattr__(self, "firsts", tuple(firsts))
        object.__setattr__(self, "found", re.compile(starts(r"\\*")))
        object.__setattr__(self, "escaped", re.compile(starts(r"\\+")))

    def escape(self, text: str) -> str:
        return self.found.sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return self.escaped.sub(lambda m: m[0][:-1], text)

    def role_out(self, role: str) -> str:
        """On one line: backslashes and line breaks are spelled out before control strings."""
        return self.escape(role.replace("\\", "\\\\").replace("\n", "\\n"))

    def role_back(self, role: str) -> str:
        return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], self.unescape(role))

    def read(self, turn: str) -> tuple[str, str]:
        """(role, text) of one formatted turn."""
        if not (turn.startswith(self.start) and turn.endswith(self.end)):
            raise ValueError("not a formatted turn")
        role, _, text = turn[len(self.start) : len(turn) - len(self.end)].partition("\n")
        return self.role_back(role), self.unescape(text)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The data and the n + 1 offsets of an array without nulls."""
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def _changed(texts: pa.Array, odd: str, change) -> pa.Array:
    """change(text) for the rows where the regex `odd` is found; nulls become empty."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    found = pc.match_substring_regex(texts, odd)
    rows = np.flatnonzero(found.to_numpy(zero_copy_only=False))
    if not len(rows):
        return texts
    made = pa.array([change(texts[i].as_py()) for i in rows.tolist()], pa.string())
    return pc.replace_with_mask(texts, found, made)


def assemble(roles: pa.Array, texts: pa.Array, template: Template) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Formatted turns (large_string) with the first byte of each text and the one behind it."""
    firsts = "".join(re.escape(f) for f in template.firsts)
    role_data, role_at = _bytes_of(_changed(roles, rf"[\\\n{firsts}]", template.role_out))
    text_data, text_at = _bytes_of(_changed(texts, f"[{firsts}]", template.escape))
    start, mid, end = (np.frombuffer(x.encode(), np.uint8) for x in (template.start, "\n", template.end))
    role_len, text_len = np.diff(role_at), np.diff(text_at)
    at = np.concatenate([[0], np.cumsum(role_len + text_len + len(start) + len(mid) + len(end))])
    out = np.empty(int(at[-1]), np.uint8)
    role_to = at[:-1] + len(start)
    text_to = role_to + role_len + len(mid)
    for fixed, to in ((start, at[:-1]), (mid, role_to + role_len), (end, text_to + text_len)):
        out[to[:, None] + np.arange(len(fixed))] = fixed
    for data, come, size, to in (
        (role_data, role_at[:-1], role_len, role_to),
        (text_data, text_at[:-1], text_len, text_to),
    ):
        out[np.arange(len(data)) + np.repeat(to - come, size)] = data
    turns = pa.LargeStringArray.from_buffers(len(role_len), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(out))
    first = text_to - at[:-1]
    return turns, pa.array(first, pa.int64()), pa.array(first + text_len, pa.int64())


def format_turns(
    turns: DataFrame,
    template: Template = Template(),
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(<conv_col>, <turn_col>, formatted, loss_start, loss_end), one row per turn.

    loss_start and loss_end are the bytes of `formatted` under the loss mask: the text of a trained
    role, else both null.  Null roles and texts are empty; null ids stay; repeated rows stay;
    other columns are left out; no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            formatted, first, last = assemble(batch.column(2), batch.column(3), template)
            trained = pc.is_in(batch.column(2), pa.array(template.trained, batch.column(2).type))
            none = pa.scalar(None, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    formatted.cast(pa.string()),
                    pc.if_else(trained, first, none),
                    pc.if_else(trained, last, none),
                ],
                names=["conv", "turn", "formatted", "loss_start", "loss_end"],
            )

    kinds = [turns.schema[c].dataType.simpleString() for c in (conv_col, turn_col)]
    pick = turns.select(
        turns[conv_col].alias("conv"),
        turns[turn_col].alias("turn"),
        turns[role_col].cast("string").alias("role"),
        turns[text_col].cast("string").alias("text"),
    )
    schema = f"conv {kinds[0]}, turn {kinds[1]}, formatted string, loss_start bigint, loss_end bigint"
    out = pick.mapInArrow(run, schema)
    return out.withColumnsRenamed({"conv": conv_col, "turn": turn_col})


def read_back(
    formatted: DataFrame,
    template: Template = Template(),
    conv_col: str = "conv_id",
    turn_col: str = "turn",
) -> DataFrame:
    """Per conversation, from the output alone: <conv_col>, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars.

    Turns are read in order (ties by their formatted text) and folded into running digests, so a
    task holds one batch however long a conversation is.  A null id is a conversation of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        state, current = None, None
        kind = None

        def row(conv, s):
            values = [conv, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4]]
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return [pa.array([v], k) for v, k in zip(values, kinds)]

        for batch in batches:
            done, kind = [], batch.column(0).type
            columns = [c.to_pylist() for c in batch.columns]
            for conv, turn, first, last in zip(*columns):
                if state is None or conv != current:
                    if state is not None:
                        done.append(row(current, state))
                    state, current = [0, hashlib.sha256(), 0, hashlib.sha256(), 0], conv
                role, text = template.read(turn)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[4] += len(turn)
                if first is not None:
                    learned = template.unescape(turn.encode()[first:last].decode())
                    state[2] += len(learned)
                    state[3].update(learned.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*done)], names=names)
        if state is not None:
            yield pa.RecordBatch.from_arrays(row(current, state), names=names)

    ordered = formatted.repartition(F.col(conv_col)).sortWithinPartitions(
        F.col(conv_col), F.col(turn_col), F.col("formatted")
    )
    pick = ordered.select(F.col(conv_col).alias("conv"), "formatted", "loss_start", "loss_end")
    kind = formatted.schema[conv_col].dataType.simpleString()
    return pick.mapInArrow(
        run,
        f"conv {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint",
    ).withColumnRenamed("conv", conv_col)
