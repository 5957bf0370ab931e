"""Chat formatting: whole conversations, encoded once, with loss masks aligned by offsets."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
"""Fixed values: the marks around a turn's role and text; each is a token of its own."""
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
ESCAPED = re.compile(r"<\\(\\*)\|")
STEP = 64


def escape(text: Column) -> Column:
    """The text with a backslash more in each ``<|``, ``<\\|``, ``<\\\\|`` and so on. No mark and no other
    control string of the form ``<|...|>`` is left in it, and ``unescape`` gives the text back."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: f"<{m.group(1)}|", text)


def render(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv_id, formatted, turns) per conversation: its turns in order, each as start mark, role, middle mark,
    text, end mark; ``turns`` holds the length in code points of each role and text as rendered, and
    whether the assistant speaks.

    Turns are ordered by number (NULL first), then role and text, so ties and repeated rows always come out alike. A
    NULL role or text is empty. Rows without a conversation id are one conversation. A
    conversation is one row here, so the longest must fit in a task."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = df.select(F.col(f"`{conv_col}`").alias("conv_id"), F.struct(
        F.col(f"`{turn_col}`").alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(
            escape(t["role"]).alias("role"), escape(t["text"]).alias("text"),
            (t["role"] == "assistant").alias("learned"))).alias("t"))
    shown = F.array_join(F.transform("t", lambda t: F.concat(
        F.lit(START), t["role"], F.lit(MIDDLE), t["text"], F.lit(END))), "")
    return turns.select("conv_id", shown.alias("formatted"), F.transform("t", lambda t: F.struct(
        F.length(t["role"]).alias("role"), F.length(t["text"]).alias("text"),
        t["learned"].alias("learned"))).alias("turns"))


def text_spans(roles: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each turn's text starts and ends in the rendered conversation."""
    whole = len(START) + roles + len(MIDDLE) + texts + len(END)
    starts = np.cumsum(whole) - whole + len(START) + roles + len(MIDDLE)
    return starts, starts + texts


def covered(starts: np.ndarray, ends: np.ndarray, span_starts: np.ndarray, span_ends: np.ndarray) -> np.ndarray:
    """Which tokens [start, end) meet one of the sorted, disjoint spans: the first span that ends after
    the token's start is found by binary search."""
    if not len(span_starts):
        return np.zeros(len(starts), bool)
    k = np.searchsorted(span_ends, starts, side="right")
    inside = k < len(span_starts)
    return inside & (span_starts[np.minimum(k, len(span_starts) - 1)] < ends) & (starts < ends)


def tokenizer(spec: str):
    """A tokenizer from its JSON, with the three marks as tokens of their own (added after its last id)."""
    from tokenizers import AddedToken, Tokenizer

    own = Tokenizer.from_str(spec)
    own.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in (START, MIDDLE, END)])
    return own


def encode(rendered: DataFrame, tokenizer_path: str = TOKENIZER) -> DataFrame:
    """(conv_id, n_turns, formatted, input_ids, token_starts, token_ends, loss_mask): each conversation is
    encoded whole and once; offsets count code points of ``formatted``. The mask holds the tokens of assistant texts.
    Marks are tokens of their own, so no token lies across a text's border."""
    with open(tokenizer_path, encoding="utf-8") as f:  # a vocabulary of a few MB, sent to the tasks
        shared = rendered.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        own = tokenizer(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                texts, turns = part.column("formatted").to_pylist(), part.column("turns")
                bounds = np.concatenate([[0], np.cumsum(turns.value_lengths().to_numpy())])
                roles, said, learned = (x.to_numpy(zero_copy_only=False) for x in turns.flatten().flatten())
                ids, token_starts, token_ends, masks = [], [], [], []
                for k, e in enumerate(own.encode_batch(texts, add_special_tokens=False)):
                    offsets = np.array(e.offsets, np.int32).reshape(-1, 2)
                    mine = slice(bounds[k], bounds[k + 1])
                    starts, ends = text_spans(roles[mine], said[mine])
                    wanted = learned[mine].astype(bool) & (ends > starts)
                    ids.append(np.array(e.ids, np.int32))
                    token_starts.append(offsets[:, 0])
                    token_ends.append(offsets[:, 1])
                    masks.append(covered(offsets[:, 0], offsets[:, 1], starts[wanted], ends[wanted]))
                ints = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), pa.array(np.diff(bounds), pa.int64()), part.column("formatted"),
                     pa.array(ids, ints), pa.array(token_starts, ints), pa.array(token_ends, ints),
                     pa.array(masks, pa.list_(pa.bool_()))],
                    names=["conv_id", "n_turns", "formatted", "input_ids", "token_starts", "token_ends",
                           "loss_mask"])

    kind = rendered.schema["conv_id"].dataType.simpleString()
    return rendered.mapInArrow(run, f"conv_id {kind}, n_turns long, formatted string, input_ids array<int>, "
                                    "token_starts array<int>, token_ends array<int>, loss_mask array<boolean>")


def format_chats(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", tokenizer_path: str = TOKENIZER) -> DataFrame:
    """One row per conversation: its rendered text, token ids, their offsets and the loss mask (``render`` and
    ``encode`` say how). An empty table gives no rows; further columns are left out."""
    return encode(render(df, conv_col, turn_col, role_col, text_col), tokenizer_path)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) pairs that were rendered."""
    turns = [t.removeprefix(START).split(MIDDLE) for t in formatted.split(END)[:-1]]
    return [(unescape(role), unescape(text)) for role, text in turns]


def learned_text(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> str:
    """What the masked tokens cover, without escapes: each stretch of tokens without a gap, in order."""
    starts, ends = starts[mask], np.maximum.accumulate(ends[mask])
    if not len(starts):
        return ""
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    return "".join(unescape(formatted[a:b]) for a, b in zip(
        starts[new].tolist(), ends[np.append(new[1:], True)].tolist(), strict=True))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, formatted_chars) from the formatted conversations alone: the turns from the
    text, the text that is learned from offsets and mask."""
    turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                texts = part.column("formatted").to_pylist()
                told = [learned_text(t, *(x.values.to_numpy(zero_copy_only=False) for x in cells))
                        for t, *cells in zip(texts, *(part.column(c) for c in (
                            "token_starts", "token_ends", "loss_mask")), strict=True)]
                turns = [[{"role": r, "text": x} for r, x in parse(t)] for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), pa.array(turns, turn), pa.array(told, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    names=["conv_id", "turns", "loss_text", "formatted_chars"])

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.mapInArrow(run, f"conv_id {kind}, turns array<struct<role:string,text:string>>, "
                                     "loss_text string, formatted_chars long")
