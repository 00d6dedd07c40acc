"""Chat formatting with offset-aligned loss masks.

A turn is rendered as ``<s>role[INST]text[/INST]`` and a conversation ends with ``</s>``.  A control
string inside a role or text gets a backslash after its first character (one more if it has some), so
``[INST]`` becomes ``[\\INST]`` and ``[\\INST]`` becomes ``[\\\\INST]``; taking one away gives the text back.

Each conversation is rendered whole and encoded once, with the offsets of its tokens.  The spans of the
turns that carry loss and the spans of the tokens are both sorted, so binary search gives the tokens that
overlap a turn: those form the mask.  Control strings are tokens of their own, hence no token reaches
over the edge of a turn.

The tokenizer is a file of the ``tokenizers`` library whose path is a parameter; a task opens it once.

Defined results: turns are sorted by turn (null first), then role and text; repeated rows are turns of
their own.  Null roles and texts are empty.  Rows with a null conv_id form one conversation.  A
conversation is the unit that is encoded, so the longest one must fit a task.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
TURN, TEXT, END_TURN, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROLS = (TURN, TEXT, END_TURN, END)
_RAW = re.compile(r"(<(?=\\*(?:/?s>|\|endoftext\|>))|\[(?=\\*/?INST\]))(\\*)")
_ESCAPED = re.compile(r"(<(?=\\+(?:/?s>|\|endoftext\|>))|\[(?=\\+/?INST\]))\\")
_ONE_TURN = re.compile(r"<s>(.*?)\[INST\](.*?)\[/INST\]", re.S)

_OUT = pa.schema([("conv_id", pa.int64()), ("text", pa.string()), ("tokens", pa.list_(pa.int32())),
                  ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
                  ("loss", pa.list_(pa.bool_()))])
FORMATTED = ("conv_id long, text string, tokens array<int>, starts array<int>, ends array<int>, "
             "loss array<boolean>")


def escape(text: str) -> str:
    return _RAW.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: Sequence[tuple[str, str]], loss_roles=("assistant",)) -> tuple[str, np.ndarray]:
    """The conversation's text and the [begin, end) spans of the texts that carry loss."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role in loss_roles:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END_TURN]
        at += len(head) + len(body) + len(END_TURN)
    return "".join(parts) + END, np.array(spans, np.int64).reshape(-1, 2)


def loss_mask(spans: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which tokens overlap a span; spans are sorted and disjoint, token starts and ends are sorted."""
    mark = np.zeros(len(starts) + 1, np.int64)
    filled = spans[spans[:, 0] < spans[:, 1]]
    first = np.searchsorted(ends, filled[:, 0], "right")   # the first token that ends beyond the begin
    last = np.searchsorted(starts, filled[:, 1], "left")    # the first token that starts at the end
    np.add.at(mark, first, 1)
    np.add.at(mark, last, -1)
    return np.cumsum(mark[:-1]) > 0


def masked_text(text: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> str:
    """All text under the mask, in order; neighbours that share a character give it once.

    Masked tokens that touch or overlap form a run, and each run is one slice of the text.
    """
    begin, end = starts[loss], np.maximum.accumulate(ends[loss])
    if not len(begin):
        return ""
    first = np.concatenate(([0], np.flatnonzero(begin[1:] > end[:-1]) + 1))
    last = np.append(first[1:], len(begin)) - 1
    return "".join(text[i:j] for i, j in zip(begin[first].tolist(), end[last].tolist()))


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a rendered conversation."""
    return [(unescape(r), unescape(t)) for r, t in _ONE_TURN.findall(text)]


def open_tokenizer(path: str):
    """The tokenizer with the control strings as tokens; strings that texts hold stay ordinary, as
    rendering has escaped them."""
    from tokenizers import AddedToken, Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    t = Tokenizer.from_file(path)
    t.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in CONTROLS])
    return t


def _format(path: str, loss_roles):
    def run(batches: Iterator[pa.RecordBatch]):
        tokenizer = open_tokenizer(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                made = [render([(t["role"], t["text"]) for t in turns], loss_roles)
                        for turns in part.column(1).to_pylist()]
                codes = tokenizer.encode_batch([m[0] for m in made], add_special_tokens=False)
                starts, ends, loss = [], [], []
                for (_, spans), code in zip(made, codes):
                    offsets = np.array(code.offsets, np.int64).reshape(-1, 2)
                    starts.append(offsets[:, 0].astype(np.int32))
                    ends.append(offsets[:, 1].astype(np.int32))
                    loss.append(loss_mask(spans, offsets[:, 0], offsets[:, 1]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([m[0] for m in made]),
                     *[pa.array(x, t.type) for x, t in zip(([c.ids for c in codes], starts, ends, loss), list(_OUT)[2:])]],
                    schema=_OUT)
    return run


def chat_format(conversations: DataFrame, tokenizer: str = TOKENIZER, loss_roles=("assistant",)) -> DataFrame:
    """(conv_id, text, tokens, starts, ends, loss) of each conversation: the rendered text, its tokens
    with their character spans, and which of them carry loss."""
    empty = F.lit("")
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    narrow = whole.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"], t["text"])).alias("turns"))
    return in_arrow(narrow, _format(tokenizer, tuple(loss_roles)), FORMATTED)


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists as one array, and where each list begins."""
    return lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()


def _read_back(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        tokens = [_flat(batch.column(c)) for c in ("starts", "ends", "loss")]
        rows = []
        for i, (conv, text) in enumerate(zip(batch.column("conv_id").to_pylist(), batch.column("text").to_pylist())):
            turns = parse(text)
            loss = unescape(masked_text(text, *[values[at[i]:at[i + 1]] for values, at in tokens]))
            rows.append({"conv_id": conv, "n_turns": len(turns),
                         "turns_sha256": _sha("".join(f"{a}\n{b}\n" for a, b in turns)),
                         "loss_chars": len(loss), "loss_sha256": _sha(loss), "formatted_chars": len(text)})
        yield pa.RecordBatch.from_pylist(rows, schema=_DIGEST)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted rows hold: the turns parsed from the text, and the text under the mask."""
    return in_arrow(formatted.select("conv_id", "text", "starts", "ends", "loss"), _read_back, DIGEST)
