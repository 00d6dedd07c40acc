"""Whole texts encoded through their distinct words.

Words repeat, and a tokenizer is much slower than a hash table, so a batch of texts is cut into words, each
distinct word is encoded once, and the texts' ids are put together from the words' ids.  The result is that
of encoding each text as a whole, as cuts are only made where neither kind of tokenizer can join anything:

* before a space or line feed that follows a character which is surely no white space.  The byte-level
  tokenizer's pattern always ends a part there.  Pieces of the other kind have their space mark only in front
  (:func:`piece_table` makes sure), so there a cut before a space (not a line feed) is as safe.
* ``fine``, for the byte-level tokenizer alone: also between a letter and ASCII punctuation.

Cuts are found in the UTF-8 bytes of a whole batch with numpy; Arrow's dictionary encoding finds the distinct words.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
_BLOCK = 500


def tokenizer_path(name: str) -> str:
    """The file of a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


# Kinds of bytes: 1 ASCII letters, 2 other visible ASCII, 3 digits, 4 continuation bytes, 5 the first byte of a
# two-byte character from U+00C0 (no white space there), 6 those of them that begin a letter, 8 space, 9 line feed.
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = 2
_KIND[0x30:0x3A] = 3
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = 1
_KIND[0x80:0xC0] = 4
_KIND[0xC3:0xE0] = 5
_KIND[0xD0:0xD2] = 6
_KIND[0x20], _KIND[0x0A] = 8, 9


@dataclass
class Words:
    """``codes`` of all words in order; text ``i`` has those from ``first[i]`` to ``first[i + 1]``; ``distinct``
    holds the words themselves (large_string)."""

    codes: np.ndarray
    first: np.ndarray
    distinct: pa.Array


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Buffer]:
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2] or pa.py_buffer(b"")
    return ends, np.frombuffer(data, np.uint8), data


def cut(texts: pa.Array, fine: bool = False, whole: np.ndarray | None = None) -> Words:
    """The words of a ``large_string`` array without nulls.  Texts marked in ``whole`` stay one word."""
    at, data, buffer = _bytes(texts)
    if not len(texts) or at[0] == at[-1]:
        return Words(np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64), pa.array([], pa.large_string()))
    base, body = at[0], data[at[0]:at[-1]]
    kind = _KIND[body]
    before, here = kind[:-1], kind[1:]
    solid = (before >= 1) & (before <= 3)
    solid[1:] |= (before[1:] == 4) & (kind[:-2] >= 5) & (kind[:-2] <= 6)
    start = np.zeros(len(body), bool)
    if fine:
        letter = before == 1
        accented = (body[:-2] == 0xC3) & (body[1:-1] != 0x97) & (body[1:-1] != 0xB7)
        letter[1:] |= (before[1:] == 4) & (accented | (kind[:-2] == 6))
        start[1:] = (solid & (here >= 8)) | (letter & (here == 2))
    else:
        start[1:] = solid & (here == 8)
    if whole is not None:
        for i in np.flatnonzero(whole):
            start[at[i] - base:at[i + 1] - base] = False
    edges = at[:-1] - base
    start[edges[at[:-1] < at[1:]]] = True
    starts = np.flatnonzero(start)
    parts = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(np.append(starts + base, at[-1]).astype(np.int64)), buffer)
    coded = parts.dictionary_encode()
    first = np.append(np.searchsorted(starts, edges), len(starts))
    return Words(coded.indices.to_numpy().astype(np.int32, copy=False), first, coded.dictionary)


@dataclass
class Ragged:
    """Lists of numbers: list ``i`` is ``flat[at[i]:at[i + 1]]``."""

    flat: np.ndarray
    at: np.ndarray

    @staticmethod
    def of(flat: np.ndarray, counts: np.ndarray) -> Ragged:
        return Ragged(flat, np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]))

    def take(self, rows: np.ndarray) -> Ragged:
        """The lists of ``rows``, one after the other."""
        counts = (self.at[1:] - self.at[:-1])[rows]
        out = Ragged.of(self.flat[:0], counts)
        out.flat = self.flat[np.repeat(self.at[:-1][rows] - out.at[:-1], counts) + np.arange(out.at[-1])]
        return out


def byte_tokens(tokenizer) -> list[bytes]:
    """The bytes of each id of a byte-level tokenizer (added tokens: their text)."""
    shown = list(range(0x21, 0x7F)) + list(range(0xA1, 0xAD)) + list(range(0xAE, 0x100))
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    out = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
        out[i] = bytes(byte_of[c] for c in token)
    for i, token in tokenizer.get_added_tokens_decoder().items():
        out[i] = token.content.encode("utf-8")
    return out


def piece_tokens(pieces) -> list[bytes]:
    """The bytes of each id of a sentencepiece model: the mark is a space, ``<0xHH>`` one byte."""
    out = []
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode("utf-8"))
    return out


def piece_table(path: str):
    """A sentencepiece model whose pieces have space marks in front only, so that words are encoded alone."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    if any("▁" in pieces.id_to_piece(i).lstrip("▁") for i in range(pieces.get_piece_size())):
        raise ValueError("a piece holds a space mark behind another character")
    return pieces


def open_byte_bpe(path: str, plain_specials: bool = False):
    """The tokenizer of a ``tokenizers`` file; ``plain_specials``: its special strings in a text are plain text."""
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = plain_specials
    return t


def encode_bytes(tokenizer, sizes: np.ndarray, words: pa.Array) -> Ragged:
    """Ids of each distinct word.  ``sizes``: bytes of each id.  Words that begin with white space and end with
    something else are encoded some hundred at a time, one behind the other, which is what a text would be."""
    listed = words.to_pylist()
    length = pc.binary_length(words).to_numpy().astype(np.int64)
    joined = np.array([w[0] in " \n" and not w[-1].isspace() for w in listed], bool)
    inside, alone = np.flatnonzero(joined), np.flatnonzero(~joined)
    order = np.concatenate([inside, alone])
    texts = ["".join([listed[j] for j in inside[i:i + _BLOCK]]) for i in range(0, len(inside), _BLOCK)]
    texts += [listed[j] for j in alone]
    flat = [np.zeros(0, np.uint32)]
    for i in range(0, len(texts), 64):
        flat += [np.array(e.ids, np.uint32) for e in tokenizer.encode_batch(texts[i:i + 64], add_special_tokens=False)]
    flat = np.concatenate(flat)
    token_ends, word_ends = np.cumsum(sizes[flat]), np.cumsum(length[order])
    upto = np.searchsorted(token_ends, word_ends, "right")
    if len(order) and not (token_ends[upto - 1] == word_ends).all():
        raise ValueError("a token reaches over the end of a word")
    found = Ragged.of(flat, np.diff(upto, prepend=0))
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return found.take(back)


def encode_pieces(pieces, words: pa.Array) -> Ragged:
    """Ids of each distinct word; all begin with a space, which the model puts there itself, except before nothing:
    a lone space, the end of a text, has the ids that a model gives a mark behind a letter."""
    rests = [w[1:] for w in words.to_pylist()]
    ids = pieces.encode(rests, num_threads=1)
    if "" in rests:     # at most once among distinct words
        ids[rests.index("")] = pieces.encode("a ")[len(pieces.encode("a")):]
    counts = np.fromiter(map(len, ids), np.int64, len(ids))
    return Ragged.of(np.fromiter((x for one in ids for x in one), np.uint32, int(counts.sum())), counts)
