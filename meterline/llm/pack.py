"""Packing documents into sequences of a fixed length.

Bounded-space online packing.  A document is its ids and one end id.  Each partition keeps a fixed number of
open windows.  A document's full lengths are sequences of their own; what remains goes, whole, into the open
window in which it leaves the least room.  If it fits none, the fullest window is emitted, and a fresh one
takes its place.  At the end the windows still open are merged: their pieces meet in groups of bounded size, largest first, and
each group keeps one open window at most, so few rounds later one group is left.

A window is emitted with at most ``slack`` ids of padding: if the fullest has more room, the front part of
the piece that found no place fills it (documents may be cut freely).  So padding is at most ``slack / size`` of
the output, whatever the lengths, except in the very last sequence.

Memory: the windows of a partition, or a group's pieces.  No task sees more, and nothing passes the driver but counts.
What the partitions packed is written to the shared folder once, so sequence numbers survive lost executors.

Defined results: null and empty texts are documents of the end id alone.  Repeated rows are documents of their own,
null ids are kept.  Other columns are ignored.  Of an empty table no piece is made.  A text is encoded as a whole, in
words (:mod:`.encode`).  The tokenizer's special strings in a text become its special ids, as its library does by default.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import in_arrow
from .encode import BYTE_BPE, byte_tokens, cut, encode_bytes, open_byte_bpe, tokenizer_path

SIZE, END_ID, WINDOWS, SLACK = 1024, 0, 64, 8
#: Leftover pieces that meet in one task.
GROUP = 4096

_FIELDS = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
           ("ids", pa.binary()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("open", pa.bool_())]
_OUT = pa.schema(_FIELDS)
PACKED = ("doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long, "
          "open boolean")


class Packer:
    """The open windows.  A piece is (doc_id, start, length, doc_tokens, ids); closed windows come out of ``closed``."""

    def __init__(self, size: int, windows: int, slack: int, first: int):
        self.size, self.windows, self.slack, self.next = size, windows, slack, first
        self.rooms: list[tuple[int, int]] = []      # (room, sequence) of the open windows, least room first
        self.held: dict[int, list[tuple]] = {}
        self.closed: list[tuple] = []               # pieces with (sequence, offset, False)

    def _close(self, sequence: int) -> None:
        self.closed += _placed(self.held.pop(sequence), sequence, False)

    def add(self, piece: tuple) -> None:
        """A piece of at most ``size`` ids."""
        while piece:
            at = bisect_left(self.rooms, (piece[2],))
            if at == len(self.rooms) and len(self.rooms) >= self.windows:
                room, sequence = self.rooms.pop(0)
                if room > self.slack:
                    front, piece = split(piece, room)
                    self.held[sequence].append(front)
                self._close(sequence)
                continue
            if at < len(self.rooms):
                room, sequence = self.rooms.pop(at)
            else:
                room, sequence, self.next = self.size, self.next, self.next + 1
                self.held[sequence] = []
            self.held[sequence].append(piece)
            if room > piece[2]:
                insort(self.rooms, (room - piece[2], sequence))
            else:
                self._close(sequence)
            return

    def close_full(self) -> None:
        """Closes every window that is within ``slack`` of full."""
        while self.rooms and self.rooms[0][0] <= self.slack:
            self._close(self.rooms.pop(0)[1])

    def merge(self) -> None:
        """The emptiest windows give their pieces to the fullest until at most one is open."""
        self.close_full()
        while len(self.rooms) > 1:
            room, sequence = self.rooms.pop(0)
            spare_room, spare = self.rooms.pop()
            piece = self.held[spare].pop()
            if piece[2] > room:
                piece, rest = split(piece, room)
                self.held[spare].append(rest)
            self.held[sequence].append(piece)
            spare_room += piece[2]
            if self.held[spare]:
                insort(self.rooms, (spare_room, spare))
            else:
                del self.held[spare]
            if room - piece[2] > self.slack:
                insort(self.rooms, (room - piece[2], sequence))
            else:
                self._close(sequence)

    def close_all(self) -> None:
        while self.rooms:
            self._close(self.rooms.pop(0)[1])

    def take_closed(self) -> list[tuple]:
        out, self.closed = self.closed, []
        return out

    def leftovers(self) -> list[tuple]:
        return [row for sequence, pieces in sorted(self.held.items()) for row in _placed(pieces, sequence, True)]


def split(piece: tuple, n: int) -> tuple[tuple, tuple]:
    """The first ``n`` ids of a longer piece, and the others."""
    doc_id, start, length, doc_tokens, ids = piece
    return (doc_id, start, n, doc_tokens, ids[:4 * n]), (doc_id, start + n, length - n, doc_tokens, ids[4 * n:])


def _placed(pieces: list[tuple], sequence: int, still_open: bool) -> list[tuple]:
    out, offset = [], 0
    for doc_id, start, length, doc_tokens, ids in pieces:
        out.append((doc_id, start, length, doc_tokens, ids, sequence, offset, still_open))
        offset += length
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(_OUT)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _OUT)], schema=_OUT)


def document_ids(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[tuple]:
    """(doc_id, ids with the end id as little-endian 32-bit numbers) of (doc_id, text) rows, in order."""
    tokenizer = open_byte_bpe(path)
    sizes = np.array([len(b) for b in byte_tokens(tokenizer)], np.int64)
    specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    end = np.array([end_id], "<u4").tobytes()
    for batch in batches:
        texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
        whole = np.zeros(len(texts), bool)
        for s in specials:
            whole |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        words = cut(texts, fine=True, whole=whole)
        coded = encode_bytes(tokenizer, sizes, words.distinct)
        doc_ids = batch.column(0).to_pylist()
        for i in range(0, len(doc_ids), 256):       # a bounded part of the batch's ids at a time
            first = words.first[i:i + 257]
            ids = coded.take(words.codes[first[0]:first[-1]])
            at = ids.at[first - first[0]]
            flat = ids.flat.astype("<u4", copy=False)
            for k, doc_id in enumerate(doc_ids[i:i + 256]):
                yield doc_id, flat[at[k]:at[k + 1]].tobytes() + end


def _pack(path: str, size: int, end_id: int, windows: int, slack: int):
    def run(batches):
        packer = Packer(size, windows, slack, TaskContext.get().partitionId() << 32)
        made, held = [], 0
        for doc_id, ids in document_ids(batches, path, end_id):
            n = len(ids) // 4
            rest = n - n % size
            for start in range(0, rest, size):
                made.append((doc_id, start, size, n, ids[4 * start:4 * (start + size)], packer.next, 0, False))
                packer.next += 1
            if rest < n:
                packer.add((doc_id, rest, n - rest, n, ids[4 * rest:]))
            made += packer.take_closed()
            held += len(ids)
            if held >= 8 << 20:
                yield _batch(made)
                made, held = [], 0
        packer.close_full()
        yield _batch(made + packer.take_closed())
        yield _batch(packer.leftovers())
    return run


def _merge(size: int, slack: int, first: int, last: bool):
    def run(group: pa.Table) -> pa.Table:
        number = group.column("part")[0].as_py()
        packer = Packer(size, len(group), slack, first + (number << 32))
        rows = group.select(["doc_id", "start", "length", "doc_tokens", "ids"]).to_pylist()
        pieces = [tuple(r.values()) for r in rows]
        # Largest first; the rest of the order only makes reruns agree.
        for piece in sorted(pieces, key=lambda p: (-p[2], p[0] is None, p[0] or 0, p[1], p[4])):
            packer.add(piece)
        packer.merge()
        if last:
            packer.close_all()
        return pa.Table.from_batches([_batch(packer.take_closed() + packer.leftovers())])
    return run


def pack(documents: DataFrame, tokenizer: str | None = None, size: int = SIZE, end_id: int = END_ID,
         windows: int = WINDOWS, slack: int = SLACK) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids, sequence_id, offset): the pieces, each with its ids as
    little-endian unsigned 32-bit numbers; pieces of a ``sequence_id`` lie one behind the other from offset 0."""
    spark = documents.sparkSession
    path = tokenizer or tokenizer_path(BYTE_BPE)

    def written(df: DataFrame) -> DataFrame:
        at = scratch_path(spark, "pack")
        df.write.option("compression", "zstd").parquet(at)
        return spark.read.schema(PACKED).parquet(at)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    done = [written(in_arrow(rows, _pack(path, size, end_id, windows, slack), PACKED))]
    level = 1
    while True:
        left = done[-1].where("open")
        parts = -(-left.count() // GROUP)
        if not parts:
            break
        part = F.pmod(F.xxhash64("sequence_id", "offset"), F.lit(parts)).alias("part")
        merged = left.select("*", part).groupBy("part").applyInArrow(
            _merge(size, slack, level << 56, parts == 1), PACKED)
        done.append(written(merged))
        level += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.where("not open").drop("open")
