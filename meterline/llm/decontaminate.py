"""Benchmark decontamination by a prefix-filtered set join with exact verification.

An item's windows are its runs of ``window`` words (all its words if it has fewer).  A document holds a
window only if it holds every shingle of it, so the necessary prefix of a window is one shingle: the
rarest.  The join runs in these steps:

1. the windows' shingles are counted over all documents (partial counts per task), which orders them;
2. each window is filed under its rarest shingle, together with where in the window that stands;
3. each document position whose shingle is filed gives candidates: the window would start that much
   earlier.  The length bound drops windows longer than the document, the positional bound those that
   would begin before its first or end after its last word;
4. a candidate stands if all of the window's words equal the document's words there.

Documents never move: the windows are broadcast in blocks of items of at most ``BLOCK_BYTES`` of text,
and each block is one narrow pass that adds to the hits found so far (a checkpoint between passes).

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, compared by 64-bit hashes.

Defined results: null or wordless texts have no words and no hits; null or wordless items are never found;
items that repeat count once by id and a null item id is ignored.  Repeated documents are
judged one by one.  Other columns come along if named in ``carry``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, keep
from .words import ALNUM, Words, batch_texts, shingles

WINDOW = 10
SHINGLE = 3
BLOCK_BYTES = 8 << 20
_CELLS = 1 << 22


class Windows:
    """The windows of one block of items, as arrays; no window may have fewer than ``q`` words."""

    def __init__(self, items: list[tuple[object, str]], window: int, q: int):
        self.q = q
        self.names = [i for i, _ in items]
        w = Words(pa.array([t or "" for _, t in items], pa.large_string()), ALNUM)
        self.words = w.hashes()
        counts = w.counts
        runs = np.where(counts >= window, counts - window + 1, np.minimum(counts, 1))
        self.item = np.repeat(np.arange(len(items)), runs)
        step = np.arange(len(self.item)) - np.repeat(np.cumsum(runs) - runs, runs)
        self.start = np.repeat(w.first[:-1], runs) + step
        self.length = np.minimum(np.repeat(counts, runs), window)
        # shingles by the position of their first word
        rolled, begin = shingles(self.words, w.first, q)
        self.at = np.repeat(begin[:-1], runs) + step
        self.per = np.maximum(self.length - q + 1, 1)
        self.rolled = rolled
        self.shingles = np.unique(rolled)

    def file(self, often: np.ndarray) -> None:
        """File every window under its rarest shingle; ``often`` is parallel to ``self.shingles``."""
        times = often[np.searchsorted(self.shingles, self.rolled)]
        key = np.empty(len(self.item), np.uint64)
        shift = np.empty(len(self.item), np.int64)
        for i, (a, n) in enumerate(zip(self.at, self.per)):
            j = int(np.lexsort((self.rolled[a:a + n], times[a:a + n]))[0])
            key[i], shift[i] = self.rolled[a + j], j
        order = np.argsort(key, kind="stable")
        self.key, self.shift = key[order], shift[order]
        self.item, self.start, self.length = self.item[order], self.start[order], self.length[order]


class Lookup:
    """Membership of many hashes in a sorted set: a bitmap first, then binary search."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = np.zeros(_CELLS, bool)
        self.bits[(keys >> np.uint64(42)).astype(np.int64)] = True

    def positions(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(0, np.int64)
        maybe = np.flatnonzero(self.bits[(hashes >> np.uint64(42)).astype(np.int64)])
        at = np.searchsorted(self.keys, hashes[maybe]).clip(max=len(self.keys) - 1)
        return maybe[self.keys[at] == hashes[maybe]]


def _document_shingles(w: Words, hashes: np.ndarray, q: int):
    """Hashes of runs of q words, their text and the word that each begins with."""
    rolled, begin = shingles(hashes, w.first, q)
    of = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    return rolled, of, np.arange(len(rolled)) - begin[of] + w.first[of]


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges lo..hi, and which range each is of."""
    n = hi - lo
    of = np.repeat(np.arange(len(lo)), n)
    return of, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[of]


def windows_of(items: list[tuple[object, str]], window: int, q: int) -> list[Windows]:
    """The windows of a block of items; those of fewer than ``q`` words have shingles of their own size."""
    counts = Words(pa.array([t for _, t in items], pa.large_string()), ALNUM).counts
    by_size: dict[int, list] = {}
    for item, n in zip(items, counts):
        if n:
            by_size.setdefault(min(q, int(n)), []).append(item)
    return [Windows(own, window, size) for size, own in sorted(by_size.items())]


def _count(windows):
    schema = pa.schema([("part", pa.int32()), ("shingle", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]):
        parts = windows.value
        looks = [Lookup(p.shingles) for p in parts]
        totals = [np.zeros(len(p.shingles), np.int64) for p in parts]
        for batch in batches:
            for part in batch_texts(batch, "text"):
                w = Words(part.column(0), ALNUM)
                hashes = w.hashes()
                for p, look, total in zip(parts, looks, totals):
                    rolled, _ = shingles(hashes, w.first, p.q)
                    at = look.positions(rolled)
                    total += np.bincount(np.searchsorted(p.shingles, rolled[at]), minlength=len(total))
        for i, total in enumerate(totals):
            found = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), i, np.int32)), pa.array(found), pa.array(total[found])], schema=schema)
    return run


def hits(w: Words, hashes: np.ndarray, windows: Windows, look: Lookup):
    """(text, first word, words, item) of every occurrence of a window in the texts of ``w``."""
    rolled, of, word = _document_shingles(w, hashes, windows.q)
    pos = look.positions(rolled)
    at, filed = _spread(np.searchsorted(windows.key, rolled[pos], "left"),
                        np.searchsorted(windows.key, rolled[pos], "right"))
    text = of[pos][at]
    start = word[pos][at] - windows.shift[filed]
    n = windows.length[filed]
    ok = (n <= w.counts[text]) & (start >= w.first[text]) & (start + n <= w.first[text + 1])
    text, start, n, filed = text[ok], start[ok], n[ok], filed[ok]
    for j in range(int(n.max()) if len(n) else 0):
        ok = n > j
        ok[ok] = hashes[start[ok] + j] == windows.words[windows.start[filed[ok]] + j]
        ok |= n <= j
        text, start, n, filed = text[ok], start[ok], n[ok], filed[ok]
    return text, start, n, windows.item[filed]


def _mark(windows, schema: pa.Schema):
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]):
        parts = [(p, Lookup(np.unique(p.key))) for p in windows.value]
        for batch in batches:
            for part in batch_texts(batch, "text"):
                w = Words(part.column(names.index("text")), ALNUM)
                hashes = w.hashes()
                spans, items = part.column(names.index("spans")).to_pylist(), part.column(names.index("items")).to_pylist()
                for win, look in parts:
                    text, start, n, item = hits(w, hashes, win, look)
                    begin = start - w.first[text]
                    for d in np.unique(text):
                        mine = slice(*np.searchsorted(text, [d, d + 1]))
                        spans[d] = _joined(spans[d], begin[mine], n[mine])
                        items[d] = sorted(set(items[d]) | {str(win.names[i]) for i in np.unique(item[mine])})
                cols = list(part.columns)
                cols[names.index("n_words")] = pa.array(w.counts)
                cols[names.index("spans")] = pa.array(spans, schema.field("spans").type)
                cols[names.index("items")] = pa.array(items, schema.field("items").type)
                yield pa.RecordBatch.from_arrays(cols, schema=schema)
    return run


def _joined(old: list[int], begin: np.ndarray, n: np.ndarray) -> list[int]:
    """Disjoint sorted spans, flat as begin, end, begin, end ..., of the old and the new ones."""
    a = np.concatenate([np.array(old[0::2], np.int64), begin])
    e = np.concatenate([np.array(old[1::2], np.int64), begin + n])
    order = np.argsort(a, kind="stable")
    a, e = a[order], np.maximum.accumulate(e[order])
    new = np.concatenate([[True], a[1:] > e[:-1]])
    last = np.concatenate([new[1:], [True]])
    return np.stack([a[new], e[last]], 1).ravel().tolist()


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[object, str]]]:
    """The items, in blocks of at most ``limit`` bytes of text (one item at least)."""
    rows, size = [], 0
    for r in benchmark.where("item_id is not null and text is not null").select("item_id", "text").toLocalIterator():
        n = len(r["text"].encode())
        if rows and size + n > limit:
            yield rows
            rows, size = [], 0
        rows.append((r["item_id"], r["text"]))
        size += n
    yield rows


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, q: int = SHINGLE,
                  carry: Sequence[str] = (), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans, *carry) of every row of ``docs``.

    ``spans``: the hit words as disjoint [begin, end) word positions, flat; ``items``: the ids, as
    sorted strings, of the items with a window in the document.
    """
    spark = docs.sparkSession
    q = min(q, window)
    extra = [c for c in carry if c != "text"]
    out = docs.select("doc_id", "text", *extra, F.lit(0).cast("long").alias("n_words"),
                      F.array().cast("array<long>").alias("spans"),
                      F.array().cast("array<string>").alias("items"))
    for i, items in enumerate(_blocks(benchmark, block_bytes)):
        parts = windows_of(items, window, q)
        often = [np.zeros(len(p.shingles), np.int64) for p in parts]
        for r in (in_arrow(docs.select("text"), _count(spark.sparkContext.broadcast(parts)), "part int, shingle long, n long")
                  .groupBy("part", "shingle").agg(F.sum("n").alias("n")).collect()):
            often[r["part"]][r["shingle"]] = r["n"]
        for p, n in zip(parts, often):
            p.file(n)
        sent = spark.sparkContext.broadcast(parts)
        if i:
            out = keep(out)
        schema = _arrow(out)
        out = in_arrow(out, _mark(sent, schema), out.schema)
    total = F.expr("aggregate(spans, 0L, (s, x) -> x - s)")  # the ends less the begins, as they alternate
    return out.select("doc_id", "n_words", total.alias("n_hit"), "items", "spans", *carry)


def _arrow(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)


def items_digest(items) -> F.Column:
    return F.sha2(F.concat_ws(",", F.sort_array(items)).cast("binary"), 256)


def digest_of(items: Sequence[object]) -> str:
    """The same digest for brute-force tests."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
