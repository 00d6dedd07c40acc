"""Alignment of two tokenizers' tokens, with corpus-wide counts of linked ids.

Both tokenizers encode each text; byte offsets at which a token of either ends cut the tokens into groups, and
the two tokens that end there are linked.  How often each pair of ids is linked is counted over the corpus by
external spill counting:

1. A task turns each batch of texts (a chunk) into records (pair, document, times), sorted by (B id, A id), and
   radix-partitions them by B id into runs: Zstandard frames written to the shared folder, beside the documents' rows.
2. A k-way heap merge of a radix's runs adds up each pair.  A task merges at most ``FAN`` runs or so, round after
   round, as an external sort does, so neither a hot id nor many runs make a task large: a merged run has each pair once.
   Runs are side-major, so the last round knows a B id's highest count as soon as the id is done.
3. The totals meet the radix's runs again, a bounded number of them per task, and every record's contribution
   streams back to its document; they are added up by document.

A word's tokens, groups and links don't depend on its neighbours (:mod:`.encode`), so they are found once per distinct
word of a chunk, with numpy over all of them.

Defined results: a text that is null, empty, or whose tokens' bytes don't give it back (it holds the space mark of
the pieces, say) has no tokens.  Repeated rows count as documents of their own, null ids are kept, other columns are
ignored.  A chunk is an Arrow batch bounded in bytes; a single longer text is a chunk of its own and must fit a task.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import in_arrow
from .encode import (BYTE_BPE, PIECE_BPE, Ragged, byte_tokens, cut, encode_bytes, encode_pieces, open_byte_bpe,
                     piece_table, piece_tokens, tokenizer_path)

RADIX, FAN = 16, 32
#: Bytes of text of a chunk.
CHUNK = 8 << 20

_SPILL = pa.schema([
    ("chunk", pa.int64()), ("row", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string()),
    ("radix", pa.int32()), ("pairs", pa.binary()), ("records", pa.binary())])
SPILL = ("chunk long, row int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
         "groups string, radix int, pairs binary, records binary")


def _pressed(*arrays: np.ndarray) -> bytes:
    """Arrays as one zstd frame: their lengths, then their bytes."""
    head = np.array([len(arrays), *[a.nbytes for a in arrays]], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(a.tobytes() for a in arrays))


def _opened(frame: bytes, *kinds: str) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(frame)
    sizes = np.frombuffer(data, "<i8", len(kinds), 8)
    at = 8 * (len(kinds) + 1)
    out = []
    for kind, n in zip(kinds, sizes):
        out.append(np.frombuffer(data, kind, n // np.dtype(kind).itemsize, at))
        at += n
    return out


def _sums(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    """A run of totals: sorted pairs, as steps, and their counts."""
    return _pressed(np.diff(pairs, prepend=np.uint64(0)).astype("<u8"), counts.astype("<i8"))


def _open_sums(frame: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = _opened(frame, "<u8", "<i8")
    return np.cumsum(steps, dtype=np.uint64), counts


class Aligner:
    """Both tokenizers, and what a chunk of texts gives."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = open_byte_bpe(byte_path, plain_specials=True), piece_table(piece_path)
        self.bytes = [byte_tokens(self.a), piece_tokens(self.b)]
        self.sizes = [np.array([len(x) for x in side], np.int64) for side in self.bytes]
        self.flat = [Ragged.of(np.frombuffer(b"".join(side), np.uint8), n) for side, n in zip(self.bytes, self.sizes)]

    def words(self, texts: pa.Array):
        """Words of the texts with a space put in front, the ids of each distinct word, and whether each
        text's tokens give it back."""
        filled = pc.fill_null(texts.cast(pa.large_string()), "")
        empty = pc.equal(pc.binary_length(filled), 0)
        spaced = pc.if_else(empty, pa.scalar("", pa.large_string()),
                            pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), filled,
                                                        pa.scalar("", pa.large_string())))
        found = cut(spaced)
        ids = [encode_bytes(self.a, self.sizes[0], found.distinct), encode_pieces(self.b, found.distinct)]
        want = pc.binary_length(found.distinct).to_numpy(zero_copy_only=False).astype(np.int64)
        text = np.frombuffer(b"".join(w.encode("utf-8") for w in found.distinct.to_pylist()), np.uint8)
        where = np.concatenate([[0], np.cumsum(want)])
        good = np.ones(len(want), bool)
        for side, coded in zip(self.flat, ids):
            spelt = side.take(coded.flat)
            ends = spelt.at[coded.at]
            same = np.diff(ends) == want
            # Bytes of the words of the right length, compared one by one.
            rows = np.flatnonzero(same)
            a, b = Ragged(spelt.flat, ends).take(rows), Ragged(text, where).take(rows)
            bad = np.concatenate([[0], np.cumsum(a.flat != b.flat)])
            same[rows] = bad[a.at[1:]] == bad[a.at[:-1]]
            good &= same
        bad = np.concatenate([[0], np.cumsum(~good[found.codes])])
        return found, ids, bad[found.first[1:]] == bad[found.first[:-1]]

    def chunk(self, texts: pa.Array):
        """Of each text its words (codes, none without tokens), and of each distinct word its numbers of tokens,
        its links and its groups."""
        found, (a, b), whole = self.words(texts)
        starts, stops = found.first[:-1], np.where(whole, found.first[1:], found.first[:-1])
        used = np.zeros(len(found.distinct), bool)
        for i, j in zip(starts[whole], stops[whole]):
            used[found.codes[i:j]] = True
        rows = np.flatnonzero(used)
        new = np.full(len(used), -1, np.int64)
        new[rows] = np.arange(len(rows))
        return starts, stops, new[found.codes], Linked(a.take(rows), b.take(rows), *self.sizes)


class Linked:
    """Groups and links of some words, whose tokens fill the same bytes on both sides."""

    def __init__(self, a: Ragged, b: Ragged, a_sizes: np.ndarray, b_sizes: np.ndarray):
        self.a, self.b = a, b
        a_ends, b_ends = np.cumsum(a_sizes[a.flat]), np.cumsum(b_sizes[b.flat])
        at = np.searchsorted(b_ends, a_ends)
        self.a_last = np.flatnonzero(b_ends[np.minimum(at, max(len(b_ends) - 1, 0))] == a_ends) if len(a_ends) else at
        self.b_last = at[self.a_last]               # links: the tokens that end together, in order
        per_word = np.searchsorted(self.a_last, a.at)
        self.link_at = per_word
        self.pairs = (b.flat[self.b_last].astype(np.uint64) << np.uint64(32)) | a.flat[self.a_last].astype(np.uint64)

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens A, tokens B and links (as many as groups) of each word."""
        return np.diff(self.a.at), np.diff(self.b.at), np.diff(self.link_at)

    def texts(self) -> list[str]:
        """The groups of each word as text."""
        a, b = list(map(str, self.a.flat.tolist())), list(map(str, self.b.flat.tolist()))
        groups, i, j = [], 0, 0
        for x, y in zip((self.a_last + 1).tolist(), (self.b_last + 1).tolist()):
            groups.append(f"{','.join(a[i:x])}|{','.join(b[j:y])}")
            i, j = x, y
        at = self.link_at.tolist()
        return [";".join(groups[x:y]) for x, y in zip(at, at[1:])]


def _spill(byte_path: str, piece_path: str, radix: int, with_groups: bool):
    def run(batches: Iterator[pa.RecordBatch]):
        aligner = Aligner(byte_path, piece_path)
        base = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(b for b in batches if b.num_rows):
            starts, stops, codes, linked = aligner.chunk(batch.column(1))
            n = batch.num_rows
            text_of = linked.texts()
            per_doc = [np.zeros(n, np.int64) for _ in range(3)]
            groups, digests, owners, taken = [], [], [], []
            of_word = linked.counts()
            for i, (x, y) in enumerate(zip(starts.tolist(), stops.tolist())):
                own = codes[x:y]
                for total, counts in zip(per_doc, of_word):
                    total[i] = counts[own].sum()
                text = ";".join([text_of[c] for c in own.tolist()])
                groups.append(text if with_groups else None)
                digests.append(hashlib.sha256(text.encode()).hexdigest() if y > x else "")
                if y > x:
                    word, times = np.unique(own, return_counts=True)
                    taken.append((word, times))
                    owners.append(i)
            chunk = np.full(n, base + number, np.int64)
            none = {k: pa.nulls(n, _SPILL.field(k).type) for k in ("radix", "pairs", "records")}
            a, b, links = per_doc
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk), pa.array(np.arange(n, dtype=np.int32)), batch.column(0), pa.array(a), pa.array(b),
                 pa.array(links), pa.array(links), pa.array(digests), pa.array(groups, pa.string()), *none.values()],
                schema=_SPILL)
            for r, pairs, records in _runs(linked, owners, taken, radix):
                yield pa.RecordBatch.from_pylist(
                    [{"chunk": base + number, "radix": r, "pairs": pairs, "records": records}], schema=_SPILL)
    return run


def _runs(linked: Linked, owners: list[int], taken: list[tuple], radix: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(radix, totals of pairs, records) of a chunk: records are, pair by pair, documents and times."""
    if not owners:
        return
    distinct, code = np.unique(linked.pairs, return_inverse=True)
    of_word = Ragged(code.astype(np.int64), linked.link_at)
    words = np.concatenate([w for w, _ in taken])
    doc = np.repeat(np.array(owners, np.int64), [len(w) for w, _ in taken])
    times = np.concatenate([t for _, t in taken])
    got = of_word.take(words)
    per = np.diff(got.at)
    room = int(doc.max()) + 1
    key = got.flat * room + np.repeat(doc, per)
    order = np.argsort(key, kind="stable")
    key, n = key[order], np.repeat(times, per)[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    key, n = key[first], np.add.reduceat(n, first)
    pair, doc = key // room, key % room
    side = (distinct >> np.uint64(32)) % np.uint64(radix)
    here = side[pair]
    for r in np.unique(side).tolist():
        mine = here == r
        p, d, t = pair[mine], doc[mine], n[mine]
        at = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        yield (r, _sums(distinct[p[at]], np.add.reduceat(t, at)),
               _pressed(np.diff(np.append(at, len(p))).astype("<u4"), (d & 0xFFFF).astype("<u2"),
                        (d >> 16).astype("<u2"), t.astype("<u4")))


def _stream(frame: bytes) -> Iterator[tuple[int, int]]:
    pairs, counts = _open_sums(frame)
    for i in range(0, len(pairs), 4096):    # a bounded part of a run as Python numbers
        yield from zip(pairs[i:i + 4096].tolist(), counts[i:i + 4096].tolist())


def merged(frames: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """k-way heap merge of runs of totals: each pair once, with its sum."""
    pairs, counts, last = [], [], -1
    for pair, n in heapq.merge(*map(_stream, frames)):
        if pair == last:
            counts[-1] += n
        else:
            pairs.append(pair)
            counts.append(n)
            last = pair
    return np.array(pairs, np.uint64), np.array(counts, np.int64)


def highest(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether each pair's count is its B id's highest; pairs are side-major, so an id's pairs are neighbours."""
    if not len(pairs):
        return np.zeros(0, bool)
    side = pairs >> np.uint64(32)
    first = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
    most = np.maximum.reduceat(counts, first)
    return counts == np.repeat(most, np.diff(np.append(first, len(pairs))))


_RUN = pa.schema([("radix", pa.int32()), ("chunk", pa.int64()), ("pairs", pa.binary())])


def _merge_group(group: pa.Table) -> pa.Table:
    frames = group.column("pairs").to_pylist()
    out = frames[0] if len(frames) == 1 else _sums(*merged(frames))
    return pa.table([group.column("radix")[:1], [pc.min(group.column("chunk")).as_py()], [out]], schema=_RUN)


def _slots_of(runs: DataFrame, fan: int) -> DataFrame:
    """(radix, slots): to how many groups a radix's runs are dealt; a row per radix."""
    return runs.groupBy("radix").agg(F.ceil(F.count(F.lit(1)) / fan).cast("int").alias("slots"))


def _slots(runs: DataFrame, fan: int) -> DataFrame:
    """Adds ``slots`` and ``slot``, the group of the run."""
    return (runs.join(F.broadcast(_slots_of(runs, fan)), "radix")
            .withColumn("slot", F.pmod(F.xxhash64("chunk"), F.col("slots")).cast("int")))


def _totals(runs: DataFrame, fan: int) -> DataFrame:
    """(radix, pairs): one run of totals per radix."""
    spark = runs.sparkSession
    at = runs.select("radix", "chunk", "pairs")
    while True:
        most = at.groupBy("radix").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return at
        path = scratch_path(spark, "align")
        (_slots(at, fan).groupBy("radix", "slot")
         .applyInArrow(_merge_group, "radix int, chunk long, pairs binary").write.parquet(path))
        at = spark.read.schema("radix int, chunk long, pairs binary").parquet(path)


_BACK = pa.schema([("chunk", pa.int64()), ("row", pa.int32()), ("best", pa.int64()), ("total", pa.int64())])


def _contributions(runs: pa.Table, totals: pa.Table) -> pa.Table:
    """What the records of some runs of one radix give back to their documents."""
    if not len(runs):
        return _BACK.empty_table()
    pairs, counts = _open_sums(totals.column("totals")[0].as_py())
    best, parts = highest(pairs, counts), []
    for i in range(len(runs)):
        own, _ = _open_sums(runs.column("pairs")[i].as_py())
        each, low, high, times = _opened(runs.column("records")[i].as_py(), "<u4", "<u2", "<u2", "<u4")
        row = low.astype(np.int64) | (high.astype(np.int64) << 16)
        at = np.repeat(np.searchsorted(pairs, own), each)
        n = times.astype(np.int64)
        total, top = np.zeros((2, int(row.max()) + 1), np.int64)
        np.add.at(total, row, n * counts[at])
        np.add.at(top, row, n * best[at])
        rows = np.flatnonzero(total)
        parts.append(pa.table([np.full(len(rows), runs.column("chunk")[i].as_py(), np.int64), rows.astype(np.int32),
                               top[rows], total[rows]], schema=_BACK))
    return pa.concat_tables(parts)


def align(documents: DataFrame, byte_tokenizer: str | None = None, piece_tokenizer: str | None = None,
          groups: bool = False, radix: int = RADIX, fan: int = FAN) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256[, groups]) of each document; ``groups``
    are written as ``a1,a2|b1;a3|b2,b3``."""
    return _aligned(documents, byte_tokenizer, piece_tokenizer, groups, radix, fan)[0]


def linked_ids(documents: DataFrame, byte_tokenizer: str | None = None, piece_tokenizer: str | None = None,
               radix: int = RADIX, fan: int = FAN) -> DataFrame:
    """(a_id, b_id, n, best): how often each pair is linked over all documents, and whether that is its B id's highest."""
    return in_arrow(_aligned(documents, byte_tokenizer, piece_tokenizer, False, radix, fan)[1].select("pairs"),
                    _listed, "a_id int, b_id int, n long, best boolean")


def _listed(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for frame in batch.column(0).to_pylist():
            pairs, counts = _open_sums(frame)
            best = highest(pairs, counts)
            for i in range(0, len(pairs), 1 << 16):
                p = pairs[i:i + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((p & np.uint64(0xFFFFFFFF)).astype(np.int32)), pa.array((p >> np.uint64(32)).astype(np.int32)),
                     pa.array(counts[i:i + (1 << 16)]), pa.array(best[i:i + (1 << 16)])], ["a_id", "b_id", "n", "best"])


def _aligned(documents, byte_tokenizer, piece_tokenizer, groups, radix, fan) -> tuple[DataFrame, DataFrame]:
    spark = documents.sparkSession
    paths = byte_tokenizer or tokenizer_path(BYTE_BPE), piece_tokenizer or tokenizer_path(PIECE_BPE)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    path = scratch_path(spark, "align")
    in_arrow(rows, _spill(*paths, radix, groups), SPILL, CHUNK).write.parquet(path)
    spilt = spark.read.schema(SPILL).parquet(path)
    runs = spilt.where("radix is not null").select("radix", "chunk", "pairs", "records")
    totals = _totals(runs, fan)
    dealt = _slots(runs, fan)
    copies = (totals.select("radix", "pairs").join(F.broadcast(_slots_of(runs, fan)), "radix")
              .select(F.col("radix").alias("r"), F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("s"),
                      F.col("pairs").alias("totals")))
    back = (dealt.groupBy("radix", "slot").cogroup(copies.groupBy("r", "s"))
            .applyInArrow(_contributions, "chunk long, row int, best long, total long")
            .groupBy("chunk", "row").agg(F.sum("best").alias("best"), F.sum("total").alias("total")))
    docs = spilt.where("radix is null").select(
        "chunk", "row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", *(["groups"] if groups else []))
    out = docs.join(back, ["chunk", "row"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("total", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256", *(["groups"] if groups else []))
    return out, totals
