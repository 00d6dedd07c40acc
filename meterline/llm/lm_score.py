"""Masked pseudo-likelihood: every word is predicted from the words on both of its sides.

    P(word | sides) = P(class | sides) * P(word | class, left, right)

A window network (embeddings of the ``SIDE`` words before and after, added, tanh, softmax over classes) gives
the class of a masked word.  Classes follow frequency: the commonest of ``BUCKETS`` hash buckets of words are
classes of their own, the others are cut by rank into ``SHARED`` bands of equal numbers of words.  Inside a class
each word has its own probability, from the corpus counts of the word between its two neighbours,

    P(word | class, left, right) = (n(left, word, right) + PRIOR * P0) / (n(left, class, right) + PRIOR)
    P0 = n(bucket) / n(class)

where the masked occurrence itself is left out of every count, as a masked word mustn't foretell itself.  A word
never seen between these neighbours falls back to P0, which words of one bucket have in common; so do words of a
class of their own, where it is 1 and neighbours are not counted.  The sum of the log-probabilities over all words of
a document is its pseudo-log-likelihood.

Counts cover the whole corpus and grow with it: a block of texts sends its different (neighbours, word) pairs, once
each with a count, to hash ranges, whose number follows the number of words; a range adds them up and answers each
block by how much the neighbours change P0, and the block adds up its texts.  A pair that all texts share is sent
once per block, not once per text.  Keys are hashes: 32 bits for the neighbours besides those of the range, 32 for the word; among the million words of a range
about one pair of neighbours in 4,000 shares its bits with another, and only their class counts add up then.

The network is trained in numpy where the text is: in each round every task starts from the same weights
and learns from the words of all of its documents, then the tasks' weights are averaged,
weighted by words (as sums of scaled integers, so the order in which they arrive doesn't matter).  Every
word is a target in every round; with a ``stride`` above 1 round r takes the positions r, r + stride, ..., so
that ``stride`` rounds cover all.  The driver holds the bucket counts and one set of weights, both of fixed size.
Averages depend on how rows fall into tasks, so another layout of the table gives slightly other scores.

Defined results: a null or empty text, or one without words, has 0 tokens, a score of 0 and a null mean.
Repeated rows get equal scores.  An empty corpus scores nothing.  Columns named in ``carry`` come along.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow
from .words import SPACED, Words, batch_texts, mix

BUCKETS = 1 << 20
CLASSES = 64
SHARED = 16
SIDE = 2
WIDTH = 16
ROUNDS = 2
STRIDE = 1
RATE = 0.2
PRIOR = 1.0
BLOCK_BYTES = 8 << 20
RANGE_WORDS = 1 << 20
_MINIBATCH = 512
_SCALE = float(1 << 24)
_ROWS = 1024
_OWN = CLASSES - SHARED - 1
_BUCKET_BITS = BUCKETS.bit_length() - 1
_RANGE = np.uint64(40)  # the bits of a neighbours' hash above these choose its range, a message holds the last 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MESSAGE = "range int, block long, cells binary, words binary, counts binary, home binary, at binary, total binary"
_ANSWER = "range int, block long, gains binary, home binary, at binary, total binary"

OFFSETS = [o for o in range(-SIDE, SIDE + 1) if o]


@dataclass
class Vocabulary:
    """Class of each bucket (0 stands for the edge of a text) and a word's share of its class by bucket, without
    that word itself."""

    cls: np.ndarray
    share: np.ndarray
    prior: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Vocabulary:
        order = np.lexsort((np.arange(len(counts)), -counts))
        smooth = counts + 0.5
        mass = np.cumsum(smooth[order[_OWN:]])
        kind = np.empty(len(counts), np.uint8)
        kind[order[:_OWN]] = 1 + np.arange(_OWN)
        kind[order[_OWN:]] = 1 + _OWN + np.minimum(SHARED - 1, (mass * (SHARED / mass[-1])).astype(np.int64))
        total = np.bincount(kind, weights=smooth, minlength=CLASSES)
        share = np.maximum(smooth - 1, 0.5) / np.maximum(total - 1, 0.5)[kind]
        return cls(kind, share, np.log(np.maximum(total, 0.5) / np.maximum(total, 0.5).sum()).astype(np.float32))


@dataclass
class Network:
    embed: np.ndarray   # (2 * SIDE, CLASSES, WIDTH)
    out: np.ndarray     # (WIDTH, CLASSES)
    bias: np.ndarray    # (CLASSES,)

    @classmethod
    def fresh(cls, prior: np.ndarray) -> Network:
        rng = np.random.default_rng(0)
        shape = (2 * SIDE, CLASSES, WIDTH)
        return cls(rng.normal(0, 0.3, shape).astype(np.float32),
                   rng.normal(0, 0.05, (WIDTH, CLASSES)).astype(np.float32), prior.copy())

    def flat(self) -> np.ndarray:
        return np.concatenate([self.embed.ravel(), self.out.ravel(), self.bias])

    @classmethod
    def unflat(cls, x: np.ndarray) -> Network:
        a, b = 2 * SIDE * CLASSES * WIDTH, WIDTH * CLASSES
        x = x.astype(np.float32)
        return cls(x[:a].reshape(2 * SIDE, CLASSES, WIDTH), x[a:a + b].reshape(WIDTH, CLASSES), x[a + b:])

    def logits(self, sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden layer and scores of the classes, at most 0, for rows of neighbouring classes."""
        hidden = self.embed[0][sides[:, 0]]
        for i in range(1, sides.shape[1]):
            hidden = hidden + self.embed[i][sides[:, i]]
        hidden = np.tanh(hidden)
        logits = hidden @ self.out + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        return hidden, logits

    def log_probs(self, sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden layer and log-softmax over classes, for rows of neighbouring classes."""
        hidden, logits = self.logits(sides)
        logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
        return hidden, logits

    def learn(self, sides: np.ndarray, target: np.ndarray, rate: float) -> None:
        """One step of gradient ascent on the mean log-probability."""
        hidden, logits = self.logits(sides)
        rows = np.arange(len(target))
        g = np.exp(logits, out=logits)
        g *= (-rate / len(target)) / g.sum(axis=1, keepdims=True)
        g[rows, target] += rate / len(target)
        back = (g @ self.out.T) * (1 - hidden ** 2)
        self.out += hidden.T @ g
        self.bias += g.sum(axis=0)
        chosen = np.zeros((len(target), self.embed.shape[1]), np.float32)
        for i in range(sides.shape[1]):
            chosen[rows, sides[:, i]] = 1
            self.embed[i] += chosen.T @ back
            chosen[rows, sides[:, i]] = 0


def buckets(w: Words) -> np.ndarray:
    return _bucket_of(w.hashes())


def _bucket_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)


def neighbours(cls: np.ndarray, first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Classes on both sides of the words ``at`` (sorted positions); 0 beyond the edge of their text."""
    text = np.repeat(np.arange(1, len(first)) * SIDE, np.diff(first))  # SIDE zeros before each text and after the last
    padded = np.zeros(len(cls) + SIDE * len(first), np.int64)
    padded[np.arange(len(cls)) + text] = cls
    here = at + text[at]
    return np.stack([padded[here + o] for o in OFFSETS], axis=1)


def _count(batches: Iterator[pa.RecordBatch]):
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for part in batch_texts(batch, "text"):
            total += np.bincount(buckets(Words(part.column(0), SPACED)), minlength=BUCKETS)
    found = np.flatnonzero(total)
    for i in range(0, len(found), 1 << 16):
        part = found[i:i + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["bucket", "n"])


def _learn(vocabulary, network, stride: int, phase: int, rate: float):
    def run(batches: Iterator[pa.RecordBatch]):
        cls = vocabulary.value.cls
        net = Network.unflat(network.value.copy())
        seen = 0
        for batch in batches:
            for part in batch_texts(batch, "text"):
                w = Words(part.column(0), SPACED)
                own = cls[buckets(w)]
                at = np.arange((phase - seen) % stride, len(own), stride)
                sides = neighbours(own, w.first, at)
                for i in range(0, len(at), _MINIBATCH):
                    net.learn(sides[i:i + _MINIBATCH], own[at[i:i + _MINIBATCH]], rate)
                seen += len(own)
        if seen:
            weights = np.rint(net.flat().astype(float) * _SCALE).astype(np.int64)
            n = max(1, seen >> 10)  # thousands of words, so that the sums stay within 64 bits
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(weights), dtype=np.int32)), pa.array(weights),
                 pa.array(np.full(len(weights), n))], names=["i", "weight", "n"])
    return run


def word_counts(docs: DataFrame) -> np.ndarray:
    rows = in_arrow(docs.select("text"), _count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(BUCKETS, np.int64)
    counts[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return counts


def train(docs: DataFrame, rounds: int = ROUNDS, stride: int = STRIDE, rate: float = RATE,
          counts: np.ndarray | None = None) -> tuple[Vocabulary, Network]:
    spark = docs.sparkSession
    vocabulary = Vocabulary.of(word_counts(docs) if counts is None else counts)
    net = Network.fresh(vocabulary.prior)
    sent = spark.sparkContext.broadcast(vocabulary)
    for r in range(rounds):
        start = spark.sparkContext.broadcast(net.flat())
        rows = (in_arrow(docs.select("text"), _learn(sent, start, stride, r % stride, rate / (1 + r)), "i int, weight long, n long")
                .groupBy("i").agg((F.sum(F.col("weight").cast("decimal(38,0)") * F.col("n")) / F.sum("n"))
                                  .cast("double").alias("w")).toArrow())
        if rows.num_rows:
            flat = np.zeros(len(net.flat()))
            flat[rows["i"].to_numpy()] = rows["w"].to_numpy()
            net = Network.unflat(flat / _SCALE)
    return vocabulary, net


def class_likelihood(w: Words, own: np.ndarray, net: Network) -> np.ndarray:
    """The summed log P(class | sides) of the words of each text; ``own`` has the classes of the words."""
    each = np.zeros(len(own) + 1)
    sides = neighbours(own, w.first, np.arange(len(own)))
    for i in range(0, len(own), _ROWS):
        target = own[i:i + _ROWS]
        _, logp = net.log_probs(sides[i:i + _ROWS])
        each[i + 1:i + 1 + len(target)] = logp[np.arange(len(target)), target]
    return _per_text(each[1:], w.first)


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and how long they are."""
    if not len(ordered):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return at, np.diff(np.append(at, len(ordered)))


def contexts(hashes: np.ndarray, first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of the words before and after each of the words ``at``; 0 stands for the edge of a text."""
    left, right = np.roll(hashes, 1), np.roll(hashes, -1)
    starts, ends = first[:-1], first[1:]
    left[starts[starts < len(hashes)]] = 0
    right[ends[ends > 0] - 1] = 0
    return mix(mix(left[at] + _ODD) * _ODD + right[at])


def _small(values: np.ndarray) -> bytes:
    """Four-byte values as compressed byte planes: high bytes are nearly all alike."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(1).compress(planes.tobytes())


def _wide(data: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def _block_messages(part: pa.RecordBatch, text: int, block: int, ranges: int, vocabulary: Vocabulary, net: Network):
    """The different keys of a block by range; the block's home range keeps what only the block needs: its
    rows, which keys its words have, and what doesn't depend on the neighbours' words."""
    w = Words(part.column(text), SPACED)
    h = w.hashes()
    bucket = _bucket_of(h)
    own = vocabulary.cls[bucket]
    counted = own > _OWN
    total = class_likelihood(w, own, net) + _per_text(np.where(counted, np.log(vocabulary.share[bucket]), 0.0), w.first)
    inner = np.flatnonzero(counted)
    context, word = contexts(h, w.first, inner), h[inner] >> np.uint64(32)
    high = context >> _RANGE
    key = (high << _RANGE) | (mix(context + word * _ODD) >> (np.uint64(64) - _RANGE))
    order = np.argsort(key)
    at, times = _runs(key[order])
    of = np.empty(len(key), np.int32)
    of[order] = np.repeat(np.arange(len(at), dtype=np.int32), times)
    one = order[at]
    cells, words = context[one].astype(np.uint32), word[one].astype(np.uint32)
    goes = (high[one] * np.uint64(ranges) >> (np.uint64(64) - _RANGE)).astype(np.int64)  # rises with the key
    home = block % ranges
    cut = np.searchsorted(goes, np.arange(ranges + 1))
    here = np.searchsorted(inner, w.first)
    rest = pa.RecordBatch.from_arrays([*[c for i, c in enumerate(part.columns) if i != text], pa.array(w.counts),
                                       pa.array(np.diff(here))], names=[f"f{i}" for i in range(part.num_columns + 1)])
    for r in sorted({home, *np.flatnonzero(np.diff(cut)).tolist()}):
        a, b = cut[r], cut[r + 1]
        yield {"range": r, "block": block, "cells": cells[a:b].tobytes(), "words": words[a:b].tobytes(),
               "counts": _small(times[a:b].astype(np.uint32)),
               "home": _ipc(rest) if r == home else None, "at": _small(of) if r == home else None,
               "total": total.tobytes() if r == home else None}


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _to_ranges(vocabulary, network, text: int, ranges: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]):
        net = Network.unflat(network.value)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in batch_texts(batch, "text", BLOCK_BYTES):
                rows = list(_block_messages(part, text, block, ranges, vocabulary.value, net))
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                block += 1
    return run


def _totals(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each key the sum of the values of all equal keys."""
    order = np.argsort(keys)
    at, times = _runs(keys[order])
    out = np.zeros(len(keys), np.int64)
    if len(at):
        out[order] = np.repeat(np.add.reduceat(values[order], at), times)
    return out


def _answer(vocabulary, schema: pa.Schema):
    """Of one range, for each key of each block: the logarithm of P(word | class, left, right) / P0."""
    def run(t):
        cells, words = ([np.frombuffer(v, np.uint32) for v in t[n].to_pylist()] for n in ("cells", "words"))
        cut = np.cumsum([len(v) for v in cells])[:-1]
        cells, words = np.concatenate(cells).astype(np.uint64), np.concatenate(words).astype(np.uint64)
        counts = np.concatenate([_wide(v, np.uint32) for v in t["counts"].to_pylist()]).astype(np.int64)
        bucket = (words >> np.uint64(32 - _BUCKET_BITS)).astype(np.int64)
        others = _totals((cells << np.uint64(32)) | words, counts) - 1
        whole = _totals(cells * np.uint64(CLASSES) + vocabulary.value.cls[bucket], counts) - 1
        seen = whole > 0  # else the answer is exactly 0, which costs next to nothing to send
        base = PRIOR * vocabulary.value.share[bucket[seen]]
        gains = np.zeros(len(cells), np.float32)
        gains[seen] = np.log((others[seen] + base) / (whole[seen] + PRIOR) * PRIOR / base)
        sent = pa.array([_small(part) for part in np.split(gains, cut)], pa.binary())
        return pa.table([sent if f.name == "gains" else t[f.name].combine_chunks() for f in schema], schema=schema)
    return run


def _score(schema: pa.Schema):
    """Of one block: its rows with their scores."""
    def run(t):
        t = t.sort_by("range")
        gains = np.concatenate([_wide(v, np.float32) for v in t["gains"].to_pylist()]).astype(float)
        home = next(i for i, v in enumerate(t["home"].to_pylist()) if v)
        rest = pa.ipc.open_stream(t["home"][home].as_py()).read_all().combine_chunks()
        inner = np.concatenate([[0], np.cumsum(rest.column(rest.num_columns - 1).to_numpy())])
        total = np.frombuffer(t["total"][home].as_py(), float)
        total = total + _per_text(gains[_wide(t["at"][home].as_py(), np.int32)], inner)
        return pa.table([*rest.columns[:-1], pa.array(np.round(total, 3))], schema=schema)
    return run


def lm_scores(docs: DataFrame, carry: Sequence[str] = (), rounds: int = ROUNDS, stride: int = STRIDE) -> DataFrame:
    """(doc_id, *carry, n_tokens, log_likelihood, mean_log_likelihood) of every row."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    counts = word_counts(docs)
    vocabulary, net = train(docs, rounds, stride, counts=counts)
    sc = docs.sparkSession.sparkContext
    sent, weights = sc.broadcast(vocabulary), sc.broadcast(net.flat())
    ranges = min(1 << 24, 1 + int(counts.sum()) // RANGE_WORDS)
    rest = [F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
    rows = docs.select("doc_id", *rest, "text")
    out = rows.drop("text").withColumns({"n_tokens": F.lit(0).cast("long"), "log_likelihood": F.lit(0.0)}).schema
    message, answer = (to_arrow_schema(_parse_datatype_string(x)) for x in (_MESSAGE, _ANSWER))
    scored = (in_arrow(rows, _to_ranges(sent, weights, len(carry) + 1, ranges, message), _MESSAGE)
              .groupBy("range").applyInArrow(_answer(sent, answer), _ANSWER)
              .groupBy("block").applyInArrow(_score(to_arrow_schema(out)), out))
    mean = F.when(F.col("n_tokens") > 0, F.round(F.col("log_likelihood") / F.col("n_tokens"), 6))
    return scored.select("doc_id", *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "n_tokens", "log_likelihood",
                         mean.alias("mean_log_likelihood"))
