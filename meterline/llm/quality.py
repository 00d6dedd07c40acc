"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a text (shares of byte kinds, word and line shapes, repetition) are taken in numpy from the
whole UTF-8 text.  The trees are grown in numpy over binned statistics, on a sample of labelled rows of at
most ``max_rows`` (the rows of smallest ``xxhash64(doc_id)``; a documented bound, so the driver holds
``max_rows`` times some thirty numbers whatever the corpus).  The fitted trees are flattened into
parallel arrays and all documents of a batch walk down a tree together.

Defined results: null and empty texts have all statistics 0 and are scored like any other.  Labels
other than 0 and 1, and labels of unknown documents, are ignored; a document labelled twice counts twice, as one
row of weight 2 (rows with equal labels are one before the sample is taken, so that repeats don't fill it).
Without labels of both kinds every score is the share of label 1 (0.5 without labels).  Repeated rows get
equal scores.  Columns named in ``carry`` come along, and nothing but the text is an input.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_arrow
from .words import SPACED, Words, batch_texts, text_buffer

MAX_ROWS = 20_000

_KIND = np.zeros(256, np.int64)          # 0: control and other
_KIND[97:123] = 1                        # a-z
_KIND[65:91] = 2                         # A-Z
_KIND[48:58] = 3                         # 0-9
_KIND[[32, 9, 13]] = 4
_KIND[10] = 5
_KIND[[44, 46, 59, 58, 39, 45, 33, 63]] = 6   # , . ; : ' - ! ?
_KIND[[33, 63]] = 7
_KIND[[35, 36, 37, 38, 42, 43, 61, 64, 94, 95, 126]] = 8  # # $ % & * + = @ ^ _ ~
_KIND[[40, 41, 47, 60, 62, 91, 92, 93, 123, 124, 125]] = 9  # brackets, slashes, bar
_KIND[128:] = 10
_KINDS = 11

FEATURES = ([f"bytes_{i}" for i in range(_KINDS)] + [f"words_ending_{i}" for i in range(_KINDS)]
            + ["log_words", "log_bytes", "word_length", "word_length_spread", "long_words", "one_byte_words",
               "distinct_words", "distinct_lines", "line_words", "words_starting_upper", "words_all_upper",
               "commonest_word", "same_as_before"])


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over the texts bounded by ``first``."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]


def _kinds(kind: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How often each text has each kind; the kinds of text d are the next ``counts[d]``."""
    n = len(counts)
    return np.bincount(np.repeat(np.arange(n) * _KINDS, counts) + kind, minlength=n * _KINDS).reshape(n, _KINDS)


def _ranks_within(keys: np.ndarray, of: np.ndarray):
    """(text, times) of each distinct (text, key)."""
    order = np.lexsort((keys, of))
    k, o = keys[order], of[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(new)
    return o[at], np.diff(np.append(at, len(k)))


def statistics(column) -> np.ndarray:
    """One row of FEATURES per text."""
    raw, off = text_buffer(column)
    n = len(off) - 1
    w = Words(column, SPACED)
    hashes = w.hashes()
    length = w.ends - w.starts
    words, size = w.counts.astype(float), np.diff(off).astype(float)
    per_word, per_byte = 1 / np.maximum(words, 1), 1 / np.maximum(size, 1)
    kind = _KIND.astype(np.int8)[raw]
    shares = list((_kinds(kind, np.diff(off)) * per_byte[:, None]).T)
    shares += list((_kinds(kind[w.ends - 1], w.counts) * per_word[:, None]).T)
    mean = _per_text(length, w.first) * per_word
    square = _per_text(length.astype(float) ** 2, w.first) * per_word
    of = np.repeat(np.arange(n), w.counts)
    text, times = _ranks_within(hashes, of)
    common = np.zeros(n)
    np.maximum.at(common, text, times)
    lines = Words(column, ~(np.arange(256) == 10))
    line_of = np.repeat(np.arange(n), lines.counts)
    line_text, _ = _ranks_within(lines.hashes(), line_of)
    n_lines = lines.counts.astype(float)
    upper = np.concatenate([[0], np.cumsum(kind == 2)])
    lower = np.concatenate([[0], np.cumsum(kind == 1)])
    has_upper = (upper[w.ends] - upper[w.starts]) > 1
    has_lower = (lower[w.ends] - lower[w.starts]) > 0
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    shares += [np.log1p(words), np.log1p(size), mean, np.sqrt(np.maximum(square - mean ** 2, 0)),
               _per_text(length > 20, w.first) * per_word, _per_text(length == 1, w.first) * per_word,
               np.bincount(text, minlength=n) * per_word,
               np.bincount(line_text, minlength=n) / np.maximum(n_lines, 1),
               words / np.maximum(n_lines, 1), _per_text(kind[w.starts] == 2, w.first) * per_word,
               _per_text(has_upper & ~has_lower, w.first) * per_word, common * per_word,
               _per_text(again, w.first) * per_word]
    return np.stack(shares, axis=1)


@dataclass
class Boosted:
    """Trees as flat arrays: node i splits on ``feature[i]`` at ``cut[i]`` into ``left[i]`` (<=) and
    ``left[i] + 1``; a leaf has feature -1 and adds ``value[i]``.  ``roots``: where each tree begins."""

    base: float
    depth: int = 0
    roots: list[int] = field(default_factory=list)
    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                down = self.left[node] + (x[rows, np.maximum(f, 0)] > self.cut[node])
                node = np.where(f < 0, node, down)
            total += self.value[node]
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64,
        least: int = 10, l2: float = 1.0, weight: np.ndarray | None = None) -> Boosted:
    """Logistic boosting; every split is searched over histograms of at most ``bins`` bins per statistic.
    A row of weight n counts as n rows."""
    weight = np.ones(len(y)) if weight is None else weight
    p = np.average(y, weights=weight) if len(y) else 0.5
    base = float(np.log(p / (1 - p))) if 0 < p < 1 else (0.0 if not len(y) else 35.0 * (1 if p else -1))
    model = Boosted(base, depth)
    if not len(y) or not 0 < p < 1:
        return model
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
    flat = binned + np.arange(x.shape[1]) * bins
    feature, cut, left, value = [], [], [], []
    margin = np.full(len(y), base)
    for _ in range(trees):
        prob = 1 / (1 + np.exp(-margin))
        g, h = weight * (y - prob), weight * prob * (1 - prob)
        root = len(feature)
        model.roots.append(root)
        feature.append(-1), cut.append(0.0), left.append(0), value.append(0.0)
        level = [(root, np.arange(len(y)))]
        for d in range(depth + 1):
            below = []
            for node, rows in level:
                gs, hs = g[rows].sum(), h[rows].sum()
                value[node] = rate * gs / (hs + l2)
                margin[rows] += value[node] if d == depth else 0
                if d == depth:
                    continue
                split = _split(flat[rows], g[rows], h[rows], weight[rows], x.shape[1], bins, least, l2)
                if split is None:
                    margin[rows] += value[node]
                    continue
                j, b = split
                feature[node], cut[node], left[node] = j, float(cuts[j][b]), len(feature)
                goes = binned[rows, j] <= b
                for part in (rows[goes], rows[~goes]):
                    below.append((len(feature), part))
                    feature.append(-1), cut.append(0.0), left.append(0), value.append(0.0)
            level = below
    model.feature, model.cut = np.array(feature), np.array(cut)
    model.left, model.value = np.array(left), np.array(value)
    return model


def _split(flat, g, h, weight, n_features: int, bins: int, least: int, l2: float):
    """The best (statistic, bin) to split at, from gradient histograms of all statistics at once."""
    size = n_features * bins
    at = flat.ravel()
    hist = [np.bincount(at, weights=np.repeat(v, n_features), minlength=size).reshape(n_features, bins)
            for v in (g, h, weight)]
    gl, hl, nl = (np.cumsum(v, axis=1)[:, :-1] for v in hist)
    gt, ht, nt = g.sum(), h.sum(), weight.sum()
    gain = gl ** 2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt ** 2 / (ht + l2)
    gain[(nl < least) | (nt - nl < least)] = -1
    best = int(np.argmax(gain))
    j, b = divmod(best, bins - 1)
    return (j, b) if gain[j, b] > 1e-9 else None


def fold(doc_id: str | Column = "doc_id", folds: int = 3) -> Column:
    """crc32 of the id's text, modulo ``folds``."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return (F.crc32(c.cast("string").cast("binary")) % folds).cast("int")


def _to_statistics(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in batch_texts(batch, "text", 1 << 20):
                x = statistics(part.column(0))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(list(x), pa.list_(pa.float64()))],
                                                 schema=schema)
    return run


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, label: str = "quality",
          where: Column | None = None, **options) -> Boosted:
    """Fit on at most ``max_rows`` labelled documents, chosen by the hash of their id.  Where documents repeat
    labelled ids beyond that, equal texts of an id are one row and the hash of id and text chooses again."""
    marked = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("label in (0, 1)")
    marked = marked.where(where) if where is not None else marked
    marked = (marked.groupBy("doc_id", "label").agg(F.count(F.lit(1)).alias("n")).withColumn("h", F.xxhash64("doc_id"))
              .orderBy("h", "doc_id", "label").limit(max_rows).select("doc_id", "label", "n"))
    sample = docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id")
    schema = pa.schema([("label", pa.int32()), ("n", pa.int64()), ("h", pa.int64()), ("x", pa.list_(pa.float64()))])
    rows = in_arrow(sample.select("text", "label", "n", F.xxhash64("doc_id", "text").alias("h")), _to_statistics(schema),
                    "label int, n long, h long, x array<double>")
    if sample.count() > max_rows:
        rows = rows.groupBy("h", "label", "x").agg(F.sum("n").alias("n")).orderBy("h", "label", "x").limit(max_rows)
    rows = rows.select("label", "n", "x").toArrow()
    y, n = (rows[c].to_numpy().astype(float) for c in ("label", "n"))
    x = np.array(rows["x"].to_pylist(), float).reshape(len(y), len(FEATURES))
    order = np.lexsort((n, *x.T, y))  # the same model whatever order the rows came in
    return fit(x[order], y[order], weight=n[order], **options)


def _score(model, schema: pa.Schema, text: int):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in batch_texts(batch, "text", 1 << 20):
                score = model.value.scores(statistics(part.column(text)))
                cols = [c for i, c in enumerate(part.columns) if i != text]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(score)], schema=schema)
    return run


def score(docs: DataFrame, model: Boosted, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, *carry, score) of every row; one narrow pass over the texts."""
    from pyspark.sql.pandas.types import to_arrow_schema

    sent = docs.sparkSession.sparkContext.broadcast(model)
    rest = [F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]  # a carried column may be named "text"
    rows = docs.select("doc_id", *rest, "text")
    out = rows.drop("text").withColumn("score", F.lit(0.0)).schema
    scored = in_arrow(rows, _score(sent, to_arrow_schema(out), len(carry) + 1), out)
    return scored.select("doc_id", *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "score")
