"""Quality classifier (operator 10): generalised additive model with pairwise interactions.

Shallow trees are boosted in cycles, one feature at a time, on quantile bins; their sum per feature is a
lookup table.  The pairs of features that explain most of what is left get two-dimensional tables in the same
way.  A text's score is the sum of its features' table entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import slices, text_buffers, word_hashes, word_spans

#: Bound of the labelled sample, bins of a feature, cycles, learning rate, pairs and their bins, penalty.
SAMPLE, BINS, CYCLES, RATE, PAIRS, PAIR_BINS, PENALTY = 20_000, 32, 120, 0.15, 8, 8, 1.0
THRESHOLD = 0.3

FEATURES = (
    "words", "word_bytes", "word_spread", "longest_word", "upper", "digits", "points", "symbols", "other_bytes", "blanks",
    "lines", "words_of_line", "distinct_words", "commonest_word", "symbol_ends", "upper_words", "bare_symbols", "distinct_lines",
)


def learnable(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 != 0


def _sum(mask: np.ndarray, places: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[places])


def _runs(doc: np.ndarray, hashes: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct hashes of each document, and how often its commonest occurs."""
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    places = np.flatnonzero(first)
    sizes = np.diff(np.append(places, len(doc)))
    most = np.zeros(count, np.int64)
    np.maximum.at(most, doc[places], sizes)
    return np.bincount(doc[places], minlength=count), most


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text, over the whole text; a null text counts as empty."""
    data, offsets = text_buffers(texts)
    count = len(offsets) - 1
    starts, ends, before = word_spans(data, offsets)
    words, size = np.diff(before), np.diff(offsets)
    doc = np.repeat(np.arange(count), words)
    length = (ends - starts).astype(np.float64)
    n, chars = np.maximum(words, 1), np.maximum(size, 1)
    upper = (data >= 65) & (data <= 90)
    point = (data == 46) | (data == 44)
    symbol = (data > 32) & (data < 127) & ~upper & ~((data >= 97) & (data <= 122)) & ~((data >= 48) & (data <= 57)) & ~point
    newline = data == 10
    total = np.concatenate([[0], np.cumsum(symbol, dtype=np.int64)])
    inside = total[ends] - total[starts]
    capitals = np.concatenate([[0], np.cumsum(upper, dtype=np.int64)])
    mean = np.bincount(doc, length, count) / n
    longest = np.zeros(count)
    np.maximum.at(longest, doc, length)
    distinct, most = _runs(doc, word_hashes(data, starts, ends), count)
    # Lines: runs between line ends and document edges.
    edges = np.union1d(np.flatnonzero(newline), np.concatenate([offsets[:-1], offsets[1:]]) - 0.5).astype(np.float64)
    line = np.searchsorted(edges, np.arange(len(starts)) * 0 + starts, side="right")
    heads = np.flatnonzero(np.diff(line, prepend=-1) != 0)
    tails = np.append(heads[1:], len(line)) - 1 if len(heads) else heads
    line_doc = doc[heads]
    line_count = np.bincount(line_doc, minlength=count)
    line_distinct = _runs(line_doc, word_hashes(data, starts[heads], ends[tails]), count)[0]
    columns = [
        np.log1p(words), mean, np.sqrt(np.maximum(np.bincount(doc, length**2, count) / n - mean**2, 0)), np.log1p(longest),
        _sum(upper, offsets) / chars, _sum((data >= 48) & (data <= 57), offsets) / chars, _sum(point, offsets) / n, _sum(symbol, offsets) / chars,
        _sum(data > 127, offsets) / chars, _sum(data <= 32, offsets) / chars, _sum(newline, offsets) / n, words / np.maximum(line_count, 1),
        distinct / n, most / n, np.bincount(doc, symbol[ends - 1], count) / n, np.bincount(doc, (capitals[ends] - capitals[starts]) * 2 > length, count) / n,
        np.bincount(doc, inside == length, count) / n, line_distinct / np.maximum(line_count, 1),
    ]
    return np.stack(columns, axis=1).astype(np.float64) if count else np.zeros((0, len(FEATURES)))


@dataclass
class Model:
    start: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1: additions of table entries by bin."""
        total = np.full(len(rows), self.start)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, rows[:, j], side="right")]
        coarse = [np.searchsorted(e, rows[:, j], side="right") for j, e in enumerate(self.pair_edges)]
        for a, b, table in self.pairs:
            total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _quantiles(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _tree(g: np.ndarray, h: np.ndarray, penalty: float) -> np.ndarray:
    """Values per bin of a tree with at most two splits on top of each other."""

    def cut(low: int, high: int) -> int:
        x, y = np.cumsum(g[low:high]), np.cumsum(h[low:high])
        if len(x) < 2:
            return low
        gain = x[:-1] ** 2 / (y[:-1] + penalty) + (x[-1] - x[:-1]) ** 2 / (y[-1] - y[:-1] + penalty)
        best = int(np.argmax(gain))
        return low + best + 1 if gain[best] > x[-1] ** 2 / (y[-1] + penalty) + 1e-9 else low

    places = {0, len(g)}
    for _ in range(2):
        places |= {cut(a, b) for a, b in zip(sorted(places), sorted(places)[1:])}
    out = np.zeros(len(g))
    for a, b in zip(sorted(places), sorted(places)[1:]):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + penalty)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Gain and values of the best two-by-two cut of a grid."""
    x, y = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def four(t):
        return t[:-1, :-1], t[:-1, -1:] - t[:-1, :-1], t[-1:, :-1] - t[:-1, :-1], t[-1, -1] - t[:-1, -1:] - t[-1:, :-1] + t[:-1, :-1]

    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    gs, hs = four(x), four(y)
    gain = sum(a**2 / (b + penalty) for a, b in zip(gs, hs))
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    value = [a[i, j] / (b[i, j] + penalty) for a, b in zip(gs, hs)]
    out = np.empty(g.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = value
    return float(gain[i, j]), out


def train(rows: np.ndarray, labels: np.ndarray) -> Model:
    """Cyclic boosting of the one-feature tables, then of the tables of the best pairs."""
    if not len(labels) or labels.min() == labels.max():
        return Model(0.0 if not len(labels) else 3.0 * (2 * float(labels[0]) - 1))
    rate = labels.mean()
    model = Model(float(np.log(rate / (1 - rate))))
    model.edges = [_quantiles(rows[:, j], BINS) for j in range(rows.shape[1])]
    model.pair_edges = [_quantiles(rows[:, j], PAIR_BINS) for j in range(rows.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, rows[:, j], side="right") for j, e in enumerate(model.edges)]
    coarse = [np.searchsorted(e, rows[:, j], side="right") for j, e in enumerate(model.pair_edges)]
    total = np.full(len(labels), model.start)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    def grid(a: int, b: int):
        shape = (len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)
        flat = coarse[a] * shape[1] + coarse[b]
        return [np.bincount(flat, w, shape[0] * shape[1]).reshape(shape) for w in slopes()]

    for _ in range(CYCLES):
        for j, b in enumerate(bins):
            g, h = slopes()
            step = RATE * _tree(np.bincount(b, g, len(model.tables[j])), np.bincount(b, h, len(model.tables[j])), PENALTY)
            model.tables[j] += step
            total += step[b]
    gains = sorted(((_quadrants(*grid(a, b), PENALTY)[0], a, b) for a in range(len(bins)) for b in range(a)), reverse=True)
    model.pairs = [(a, b, np.zeros((len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1))) for _, a, b in gains[:PAIRS]]
    for _ in range(CYCLES // 4):
        for a, b, table in model.pairs:
            step = RATE * _quadrants(*grid(a, b), PENALTY)[1]
            table += step
            total += step[coarse[a], coarse[b]]
    return model


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn quality from ``labels`` (doc_id, quality) of ``docs``, without the held-out rows.

    The sample is bounded: the ``sample`` labelled documents with the smallest hashes of their ids.  Rows with
    a null id or label are not used; of several labels of a document the smallest counts.
    """
    usable = labels.filter(learnable(F.col("doc_id")) & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    drawn = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # its size is bounded, so it may be broadcast
    joined = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values = features(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality").cast(pa.int32()), *map(pa.array, values.T)], ["doc_id", "quality", *FEATURES])

    schema = "doc_id long, quality int, " + ", ".join(f"{f} double" for f in FEATURES)
    found = joined.select("doc_id", "text", "quality").mapInArrow(work, schema).dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id")
    return train(found[list(FEATURES)].to_numpy(np.float64), found["quality"].to_numpy(np.float64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of each row of ``docs`` (doc_id, text): the probability of good quality, 0 to 1.

    A null or empty text is scored like any other, as a text without words.  Repeated rows get equal scores.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.score(features(part.column("text"))))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, score double")


def keep(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``threshold`` or more."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield part.filter(pa.array(model.score(features(part.column("text"))) >= threshold))

    return docs.mapInArrow(work, docs.schema)
