"""Removal of word passages that occur more than once (operator 3, difference-cover anchors).

A set of residues modulo a period is a difference cover if every difference is one between two of its members.
Windows are hashed only at places whose position in their document has such a residue.  Wherever two equal
passages stand, some shift below the period brings both to hashed places, so a passage of ``length`` words
that occurs twice shares an aligned anchor of ``length - period + 1`` words.  Anchors that occur twice are
then extended: the full windows around them are hashed with 128 bits and counted, and words under a window
that occurs twice go.

Documents are dealt into chunks by a hash of the row.  A chunk reports each hash once, with how often it has
it, so that a passage in every document costs one row per chunk, and it gets back the hashes that are repeated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estrato.llm.common import WORD_BASES, drop_written, free_shuffles, partitions, run_hashes, slices, text_buffers, word_hashes, word_spans, written

#: Perfect difference sets: every difference modulo the period occurs once.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
#: Chunks for each shuffle partition at least, and bytes of text that a chunk holds on average at most.
CHUNKS, CHUNK_BYTES = 4, 16 << 20


class _Part:
    """The words of consecutive documents, with their hashes."""

    def __init__(self, batch: pa.RecordBatch):
        self.data, self.offsets = text_buffers(batch.column("text"))
        self.starts, self.ends, self.before = word_spans(self.data, self.offsets)
        self.counts = np.diff(self.before)
        self.place = np.arange(len(self.starts)) - np.repeat(self.before[:-1], self.counts)  # in its document
        self.left = np.repeat(self.counts, self.counts) - self.place  # words from here to the end of the document

    def windows(self, at: np.ndarray, length: int, family: int) -> np.ndarray:
        words = word_hashes(self.data, self.starts, self.ends, family)
        return run_hashes(words, at, at + length, WORD_BASES[family]).view(np.int64)

    def anchors(self, length: int, period: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the anchors and their hashes; documents shorter than a passage have none."""
        covered = np.zeros(period, bool)
        covered[list(COVERS[period])] = True
        size = length - period + 1
        long = np.repeat(self.counts >= length, self.counts)
        at = np.flatnonzero(long & covered[self.place % period] & (self.left >= size))
        return at, self.windows(at, size, 0)


def _parts(table: pa.Table):
    for batch in table.combine_chunks().to_batches():
        for part in slices(batch, "text"):
            yield part, _Part(part)


def _counted(*hashes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct hashes (of one or two columns) and how often each occurs."""
    order = np.lexsort(hashes[::-1])
    columns = [h[order] for h in hashes]
    first = np.ones(len(order), bool)
    if len(order):
        first[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    places = np.flatnonzero(first)
    return [c[places] for c in columns], np.diff(np.append(places, len(order)))


def _repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """Of (chunk, hash, how often), the rows whose hash occurs twice or more in all."""
    total = F.sum("n").over(Window.partitionBy(*keys))
    return rows.withColumn("total", total).filter("total > 1").select("chunk", *keys)


def repeated_passages(docs: DataFrame, length: int = 35, period: int = 21) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed and the kept words, joined by blanks.

    Words are runs of characters other than ASCII white space.  A word goes if it lies in a passage of
    ``length`` words that starts at any other place too, in the same document or another; a repeated row
    counts as another document.  A null or empty text has no words; a null doc_id stays null; other columns
    are not read.  Passages are judged on the input, not on what is left.
    """
    if period not in COVERS or not period <= length:
        raise ValueError(f"period must be one of {sorted(COVERS)} and at most length")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(CHUNKS * partitions(docs.sparkSession), -(-size // CHUNK_BYTES))
    dealt = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk"))
    anchors = written(_repeated(dealt.groupBy("chunk").applyInArrow(_report_anchors(length, period), "chunk int, h long, n int"), "h"))
    windows = written(_repeated(dealt.groupBy("chunk").cogroup(anchors.groupBy("chunk")).applyInArrow(_report_windows(length, period), "chunk int, h long, g long, n int"), "h", "g"))
    drop_written(anchors)
    free_shuffles(docs.sparkSession)
    return dealt.groupBy("chunk").cogroup(windows.groupBy("chunk")).applyInArrow(_keep(length), "doc_id long, n_words long, n_removed long, kept string")


def _report(table: pa.Table, *hashes: list[np.ndarray]) -> pa.Table:
    distinct, counts = _counted(*[np.concatenate([np.zeros(0, np.int64), *h]) for h in hashes])
    chunk = table.column("chunk")[0].as_py() if table.num_rows else 0
    columns = [np.full(len(counts), chunk, np.int32), *distinct, np.minimum(counts, 2).astype(np.int32)]
    return pa.table([pa.array(c) for c in columns], names=["chunk", "h", "g", "n"] if len(hashes) > 1 else ["chunk", "h", "n"])


def _report_anchors(length: int, period: int):
    def work(docs: pa.Table) -> pa.Table:
        return _report(docs, [words.anchors(length, period)[1] for _, words in _parts(docs)])

    return work


def _report_windows(length: int, period: int):
    def work(docs: pa.Table, anchors: pa.Table) -> pa.Table:
        repeated = np.sort(anchors.column("h").to_numpy())
        first, second = [], []
        for _, words in _parts(docs):
            at, h = words.anchors(length, period)
            at = at[_among(h, repeated)]
            # A window is in question if an anchor that it holds at a shift below the period is repeated.
            edge = np.zeros(len(words.starts) + 1, np.int64)
            np.add.at(edge, np.maximum(at - period + 1, at - words.place[at]), 1)
            np.add.at(edge, at + 1, -1)
            candidates = np.flatnonzero((np.cumsum(edge[:-1]) > 0) & (words.left >= length))
            first.append(words.windows(candidates, length, 0))
            second.append(words.windows(candidates, length, 1))
        return _report(docs, first, second)

    return work


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _keep(length: int):
    def work(docs: pa.Table, windows: pa.Table) -> pa.Table:
        h, g = windows.column("h").to_numpy(), windows.column("g").to_numpy()
        order = np.lexsort((g, h))
        h, g = h[order], g[order]
        ids, totals, removed, kept = [], [], [], []
        for part, words in _parts(docs):
            gone = _covered(words, h, g, length)
            sums = np.concatenate([[0], np.cumsum(gone)])
            ids += part.column("doc_id").to_pylist()
            totals += words.counts.tolist()
            removed += (sums[words.before[1:]] - sums[words.before[:-1]]).tolist()
            raw = words.data.tobytes()
            for d, (a, b) in enumerate(zip(words.before[:-1].tolist(), words.before[1:].tolist())):
                if sums[a] == sums[b]:
                    kept.append(b" ".join(raw[words.offsets[d] : words.offsets[d + 1]].split()))
                else:
                    stay = (a + np.flatnonzero(~gone[a:b])).tolist()
                    kept.append(b" ".join([raw[words.starts[i] : words.ends[i]] for i in stay]))
        return pa.table([pa.array(ids, pa.int64()), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return work


def _covered(words: _Part, h: np.ndarray, g: np.ndarray, length: int) -> np.ndarray:
    """Whether each word lies in a window whose hashes are among the sorted pairs (h, g)."""
    edge = np.zeros(len(words.starts) + 1, np.int64)
    at = np.flatnonzero(words.left >= length)
    if len(h) and len(at):
        x = words.windows(at, length, 0)
        hit = _among(x, h)
        at, x = at[hit], x[hit]
        y = words.windows(at, length, 1)
        places = np.searchsorted(h, x)
        found = g[places] == y
        for step in range(1, len(h)):  # equal first hashes with other second ones are next to each other
            more = np.flatnonzero(~found & (places + step < len(h)))
            more = more[h[places[more] + step] == x[more]]
            if not len(more):
                break
            found[more] = g[places[more] + step] == y[more]
        np.add.at(edge, at[found], 1)
        np.add.at(edge, at[found] + length, -1)
    return np.cumsum(edge[:-1]) > 0
